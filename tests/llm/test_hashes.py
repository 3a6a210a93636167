"""Texts built to agree in a polynomial hash, and results under forced collisions."""

import random
import sys

import numpy as np
import pyarrow as pa
import pytest

ROOT = __file__.rsplit("/tests/", 1)[0]
sys.path.insert(0, ROOT)


def _mirrored(n=1024):
    """Two words that every odd-based polynomial modulo 2**64 hashes alike."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


ONE, TWO = _mirrored()


@pytest.fixture(scope="module")
def docs(spark):
    tail = " ".join(f"w{i}" for i in range(12))
    texts = [f"{ONE} {tail}", f"{TWO} {tail}", ONE, TWO, f"{ONE} {TWO} {ONE}{TWO}"]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def test_word_hash_and_same_spans():
    from tripledger.llm import textbytes as tb

    rng = random.Random(2)
    spans = [bytes(rng.choices(b"ab\0", k=rng.choice([0, 1, 7, 8, 9, 16, 30]))) for _ in range(300)]
    spans += [ONE.encode(), TWO.encode(), b"x" * 20000, b"x" * 19999 + b"y", b"a", b"a\0", b"\0a"]
    data = np.frombuffer(b" ".join(spans), np.uint8)
    sizes = np.array([len(s) for s in spans])
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    for seed in (0, 1):
        h = tb.word_hash(data, starts, starts + sizes, seed)
        assert len(set(zip(spans, h.tolist()))) == len(set(spans)) == len(set(h.tolist()))
    assert set(h.tolist()).isdisjoint(tb.word_hash(data, starts, starts + sizes, 2).tolist())
    for i in range(0, len(spans), 7):
        other = np.full(len(spans), starts[i])
        same = tb.same_spans(data, starts, other, np.where(sizes == sizes[i], sizes, 0))
        assert [bool(a) for a in same] == [len(s) != len(spans[i]) or s == spans[i] for s in spans]


def test_ids_of_mirrored_words_and_under_collisions(spark, docs, monkeypatch):
    from tokenizers import Tokenizer

    from tripledger.llm import op8_bpe, textbytes
    from tripledger.llm.op3_packing import pack_documents
    from tripledger.llm.pretokens import PretokenTable, Vocabulary

    path = op8_bpe.vocabulary_path()
    library = Tokenizer.from_file(path)
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    import hashlib
    import zlib

    got = {r["doc_id"]: r["ids_sha256"] for r in op8_bpe.digests(docs, path).collect()}
    assert got == {i: hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest()
                   for i, x in enumerate(ids)}
    for r in pack_documents(docs, path).collect():
        own = [*ids[r["doc_id"]], 1][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())

    # Every pre-token of one first byte has the same hash: bytes decide.
    monkeypatch.setattr(textbytes, "word_hash", lambda data, starts, ends, seed=0:
                        data[starts].astype(np.uint64))
    table = PretokenTable(Vocabulary(path), lambda word: (word,))
    text = "the Then there thin an apple, an art; éa èa 12 the"
    for _ in range(2):
        (row,) = table.rows(pa.array([text]))
        assert [w for (w,) in row] == ["the", "then", "there", "thin", "an", "apple", ",", "an",
                                       "art", ";", "éa", "èa", "1", "2", "the"]


def test_mirrored_words_are_not_removed_or_linked(docs):
    from tripledger.llm.op6_near_dedup import near_duplicates
    from tripledger.llm.op9_substring_dedup import dedup

    assert {r["n_removed"] for r in dedup(docs).collect()} == {0}
    assert all(r["component_id"] == r["doc_id"] for r in near_duplicates(docs, 85).collect())


def test_bands_follow_the_threshold():
    from tripledger.llm.op6_near_dedup import MISS, ROWS, bands_for

    assert bands_for(85) == 30 and bands_for(80) == 46 and bands_for(100) == 1
    assert (1 - 0.8 ** ROWS) ** bands_for(80) <= MISS


def test_pipeline_rows_that_share_a_number(spark, monkeypatch):
    import corpus_pipeline
    from pyspark.sql import functions as F

    rng = random.Random(6)
    texts = [" ".join(rng.choices([f"v{i}" for i in range(300)], k=60)) for _ in range(30)]
    rows = list(enumerate(texts)) + [(100 + i, texts[i]) for i in range(5)]
    table = spark.createDataFrame([(*r, "x") for r in rows],
                                  "doc_id long, text string, `a.b``c` string")
    honest = corpus_pipeline._row_hash()
    monkeypatch.setattr(corpus_pipeline, "_row_hash", lambda: F.pmod(honest, F.lit(4)))
    left = corpus_pipeline.near_dedup(spark, table, "")
    assert left.columns == table.columns
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(30))
