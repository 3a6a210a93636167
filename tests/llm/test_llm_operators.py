"""The training-data operators against brute force, the library and held-out labels.

The fixture holds NULL ids and texts, empty and long texts, exact and near
copies, shared passages, repeated rows, and an extra column of a clashing name.
"""

import hashlib
import random
import sys
import zlib
from collections import defaultdict

import pytest

ROOT = __file__.rsplit("/tests/", 1)[0]
sys.path.insert(0, ROOT)

SCHEMA = "doc_id long, text string, did string"


def _rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeTé") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage = prose(60)
    rows = [(i, prose(rng.randint(20, 200)), "x") for i in range(30)]
    rows += [(30 + i, f"{prose(20)} {passage}\n{prose(30)}", None) for i in range(8)]
    base = prose(150).split(" ")
    for i in range(8):
        words = list(base)
        for _ in range(i // 2):
            words[rng.randrange(len(words))] = "changed"
        rows.append((40 + i, " ".join(words), "near"))
    rows += [(50, rows[3][1], "copy"), (51, rows[3][1].upper(), "copy"), (52, None, "n"), (53, "", "n"),
             (54, "one two", "n"), (55, "One  two", "n"), (None, prose(40), "n"), (None, passage, "n"),
             (56, "be " * 300, "loop"), (57, "x" * 5000, "run"), (58, " \t\n \n", "blank"),
             (59, prose(9000), "long"), (60, "éé" * 200, "bytes"), (61, "a" + "éé" * 100, "bytes"),
             (62, "dup line\nother\ndup line\n\n\nother", "lines")]
    rows.append(rows[10])  # a repeated row
    return rows


ROWS = _rows()
LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _key(doc_id):
    return -(2**63) if doc_id is None else doc_id


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _bag(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_rules_match_brute_force(docs, empty):
    from tripledger.llm.op2_quality_rules import ablation, apply_policy, ledger

    expected = []
    for doc_id, text, _ in ROWS:
        text = text or ""
        words = [w.decode() for w in text.encode().split()]
        seen = defaultdict(list)
        for i in range(len(words) - 2):
            seen[tuple(words[i:i + 3])].append(i)
        hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        expected.append((doc_id, len(words), sum(map(len, words)),
                         sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
                         len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words)))
    got = apply_policy(ledger(docs))
    assert _bag(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                "n_repeat_words", "base_failed") == sorted(expected, key=repr)
    alone = {r["rule"]: r for r in ablation(got).collect()}
    bits = [r["fail_bits"] for r in got.collect()]
    assert alone["few_words"]["rejected"] == sum(b & 1 for b in bits)
    assert alone["few_words"]["rejected_alone"] == sum(b == 1 for b in bits)
    assert alone["few_words"]["kept_without"] == sum(b & ~1 == 0 for b in bits)
    assert apply_policy(ledger(empty)).count() == 0


def test_chat_fold_render_and_read_back(spark):
    from tripledger.llm.op1_chat_format import digests, fold_events, render, turn_events

    events = spark.createDataFrame(
        [(1, 1, 1, "message", "user", "hi </s> \\</s>\\"), (1, 2, 2, "delta", "assistant", "a"),
         (1, 3, 2, "delta", "assistant", "b"), (1, 4, 2, "regenerate", "assistant", None),
         (1, 5, 2, "delta", "assistant", "c<|end|>"), (1, 6, 2, "delta", "assistant", "\nd"),
         (1, 7, 1, "edit", "user", "[INST]\\\\[INST]"), (None, 1, 1, None, None, None)],
        "conv_id long, seq long, message_id long, kind string, role string, text string")
    rendered = render(fold_events(events))
    row = {r["conv_id"]: r for r in rendered.collect()}[1]
    assert "[INST]\\\\[INST]" not in row["formatted"]
    (span,) = row["loss_spans"]
    assert row["formatted"][span["start"]:span["start"] + span["length"]] == "c\\<|end|>\nd"
    said = {r["conv_id"]: r for r in digests(rendered).collect()}
    text = "user\n[INST]\\\\[INST]\nassistant\nc<|end|>\nd\n"
    assert said[1]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert said[1]["loss_sha256"] == hashlib.sha256(b"c<|end|>\nd").hexdigest()
    assert (said[1]["n_turns"], said[1]["loss_chars"], said[None]["n_turns"]) == (2, 10, 1)
    assert said[None]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest()
    turns = spark.createDataFrame([(7, 0, "user", "x"), (7, 0, "user", "x"), (7, None, "r\n\\n", "y")],
                                  "conv_id long, turn long, role string, text string")
    (got,) = digests(render(fold_events(turn_events(turns)))).collect()
    assert got["turns_sha256"] == hashlib.sha256(b"r\n\\n\ny\nuser\nx\nuser\nx\n").hexdigest()
    assert digests(render(fold_events(turn_events(turns.limit(0))))).count() == 0


def test_loss_digest_is_the_text_under_the_mask(spark):
    from pyspark.sql import functions as F

    from tripledger.llm.op1_chat_format import digests, fold_events, render, turn_events

    rng = random.Random(2)
    parts = ["é", "日本", "🙂", "plain words ", "</s>", "\\<|end|>", "\n", "<|turn|>"]
    turns = [(c, i, rng.choice(["user", "assistant", "tool\n"]),
              "".join(rng.choice(parts) for _ in range(rng.randint(0, 12))))
             for c in range(6) for i in range(c * 15)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rendered = render(fold_events(turn_events(table)))
    loss = {c: "".join(t for d, _, r, t in turns if d == c and r == "assistant") for c in range(1, 6)}
    got = {r["conv_id"]: (r["loss_chars"], r["loss_sha256"]) for r in digests(rendered).collect()}
    assert got == {c: (len(t), hashlib.sha256(t.encode()).hexdigest()) for c, t in loss.items()}
    # Another mask gives other text: here three code points of the first mark.
    marks = rendered.withColumn("loss_spans", F.expr(
        "transform(array(0, 1, 6), x -> struct(cast(x as bigint) as start, 1L as length))"))
    assert {r["loss_sha256"] for r in digests(marks).collect()} == {hashlib.sha256(b"<||").hexdigest()}


def test_bpe_equals_the_library(spark, docs, empty):
    from tokenizers import Tokenizer

    from tripledger.llm.op8_bpe import digests, encode, vocabulary_path

    library = Tokenizer.from_file(vocabulary_path())
    rng = random.Random(1)
    alphabet = "aAbth eing \n\t.,!?'\"01éÉß \x85\x1cΣİ́日🙂<|>½²ªœ÷×"
    odd = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(300)]
    odd += ["it's ''s we'll", "<|endoftext|>a<|startoftext|>", "a" * 3000, "ΣΑΣ Σ"]
    table = docs.select("doc_id", "text").union(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    expected = []
    for doc_id, text in [(r[0], r[1]) for r in ROWS] + [(1000 + i, t) for i, t in enumerate(odd)]:
        ids = library.encode(text or "", add_special_tokens=False).ids
        plain = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(plain.encode()).hexdigest()))
    got = digests(table, vocabulary_path())
    assert _bag(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert encode(empty, vocabulary_path()).count() == 0


def test_packing_is_gapless_and_tight(docs, empty):
    from tokenizers import Tokenizer

    from tripledger.llm.op3_packing import pack_documents, plan
    from tripledger.llm.op8_bpe import vocabulary_path

    import numpy as np

    library = Tokenizer.from_file(vocabulary_path())
    ids = {(r[0], r[1]): library.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in ROWS}
    pieces = pack_documents(docs, vocabulary_path()).collect()
    expected = [(doc_id, s, len(v[s:s + 2048]), zlib.crc32(np.array(v[s:s + 2048], "<u4").tobytes()), len(v))
                for doc_id, text, _ in ROWS for v in [ids[doc_id, text]] for s in range(0, len(v), 2048)]
    assert sorted(expected, key=repr) == sorted(
        ((p["doc_id"], p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in pieces), key=repr)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack_documents(empty, vocabulary_path()).count() == 0
    histogram = {n: random.Random(n).randint(1, 50) for n in range(1, 2048, 7)}
    patterns = plan(histogram)
    placed = defaultdict(int)
    for pattern, count in patterns:
        assert sum(pattern) <= 2048
        for length in pattern:
            placed[length] += count
    assert placed == histogram
    used = sum(n * c for n, c in histogram.items())
    assert used > 0.97 * 2048 * sum(c for _, c in patterns)


def _shingles(text):
    words = (text or "").encode().translate(LOW).split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def _classes(rows, percent):
    sets = [(_key(d), _shingles(t)) for d, t, _ in rows]
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                a_, b_ = root(a), root(b)
                up[max(a_, b_)] = min(a_, b_)
    return {d: root(d) for d in up}, sets


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_match_brute_force(docs, empty, block, monkeypatch):
    from tripledger.llm import op6_near_dedup as op

    links = op.confirm_links
    monkeypatch.setattr(op, "confirm_links", lambda m, d, p: links(m, d, p, block))
    roots, sets = _classes(ROWS, 85)
    expected = sorted(((d if d != _key(None) else None, len(s),
                        None if roots[d] == _key(None) else roots[d], roots[d] == d)
                       for d, s in sets), key=repr)
    got = op.near_duplicates(docs, 85)
    assert _bag(got, "doc_id", "n_shingles", "component_id", "kept") == expected
    if block == 512:
        assert op.near_duplicates(empty, 85).count() == 0


def test_components_of_a_path_and_a_star(spark):
    from tripledger.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)],
                                  "a long, b long")
    got = dict(_bag(components(links), "node", "component"))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


@pytest.mark.parametrize("target", [13, 30])
def test_word_windows_match_brute_force(docs, empty, target):
    from tripledger.llm.op9_substring_dedup import dedup

    first = {}
    for doc_id, text, _ in sorted(ROWS, key=lambda r: _key(r[0])):
        words = (text or "").encode().split()
        for i in range(len(words) - target + 1):
            first.setdefault(tuple(words[i:i + target]), _key(doc_id))
    expected = []
    for doc_id, text, _ in ROWS:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - target + 1):
            if first[tuple(words[i:i + target])] < _key(doc_id):
                gone.update(range(i, i + target))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        expected.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    assert _bag(dedup(docs, target), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        expected, key=repr)
    assert dedup(empty, target).count() == 0


def test_byte_strings_match_brute_force(docs, empty):
    from tripledger.llm.op10_suffix_dedup import cut_texts, dedup

    # Different texts under one id are ordered by their hash: leave out the NULL pair.
    rows = [r for r in ROWS if r[0] is not None]
    seen, result = set(), {}
    for doc_id, text, _ in sorted(set(rows), key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(raw[i:i + 100])
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        result[doc_id] = (doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    given = docs.where("doc_id IS NOT NULL")
    assert _bag(dedup(given), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(
        (result[r[0]][:5] for r in rows), key=repr)
    cut = cut_texts(given)
    assert cut.columns == given.columns
    assert _bag(cut, "doc_id", "text") == sorted(
        ((r[0], None if r[1] is None else result[r[0]][5].decode("utf-8", "ignore")) for r in rows), key=repr)
    assert dedup(empty).count() == 0
    assert dedup(docs).count() == len(ROWS)


def test_no_task_holds_all_windows_of_a_hot_lead(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tripledger.llm import op10_suffix_dedup as op

    rng = random.Random(8)

    def noise(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    line, passage = noise(70), noise(260)
    rows = [(i, noise(150) + (line if i % 2 else passage) + noise(150), "x") for i in range(60)]
    rows += [(60, rows[0][1][20:300], "x"), (61, passage * 2, "x"), rows[1]]
    seen, expected = set(), {}
    for doc_id, text, _ in sorted(set(rows)):
        raw, gone = text.encode(), set()
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in seen:
                gone.update(range(i, i + 100))
            seen.add(raw[i:i + 100])
        kept = bytes(c for i, c in enumerate(raw) if i not in gone)
        expected[doc_id] = (doc_id, len(gone), hashlib.sha256(kept).hexdigest())

    monkeypatch.setattr(op, "WINDOWS", 40)
    sort_bucket, largest = op._sort_bucket, []

    def watched(records, length, lead):
        largest.append(records.groupBy(F.expr(f"substring(text, back + 1, {lead})").alias("k")).agg(
            F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0)
        return sort_bucket(records, length, lead)

    monkeypatch.setattr(op, "_sort_bucket", watched)
    got = op.dedup(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert _bag(got, "doc_id", "n_removed", "kept_sha256") == sorted(
        (expected[r[0]] for r in rows), key=repr)
    assert largest and max(largest) <= 40


def test_nearest_match_brute_force(spark):
    import numpy as np

    from tripledger.llm.op7_nearest import nearest

    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype("f4")]) for i in range(300)]
    rows += [(300, None), (301, [0.0] * 8), (302, [float("nan")] + [1.0] * 7), (303, [None] + [1.0] * 7),
             (304, rows[0][1]), (305, rows[0][1]), (306, [1.0, 2.0]), (None, rows[1][1]), (307, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v
            and np.isfinite(v).all() and np.any(v) and len(v) == 8]
    expected = []
    for q, v in good:
        if q % 50 == 0:
            near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))), i)
                          for i, w in good if i != q)[:10]
            expected += [(q, k + 1, i, s) for k, (s, i) in enumerate(near)]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"])
                 for r in nearest(table.where("vec_id % 50 = 0"), table, 10).collect())
    assert [g[:3] for g in got] == [e[:3] for e in sorted(expected)]
    assert all(abs(g[3] - e[3]) < 1e-12 for g, e in zip(got, sorted(expected)))
    assert nearest(table.limit(0), table, 10).count() == 0


def test_nearest_of_any_size_over_a_grid_of_bins(spark, monkeypatch):
    """Vectors from 1e-300 to 1e160 and beyond, over many bins, against brute force."""
    import math

    import numpy as np

    from tripledger.llm import op7_nearest as O

    rng = np.random.default_rng(8)
    sizes = [1e160, 1e160, 1.0, 1.0, 1e-170, 1e-300]
    rows = [(i, [float(v) * sizes[i % 6] for v in rng.normal(size=6)]) for i in range(240)]
    rows += [(240, [1.5e308] * 6), (241, [-1.5e308] * 6), (242, [1.5e308] * 6),
             (243, [5e-324] + [0.0] * 5), (244, [0.0, 5e-324] + [0.0] * 4)]
    # The name of an operator's own column, and one with a dot, as extra columns.
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows],
                                  "vec_id long, embedding array<double>, q_bin int, `a.b` int")

    def distance(a, b):
        diff = [x - y for x, y in zip(a, b)]
        return math.inf if any(map(math.isinf, diff)) else math.hypot(*diff)

    expected = {q: sorted((distance(v, w), i) for i, w in rows if i != q)[:5]
                for q, v in rows if q % 9 == 0 or q > 239}
    for bin_bytes in (64 << 20, 2000):
        monkeypatch.setattr(O, "BIN_BYTES", bin_bytes)
        monkeypatch.setattr(O, "BLOCK_BYTES", 1 << 20 if bin_bytes > 2000 else 500)
        got = {}
        for r in O.nearest(table.where("vec_id % 9 = 0 or vec_id > 239").repartition(2),
                           table.repartition(3), 5).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert sorted(got) == sorted(expected)
        for q, near in expected.items():
            assert [g[0] for g in got[q]] == pytest.approx([n[0] for n in near], rel=1e-12, abs=0)
            if math.isfinite(near[-1][0]) and len({n[0] for n in near}) == 5:
                assert [g[1] for g in got[q]] == [n[1] for n in near]


def test_grid_follows_the_bytes():
    from tripledger.llm.op7_nearest import BIN_BYTES, grid

    assert grid(0, 0, 32) == (1, 32)
    assert grid(BIN_BYTES * 10, BIN_BYTES * 1000, 32) == (10, 1000)


@pytest.mark.parametrize("name,column,recall,false", [
    ("op4_toxicity", "toxic", 0.7, 0.05), ("op5_quality_classifier", "quality", 0.95, 0.2)])
def test_classifiers_hold_out(spark, name, column, recall, false):
    from tripledger.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    ones = [r["predicted"] for r in rows if labels[r["doc_id"]] == 1]
    zeros = [r["predicted"] for r in rows if labels[r["doc_id"]] == 0]
    assert sum(ones) >= recall * len(ones) and sum(zeros) <= false * len(zeros) + 1


def test_classifiers_without_labels_and_odd_rows(spark, docs, empty):
    from tripledger.llm import op4_toxicity, op5_quality_classifier

    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(40)] + [(None, 1, 1), (3, None, None)],
        "doc_id long, quality int, toxic int")
    for op in (op4_toxicity, op5_quality_classifier):
        assert op.train(docs, none) is None
        assert {r["score"] for r in op.score(docs, None).collect()} == {0.5}
        scores = op.score(docs, op.train(docs, labels)).collect()
        assert len(scores) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scores)
        assert op.score(empty, None).count() == 0


def _sentences(texts):
    import numpy as np
    import pyarrow as pa

    from tripledger.llm import op4_toxicity as op
    from tripledger.llm import textbytes as tb

    (_, _, data, offsets), = tb.chunks(pa.array(texts))
    features, full, sentence, first = op.word_features(data, offsets)
    doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(sentence, first)))
    return (features, sentence, doc, op.named_terms(full)), (data, offsets)


def test_swapped_sentences_and_their_gradient():
    import numpy as np

    from tripledger.llm import op4_toxicity as op

    (_, sentence, doc, named), _ = _sentences(
        ["The women sing. Nobody came! Old men and women", "a walk. another", "Jews pray"])
    terms, group, _, _ = op.term_features()
    swaps = op.counterfactuals(named, sentence)
    seen = [(int(s), terms[o] if o >= 0 else None, terms[i])
            for s, o, i in zip(swaps.sentence, swaps.out, swaps.into)]
    expected = [(s, t, other) for s, own in ((0, ["women"]), (2, ["old", "men", "women"]),
                                             (5, ["jews"])) for t in own
                for other, k in zip(terms, group) if k == group[terms.index(t)] and other != t]
    bare = [(s, None, terms[i]) for i, s in enumerate((1, 3, 4))]
    assert sorted(seen, key=repr) == sorted(expected + bare, key=repr)

    rng = np.random.default_rng(4)
    z, u = rng.normal(size=len(sentence)), rng.normal(size=len(terms))
    head = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))

    def by_hand(z, u):
        def pooled(z, d):
            own = z[doc == d]
            return (np.exp(own) * own).sum() / np.exp(own).sum()

        total = 0.0
        for s, o, i, w in zip(swaps.sentence, swaps.out, swaps.into, swaps.weight):
            moved = z.copy()
            moved[s] += u[i] - (u[o] if o >= 0 else 0)
            total += w * (pooled(moved, doc[s]) - pooled(z, doc[s])) ** 2
        return total

    value, by_sentence, by_term = op.swap_penalty(z, u, head, doc, swaps)
    assert abs(value - by_hand(z, u)) < 1e-9
    for k, gradient in ((0, by_sentence), (1, by_term)):
        for i in range(len(gradient)):
            step = [np.zeros_like(z), np.zeros_like(u)]
            step[k][i] = 1e-6
            slope = (by_hand(z + step[0], u + step[1]) - by_hand(z - step[0], u - step[1])) / 2e-6
            assert abs(slope - gradient[i]) < 1e-6


def test_identity_swaps_lower_a_neutral_mention():
    import numpy as np

    from tripledger.llm import op4_toxicity as op

    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    toxic = [f"the women are {rng.choice(['scum', 'vermin', 'filth'])} {word()}. {word()} day"
             for _ in range(200)]
    clean = [f"the {word()} are a fine day for walking. {word()} day" for _ in range(200)]
    neutral = [f"the {t} had a fine day for walking" for t in ("women", "men", "girls", "boys")]
    (features, sentence, doc, named), _ = _sentences(toxic + clean)
    label = np.array([1] * 200 + [0] * 200)
    _, held = _sentences(neutral + [f"they are {x} indeed" for x in ("scum", "vermin", "filth")])

    def scores(penalty):
        return op.fit(features, sentence, doc, label, named, penalty).score(*held)

    plain, fair = scores(0.0), scores(op.PENALTY)
    assert plain[0] >= op.THRESHOLD  # naming women is toxic to the plain classifier
    assert (fair[:4] < op.THRESHOLD).all() and fair[0] < plain[0] - 0.2
    assert (fair[4:] >= op.THRESHOLD).all()


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet")
    docs, texts = given, None
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / str(k))
        step(spark, docs, sf).write.parquet(out)
        after = spark.read.parquet(out)
        if name != "packing":
            assert after.columns == given.columns
        if name == "near_dedup":
            rows = [(r["doc_id"], r["text"], None) for r in docs.collect()]
            roots, _ = _classes(rows, corpus_pipeline.SIMILARITY)
            assert sorted(r["doc_id"] for r in after.collect()) == sorted(d for d in roots if roots[d] == d)
        if name == "suffix_dedup":
            texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in after.collect()}
            assert all(n == len(t) for t, n in texts.values())
        docs = after
    assert {r["doc_id"] for r in docs.collect()} == set(texts)
    assert corpus_pipeline.run(spark, sf).count() == docs.count()


def test_pipeline_keeps_one_row_of_each_class(spark, docs, empty):
    import corpus_pipeline

    near = ROWS[40][1].split(" ")
    more = [(None, ROWS[5][1], "null copy"), (None, ROWS[6][1], "null copy"),
            (None, ROWS[6][1], "null copy"), (None, " ".join(["other", *near[1:]]), "null near"),
            (7, "a text of its own under an id that is there", "x"), (53, "", "n"), (54, "one two", "n"),
            (55, "One  two", "n")]
    table = docs.union(spark.createDataFrame(more, SCHEMA))
    rows = sorted({(d, t) for d, t, _ in ROWS + more},
                  key=lambda r: (_key(r[0]), r[1] or ""))
    roots, _ = _classes([(i, t, None) for i, (_, t) in enumerate(rows)], corpus_pipeline.SIMILARITY)
    expected = sorted((rows[i] for i in roots if roots[i] == i), key=repr)
    got = corpus_pipeline.near_dedup(spark, table, "")
    assert got.columns == table.columns
    assert _bag(got, "doc_id", "text") == expected
    assert corpus_pipeline.near_dedup(spark, empty, "").count() == 0


def test_suffix_buckets_sort_only_records_that_differ_and_share_a_lead():
    from tripledger.llm.op10_suffix_dedup import _apart

    lead = b"L" * 48
    one, other, alone = b"a" * 60 + lead, b"b" * 60 + lead, b"c" * 60 + b"M" * 48
    records = sorted([(1, 0, 5, 9, 60, one), (2, 0, 0, 9, 60, one), (2, 0, 80, 9, 60, one),
                      (3, 0, 1, 9, 60, other), (4, 0, 2, 9, 60, alone), (5, 0, 2, 9, 60, alone)])
    rows, copies = _apart(records, 48)
    assert [r[:3] for r in rows] == [(1, 0, 5), (3, 0, 1)]
    assert [r[:3] for r in copies] == [(2, 0, 0), (2, 0, 80), (5, 0, 2)]
