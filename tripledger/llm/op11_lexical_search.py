"""Ranked lexical search by bag deduplication: equal documents are scored once.

1. ``bags``: every whole text becomes its length in terms and its bag, the
   counts of those terms that some item has (the item vocabulary).
2. Corpus statistics over all documents: N, L and each vocabulary term's df.
3. ``bag_classes``: documents with the same bag and the same length norm m get
   the same score for every item.  They meet by a hash of both, then by the
   bytes themselves; a class keeps its ``k`` smallest doc_ids, as no item can
   list more.  That limit is applied before the shuffle as well, so a class
   with a third of all documents costs a task at most ``k`` rows.
4. A class is scored once for all items: a term adds the same amount to every
   item that has it.  A task keeps the ``k`` best documents per item and hands
   on only those; classes expand to members by ascending doc_id.

The items are held in every task, so they are dealt into blocks of at most
``BLOCK_BYTES`` of text (or one item) and the blocks searched one after the
other, each against all documents.

A term's weight, m and the scores are as ``weights`` and ``norms`` say: weights
in doubles, all else in integers, divisions rounding down.

Defined results: NULL or empty text has no terms, counts in neither N nor L and
is found by nothing; a NULL or empty item has no result; rows that share a
doc_id are documents of their own; NULL doc_id is the smallest; repeated items
(equal item_id) are one item of all their terms, a NULL item_id one of its own;
with no documents or no items there are no rows; other input columns are not
read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripledger.llm import frames
from tripledger.llm.frames import release, stage

BLOCK_BYTES = 4 << 20  # of item texts that a task holds
PIECE = 1 << 20  # bytes of a text that are cut into terms at once
CELLS = 1 << 19  # scores (classes x items) that a task works out at once
SALTS = 64

# Bytes that terms are made of; A-Z lower-cased, all others a blank.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32
               for b in range(256))


def count_terms(text: bytes) -> Counter:
    """Terms of a whole text with their occurrences."""
    plain, counts, at = text.translate(_TERMS), Counter(), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        counts.update(plain[at:end].split())
        at = end
    return counts


class Items:
    """A block of items: their vocabulary and which items have each term."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        terms: dict[int | None, set[bytes]] = {}
        for item, text in rows:
            terms.setdefault(item, set()).update(count_terms((text or "").encode("utf-8")))
        self.ids = list(terms)
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*terms.values())))}
        pairs = sorted((self.vocabulary[t], i) for i, of in enumerate(terms.values()) for t in of)
        self.item = np.array([i for _, i in pairs], np.int64)
        self.first = np.searchsorted(np.array([t for t, _ in pairs], np.int64),
                                     np.arange(len(self.vocabulary) + 1))


def bags(documents: DataFrame, items: Items) -> DataFrame:
    """did, n (terms), bag (term numbers ascending, then their counts; int32 and int64)."""
    vocabulary = items.vocabulary

    def run(batches):
        for batch in batches:
            sizes, packed = [], []
            for text in batch.column(1).cast(pa.large_binary()):
                counts = count_terms(text.as_py())
                sizes.append(counts.total())
                held = sorted((vocabulary[t], counts[t]) for t in counts.keys() & vocabulary.keys())
                packed.append(np.array([t for t, _ in held], "<i4").tobytes()
                              + np.array([c for _, c in held], "<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                names=["did", "n", "bag"])

    return frames.keyed(documents).select("did", "text").mapInArrow(
        run, "did long, n long, bag binary")


def unpacked(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and counts of a bag."""
    n = len(bag) // 12
    return np.frombuffer(bag, "<i4", n), np.frombuffer(bag, "<i8", n, 4 * n)


def statistics(rows: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """N, L, and the df of each vocabulary term (as many rows as the block has terms)."""
    def held(batches):
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            for bag in batch.column(0):
                df[unpacked(bag.as_py())[0]] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int64)), pa.array(df[some])], names=["term", "df"])

    total = rows.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(n_terms, np.int64)
    for row in rows.select("bag").mapInArrow(held, "term long, df long").groupBy("term").agg(
            F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    return total["docs"], total["terms"] or 0, df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2 * N + 2) / (2 * df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1)))
                     for d in df], np.int64)


def norms(sizes: list[int], n_docs: int, n_terms: int) -> list[int]:
    """m of documents with these numbers of terms, in exact integers."""
    return [100 - 90 + 90 * n * n_docs // n_terms for n in sizes]


def bag_classes(rows: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """m, bag, dids (the ``k`` smallest, ascending) of each class of equal bag and m."""
    def normed(batches):
        for batch in batches:
            m = norms(batch.column(1).to_pylist(), n_docs, n_terms)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(m, pa.int64()), batch.column(2)],
                names=["did", "m", "bag"])

    filled = rows.where(F.length("bag") > 0).select("did", "n", "bag").mapInArrow(
        normed, "did long, m long, bag binary").withColumn("hash", F.xxhash64("bag", "m"))
    same = ["hash", "m", "bag"]
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("did"))
    return filled.withColumn("nth", nth).where(F.col("nth") <= k).groupBy(*same).agg(
        F.sort_array(F.collect_list("did")).alias("dids")).drop("hash")


class _Best:
    """The k best (score, did) of each item seen so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64)] * n_items
        self.dids = [np.zeros(0, np.int64)] * n_items

    def add(self, item: int, scores: np.ndarray, members: list[np.ndarray]) -> None:
        """Classes with these scores and members (each ascending)."""
        least = self.scores[item][-1] if len(self.scores[item]) == self.k else 1
        at = np.flatnonzero(scores >= least)
        if not len(at):
            return
        if len(at) > self.k:  # the k best classes hold the k best documents
            first = np.array([members[i][0] for i in at.tolist()], np.int64)
            at = at[np.lexsort((first, -scores[at]))[:self.k]]
        dids = [members[i][:self.k] for i in at.tolist()]
        own = np.repeat(scores[at], [len(d) for d in dids])
        every = np.concatenate([self.scores[item], own])
        ids = np.concatenate([self.dids[item], *dids])
        order = np.lexsort((ids, -every))[:self.k]
        self.scores[item], self.dids[item] = every[order], ids[order]


def score_classes(classes: DataFrame, items: Items, weight: np.ndarray, k: int) -> DataFrame:
    """(item number, did, score): per task the ``k`` best documents of each item."""
    n_items, item, first = len(items.ids), items.item, items.first

    def run(batches):
        best, step = _Best(n_items, k), max(1, CELLS // max(1, n_items))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                held = [unpacked(b.as_py()) for b in batch.column(1)]
                sizes = np.array([len(t) for t, _ in held])
                row = np.repeat(np.arange(len(held)), sizes)
                m = np.asarray(batch.column(0))[row]
                term = np.concatenate([t for t, _ in held]).astype(np.int64)
                tf = np.concatenate([c for _, c in held])
                gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                fan = first[term + 1] - first[term]  # items that have the term
                of = np.repeat(first[term] - (np.cumsum(fan) - fan), fan) + np.arange(fan.sum())
                scores = np.zeros((n_items, len(held)), np.int64)
                np.add.at(scores, (item[of], np.repeat(row, fan)), np.repeat(gain, fan))
                members = [np.asarray(d.values) for d in batch.column(2)]
                for i in range(n_items):
                    best.add(i, scores[i], members)
        sizes = [len(s) for s in best.scores]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(n_items, dtype=np.int32), sizes)),
                 pa.array(np.concatenate(best.dids)), pa.array(np.concatenate(best.scores))],
                names=["item", "did", "score"])

    return classes.select("m", "bag", "dids").mapInArrow(run, "item int, did long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows per item with their rank; first within parts of an item."""
    order = [F.desc("score"), F.asc("did")]
    part = Window.partitionBy("item", "part").orderBy(*order)
    some = found.withColumn("part", F.pmod(F.xxhash64("did"), F.lit(SALTS))).withColumn(
        "nth", F.row_number().over(part)).where(F.col("nth") <= k)
    return some.withColumn("rank", F.row_number().over(
        Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def item_blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> tuple[DataFrame, list[str]]:
    """(item_id, text, block) and the names of the blocks, each of at most ``limit``
    bytes of text or of one item."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    large = rows.groupBy("item_id").agg(F.sum(F.octet_length("text")).alias("bytes")).where(
        F.col("bytes") > limit).select(F.col("item_id").alias("id"), F.lit(True).alias("large"))
    n = 1
    while True:
        dealt = rows.join(large, rows["item_id"].eqNullSafe(large["id"]), "left").select(
            "item_id", "text", F.when(F.col("large"), F.concat(F.lit("item "), F.coalesce(
                F.col("item_id").cast("string"), F.lit("NULL")))).otherwise(
                F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("string")).alias("block"))
        sizes = dealt.groupBy("block").agg(
            F.sum(F.octet_length("text")).alias("bytes")).collect()
        if all(r["bytes"] <= limit or r["block"].startswith("item ") for r in sizes):
            return dealt, sorted(r["block"] for r in sizes)
        n *= 2


def search(documents: DataFrame, items: DataFrame, k: int = 10,
           limit: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item."""
    spark = documents.sparkSession
    schema = "item_id long, rank int, doc_id long, score long"
    out = spark.createDataFrame([], schema)
    dealt, blocks = item_blocks(items, limit)
    for block in blocks:
        own = Items([(r["item_id"], r["text"]) for r in
                     dealt.where(F.col("block") == block).collect()])
        if not own.vocabulary:
            continue
        rows = stage(bags(documents, own), "bags")
        n_docs, n_terms, df = statistics(rows, len(own.vocabulary))
        if n_docs == 0:
            release(rows)
            continue
        found = score_classes(bag_classes(rows, n_docs, n_terms, k), own, weights(n_docs, df), k)
        names = spark.createDataFrame(list(enumerate(own.ids)), "item int, item_id long")
        best = stage(_ranked(found, k).join(F.broadcast(names), "item").select(
            "item_id", "rank", frames.public_id().alias("doc_id"), "score"), "found")
        release(rows)
        out = out.union(best)
    return out


def op11(spark, sf_dir: str) -> DataFrame:
    """The 10 documents that score highest for every ``benchmark`` item."""
    return search(frames.table(spark, sf_dir, "documents"),
                  frames.table(spark, sf_dir, "benchmark"), 10)
