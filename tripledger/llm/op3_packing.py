"""Packing documents into sequences by shortest-pack-first over the length histogram.

1. ``pieces``: every document's ids (and the end id) are cut into full
   sequences and one remainder; each piece is a row.
2. Only the histogram of piece lengths (at most ``size`` rows, whatever the
   corpus) reaches the driver.  ``plan`` places the lengths longest first,
   each into the shortest packs that still take it, and updates how often each
   pattern of lengths occurs; the plan has a few thousand patterns at most.
3. ``pack`` ranks the pieces of each length and joins ranks to pattern slots:
   slot k of a pattern with count c takes c consecutive ranks of its length.

Ranks are counted per (length, salt) and shifted by the salts' totals, so a
length that a third of all documents share is not ranked in one task.

Defined results: NULL text is empty (its only id is the end id); NULL doc_id
is carried through; repeated rows are packed each; a document longer than a
sequence fills whole sequences first; an empty table gives no rows; other input
columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripledger.llm import frames
from tripledger.llm.op8_bpe import vocabulary_path
from tripledger.llm.pretokens import PretokenTable, Vocabulary, symbols

SIZE = 2048
END_ID = 1

PIECE_SCHEMA = ("did long, rid long, start long, length long, ids_crc32 long, "
                "doc_tokens long")
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"

_tables: dict[str, PretokenTable] = {}


def _table(path: str) -> PretokenTable:
    """This worker's table of pre-tokens and the library's ids for them."""
    if path not in _tables:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path).model

        def work(word):
            ids = [word] if isinstance(word, int) else [
                t.id for t in model.tokenize(symbols(word))]
            return (np.array(ids, "<u4").tobytes(),)

        _tables[path] = PretokenTable(Vocabulary(path), work)
    return _tables[path]


def pieces(documents: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: did, rid, start, length, ids_crc32, doc_tokens."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        table = _table(path)
        for batch in batches:
            dids = batch.column(0).to_pylist()
            rids = batch.column(1).to_pylist()
            out = []
            for did, rid, facets in zip(dids, rids, table.rows(batch.column(2))):
                ids = b"".join([f[0] for f in facets]) + end
                total = len(ids) // 4
                for start in range(0, total, size):
                    part = ids[4 * start:4 * (start + size)]
                    out.append((did, rid, start, len(part) // 4, zlib.crc32(part), total))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["did", "rid", "start", "length", "ids_crc32", "doc_tokens"])

    return frames.keyed(documents).mapInArrow(run, PIECE_SCHEMA)


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each occurs.

    Lengths are placed longest first.  The packs that take a length are those
    with at most ``size - length`` in them; the shortest come first.  A pattern
    that is only partly used is split by its count.
    """
    packs: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # filled -> pattern -> count
    filled: list[int] = []  # sorted keys of packs that can still take something

    def add(pattern, count):
        total = sum(pattern)
        if pattern not in packs[total] and not packs[total]:
            at = bisect_left(filled, total)
            if at == len(filled) or filled[at] != total:
                filled.insert(at, total)
        packs[total][pattern] = packs[total].get(pattern, 0) + count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        made: list[tuple[tuple[int, ...], int]] = []
        while left and filled and filled[0] + length <= size:
            total = filled[0]
            pattern, count = packs[total].popitem()
            if not packs[total]:
                filled.pop(0)
            # One pack may take the length more than once when it is that empty.
            times = min((size - total) // length, max(1, left // count))
            used = min(count, left // times)
            made.append((pattern + (length,) * times, used))
            left -= used * times
            if used < count:
                add(pattern, count - used)
        per_pack = size // length
        if left >= per_pack:
            made.append(((length,) * per_pack, left // per_pack))
        if left % per_pack:
            made.append(((length,) * (left % per_pack), 1))
        for pattern, count in made:
            add(pattern, count)
    return [(pattern, count) for total in sorted(packs, reverse=True)
            for pattern, count in packs[total].items()]


def slots(patterns: list[tuple[tuple[int, ...], int]]):
    """Columns (length, first rank, last rank + 1, offset, first sequence) by length and rank."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used[length], used[length] + count, offset, sequence))
            used[length] += count
            offset += length
        sequence += count
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """The pieces with sequence_id and offset.  ``cut`` must be a stored stage."""
    spark = cut.sparkSession
    salts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("rid", "start"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    # At most size * salts rows: the running totals over each length's salts.
    shift = counts.select("length", "salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("shift"))
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(histogram, size))
    key = (table[:, 0] << 44) + table[:, 1]  # (length, first rank), ascending

    own = Window.partitionBy("length", "salt").orderBy("did", "rid", "start")
    ranked = (salted.withColumn("own", F.row_number().over(own) - 1)
              .join(shift, ["length", "salt"])
              .select("did", "rid", "start", "length", "ids_crc32", "doc_tokens",
                      (F.col("own") + F.col("shift")).alias("rank")))

    def place(batches):
        for batch in batches:
            length = np.asarray(batch.column(3))
            rank = np.asarray(batch.column(6))
            slot = np.searchsorted(key, (length << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6],
                 pa.array(table[slot, 4] + rank - table[slot, 1]), pa.array(table[slot, 3])],
                names=[*batch.schema.names[:6], "sequence_id", "offset"])

    return ranked.mapInArrow(place, PACKED_SCHEMA)


def pack_documents(documents: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece."""
    cut = frames.stage(pieces(documents, path, size), "pieces")
    return pack(cut, size).select(
        frames.public_id().alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
        "sequence_id", "offset")


def op3(spark, sf_dir: str) -> DataFrame:
    """Pack every document of ``documents``."""
    return pack_documents(frames.table(spark, sf_dir, "documents"), vocabulary_path())
