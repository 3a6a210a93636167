"""Nearest neighbours by a block matrix join over int8 products.

Queries and candidates are cut into blocks of fixed size; a tile is one query
block against one candidate block.  In a tile, int8 codes give all inner
products at once; with each vector's known quantisation error they bound every
distance from both sides.  A pair whose lower bound is above the query's k-th
smallest upper bound cannot be among the k nearest; only the others are
recomputed in double precision from the original vectors.  Heaps merge the
tiles of a task, and the few survivors of all tasks are merged per query.
The result is exact: recall against brute force is 1.

Query blocks and row blocks are dealt over a grid of query bins x row bins whose
sides come from the bytes of both inputs, not from the number of shuffle
partitions: a row block goes to each query bin once, a query block to each row
bin once, and a task is handed each block of its bin once and coded once.

Memory: the blocks of one bin of each side (about ``BIN_BYTES`` each) and one
tile, ``QUERY_BLOCK`` x ``ROW_BLOCK`` numbers, blocks being at most
``BLOCK_BYTES``.  A query block meets every row block (a stated query set against
all rows, in blocks); nothing is broadcast and no pair leaves a task but the
best k.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part, neither as queries nor as candidates; only vectors of
equal length are compared; a query's own row is every row with its vec_id;
repeated candidate rows count each; repeated query rows count once (the
smallest vector); ties go to the smaller vec_id; rows without vec_id take no
part; bounds are held as multiples of a power of two, so finite vectors of any
size have neighbours, a distance beyond the largest double being infinite; fewer than k candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY_BLOCK = 512
ROW_BLOCK = 4096
BLOCK_BYTES = 1 << 20  # of a block of long vectors, which has fewer rows
BIN_BYTES = 64 << 20  # vectors (and heaps) of one side that a task holds, about
HEAP_BYTES = 100  # of one neighbour kept in a heap
_EXACT = 1 << 24  # whole numbers below this are exact in float32

BLOCK_SCHEMA = "dim int, block long, ids binary, vectors binary"
FOUND_SCHEMA = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Whether a vector takes part: components all finite, not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (vec_id, vector, dim) cut into blocks of one dimension each.

    Blocks are formed inside the partitions of the scan, so no key gathers
    rows; the last block of a partition may be short.
    """
    def cut(batches):
        part = None
        kept: dict[int, list] = {}
        made = 0

        def flush(dim, n):
            nonlocal made
            ids, vectors = kept[dim]
            ids_now, vectors_now = ids[:n], vectors[:n]
            kept[dim] = [ids[n:], vectors[n:]]
            made += 1
            return pa.RecordBatch.from_pydict({
                "dim": [dim], "block": [(part << 33) + made],
                "ids": [ids_now.astype("<i8").tobytes()],
                "vectors": [np.ascontiguousarray(vectors_now, "<f8").tobytes()]},
                schema=_BLOCK_ARROW)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            dims = np.asarray(batch.column("dim"))
            ids = np.asarray(batch.column("vec_id"))
            for dim in np.unique(dims).tolist():
                here = np.flatnonzero(dims == dim)
                flat = batch.column("vector").take(pa.array(here)).flatten()
                new = np.asarray(flat, np.float64).reshape(len(here), dim)
                rows_each = max(1, min(size, BLOCK_BYTES // (8 * dim)))
                old = kept.get(dim)
                kept[dim] = [ids[here], new] if old is None else [
                    np.concatenate([old[0], ids[here]]), np.concatenate([old[1], new])]
                while len(kept[dim][0]) >= rows_each:
                    yield flush(dim, rows_each)
        for dim in list(kept):
            if len(kept[dim][0]):
                yield flush(dim, size)

    return rows.withColumn("part", F.spark_partition_id()).mapInArrow(cut, BLOCK_SCHEMA)


_BLOCK_ARROW = pa.schema([("dim", pa.int32()), ("block", pa.int64()),
                          ("ids", pa.binary()), ("vectors", pa.binary())])


class _Coded:
    """A block's vectors as int8 codes: each vector is scaled by the power of two
    that brings its largest component into [0.5, 1), and known by that exponent,
    its codes (as float32), their unit, the lengths of the coded vector and of
    the error, and its square length, all in that scale."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.exponent = np.frexp(np.abs(x).max(axis=1))[1]
        scaled = np.ldexp(x, -self.exponent[:, None])
        self.unit = np.abs(scaled).max(axis=1) / 127.0
        codes = np.rint(scaled / self.unit[:, None])
        coded = codes * self.unit[:, None]
        self.codes = codes.astype(np.float32)
        self.length = np.sqrt((coded * coded).sum(axis=1))
        self.error = np.sqrt(((scaled - coded) ** 2).sum(axis=1))
        self.square = (scaled * scaled).sum(axis=1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 codes: slices small enough for float32."""
    step = _EXACT // (127 * 127)
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], step):
        out += a[:, i:i + step] @ b[:, i:i + step].T
    return out


def _distance(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed from the first component.

    Where the squares leave the range of doubles, the differences are scaled by
    a power of two first."""
    with np.errstate(over="ignore", invalid="ignore"):
        total = np.zeros(len(x))
        for d in range(x.shape[1]):
            diff = q[d] - x[:, d]
            total += diff * diff
        out = np.sqrt(total)
        for i in np.flatnonzero(~np.isfinite(total) | (total < 1e-280)):
            diff = q - x[i]
            exponent = int(np.frexp(np.abs(diff).max())[1])
            if np.isfinite(diff).all():
                out[i] = np.ldexp(np.sqrt((np.ldexp(diff, -exponent) ** 2).sum()), exponent)
            else:
                out[i] = np.inf
    return out


def _tile(q: _Coded, x: _Coded, k: int, heaps: dict):
    """Offer the candidates of one tile to the queries' heaps.

    Bounds are squares of distances in units of 2 ** ``top``, in which no vector
    component exceeds 1; what is too small for that scale counts as zero, which
    the room for rounding covers."""
    top = int(max(q.exponent.max(), x.exponent.max()))
    q_up, x_up = q.exponent - top, x.exponent - top
    dot = (_products(q.codes, x.codes) * np.ldexp(q.unit, q_up)[:, None]
           * np.ldexp(x.unit, x_up)[None, :])
    q_len, q_err = np.ldexp(q.length, q_up)[:, None], np.ldexp(q.error, q_up)[:, None]
    x_len, x_err = np.ldexp(x.length, x_up)[None, :], np.ldexp(x.error, x_up)[None, :]
    square = np.ldexp(q.square, 2 * q_up)[:, None] + np.ldexp(x.square, 2 * x_up)[None, :]
    # Room for the rounding of the bounds themselves.
    off = 2 * (q_len * x_err + q_err * x_len + q_err * x_err) + 1e-9 * (square + 1e-290)
    middle = square - 2 * dot
    low, high = middle - off, middle + off
    own = q.ids[:, None] == x.ids[None, :]
    low[own] = np.inf
    high[own] = np.inf
    if high.shape[1] > k:
        bar = np.partition(high, k - 1, axis=1)[:, k - 1]
        with np.errstate(over="ignore"):  # infinite distances tie: their bounds say nothing
            bar[~np.isfinite(np.ldexp(np.sqrt(np.maximum(bar, 0)), top) * 2)] = np.inf
    else:
        bar = np.full(len(q.ids), np.inf)
    for i in range(len(q.ids)):
        heap = heaps.setdefault(int(q.ids[i]), [])
        limit = bar[i]
        if len(heap) == k:  # worst kept so far, squared, with room for rounding
            with np.errstate(over="ignore"):
                limit = min(limit, np.ldexp(-heap[0][0], -top) ** 2 * (1 + 1e-9))
        near = np.flatnonzero((low[i] <= limit) & ~own[i])
        if not len(near):
            continue
        for score, vec_id in zip(_distance(q.x[i], x.x[near]).tolist(), x.ids[near].tolist()):
            item = (-score, -vec_id)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)


def grid(query_bytes: int, row_bytes: int, tasks: int) -> tuple[int, int]:
    """(query bins, row bins): bins of at most about ``BIN_BYTES``; small inputs
    are cut further, into ``tasks`` tasks, along the rows, which are more."""
    across = max(1, math.ceil(query_bytes / BIN_BYTES))
    down = max(1, math.ceil(row_bytes / BIN_BYTES))
    return across, max(down, math.ceil(tasks / across))


def nearest(queries: DataFrame, rows: DataFrame, k: int = 10,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k nearest rows."""
    def ready(df):
        v = F.col(vector_col).cast("array<double>")
        return df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector")).where(
            F.col("vec_id").isNotNull() & usable(F.col("vector"))
        ).withColumn("dim", F.size("vector"))

    asked = ready(queries).groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn(
        "dim", F.size("vector"))
    everything = ready(rows)

    def total(df, extra):
        return df.agg(F.coalesce(F.sum(F.col("dim").cast("long") * 8 + extra), F.lit(0))).first()[0]

    across, down = grid(total(ready(queries), HEAP_BYTES * k), total(everything, 0),
                        4 * rows.sparkSession.sparkContext.defaultParallelism)

    def to_bins(blocks, own, n_own, other, n_other):
        """Each block to one bin of its side, once for every bin of the other side."""
        return blocks.withColumn(own, F.pmod(F.xxhash64("block"), F.lit(n_own)).cast("int")
                                 ).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    q = to_bins(_blocks(asked, QUERY_BLOCK), "q_bin", across, "x_bin", down)
    x = to_bins(_blocks(everything, ROW_BLOCK), "x_bin", down, "q_bin", across)

    def answers(heaps):
        found = [(q_id, -i, -s) for q_id, heap in heaps.items() for s, i in heap]
        q_ids, ids, scores = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(q_ids, pa.int64()), pa.array(ids, pa.int64()),
             pa.array(scores, pa.float64())], names=["query_id", "vec_id", "score"])

    def coded(blocks: pa.Table):
        for dim, ids, vectors in zip(blocks["dim"], blocks["ids"], blocks["vectors"]):
            yield _Coded(np.frombuffer(ids.as_py(), "<i8"),
                         np.frombuffer(vectors.as_py(), "<f8").reshape(-1, dim.as_py()))

    def search(asked_blocks: pa.Table, row_blocks: pa.Table) -> pa.Table:
        heaps: dict[int, list] = {}
        if asked_blocks.num_rows:
            asked_coded = list(coded(asked_blocks))
            for block in coded(row_blocks):
                for query_block in asked_coded:
                    _tile(query_block, block, k, heaps)
        return pa.Table.from_batches([answers(heaps)])

    def merge(found: pa.Table) -> pa.Table:
        best = heapq.nsmallest(k, zip(found["score"].to_pylist(), found["vec_id"].to_pylist()))
        return pa.table({
            "query_id": pa.array([found["query_id"][0].as_py()] * len(best), pa.int64()),
            "rank": pa.array(range(1, len(best) + 1), pa.int32()),
            "vec_id": pa.array([b[1] for b in best], pa.int64()),
            "score": pa.array([b[0] for b in best], pa.float64())})

    key = ["dim", "q_bin", "x_bin"]
    found = q.groupBy(*key).cogroup(x.groupBy(*key)).applyInArrow(search, FOUND_SCHEMA)
    return found.groupBy("query_id").applyInArrow(
        merge, "query_id long, rank int, vec_id long, score double")
