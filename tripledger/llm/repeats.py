"""Sampled keys of long windows: which of them occur in more than one document.

A window sampled by its content (see ``textbytes.minimizers``) is chosen
wherever an equal stretch of text surrounds it, so text that repeats shares its
samples.  A document's samples that no other document has need no further look.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def split_keys(per_row: list[np.ndarray]):
    """(keys to test, keys known to repeat) of each row of a batch.

    A key that several rows of the batch hold is known to repeat for all of
    them and is tested against the rest of the corpus by the first alone, so a
    key that very many documents share costs one tested row per batch.
    """
    sizes = [len(k) for k in per_row]
    if not sum(sizes):
        return per_row, per_row
    flat = np.concatenate(per_row)
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    first = np.ones(len(flat), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    many = ~first
    many[:-1] |= ~first[1:]
    is_first, is_many = np.empty(len(flat), bool), np.empty(len(flat), bool)
    is_first[order], is_many[order] = first, many
    cuts = np.cumsum(sizes)[:-1]
    test = [k[f] for k, f in zip(per_row, np.split(is_first, cuts))]
    known = [k[m] for k, m in zip(per_row, np.split(is_many, cuts))]
    return test, known


def long_lists(values: list[np.ndarray]) -> pa.Array:
    """64-bit hashes per row as an Arrow list column of longs."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def repeated_keys(rows: DataFrame) -> DataFrame:
    """(did, rid, keys): per row the keys that some other row has as well.

    ``rows`` has did, rid, test array<long>, known array<long>.  One shuffle of
    the tested keys; equal keys come together in a window that only compares
    its ends and spills if large.
    """
    tested = rows.select("did", "rid", F.explode("test").alias("key"))
    of_key = Window.partitionBy("key")
    shared = (tested.withColumn("n", F.count(F.lit(1)).over(of_key)).where("n > 1")
              .select("did", "rid", "key"))
    known = rows.select("did", "rid", F.explode("known").alias("key"))
    return shared.union(known).groupBy("did", "rid").agg(F.collect_list("key").alias("keys"))
