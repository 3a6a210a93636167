"""Exact quantiles that scale with rows.

``exact_quantiles`` returns, per group, the value at rank ``ceil(q * n)``
(1-based, at least 1) among the group's non-NULL values: the smallest value
with at least a fraction ``q`` of the values at or below it.

It selects by rank, level by level, and never gathers a group's rows nor all of
its distinct values, nor those of one bucket:

1. values are counted per (group, value), a combinable aggregate reduced
   map-side, so a hot value or a hot group costs one row per map task;
2. the counts are added up per *bucket* (:func:`value_bucket`, a fine
   logarithmic grid: 256 buckets per power of two and sign), with each bucket's
   least and greatest value.  Running totals over a group's buckets tell which
   bucket holds a rank;
3. only the values of those buckets are read again, dealt into ``CELLS`` equal
   cells between the bucket's extremes, and the cell of the rank found in the
   same way; then once more inside that cell;
4. what is left of a bucket are at most some thousand neighbouring doubles,
   however many values it had; the rank is counted off in them.

Windows run over bucket or cell totals, whose number is fixed by the grid, and
over the last few values.

``approx_quantiles`` is ``percentile_approx``: a mergeable sketch with bounded
memory, used where the original metric is defined that way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.config import PERCENTILE_ACCURACY

# Fixed values of the bucket grid: 256 buckets per power of two; the offset
# keeps the bucket number of every finite non-zero double positive before the
# sign is applied (log2 of a double lies within about -1075..1024).
BUCKETS_PER_OCTAVE = 256
BUCKET_OFFSET = 300_000
NAN_BUCKET = 10_000_000
INFINITY_BUCKET = 9_000_000
NULL_BUCKET = -10_000_000


def value_bucket(v: Column) -> Column:
    """Order-preserving bucket number of a numeric value (bigint, never NULL).

    ``x <= y`` implies ``bucket(x) <= bucket(y)`` in Spark's ordering (NaN
    last, NULL first).  Non-zero finite values use
    ``sign * (floor(log2|x| * 256) + offset)``; ``log2`` is monotone, so the
    buckets are too, and each spans a relative width of about 0.27%."""
    x = v.cast("double")
    mag = F.floor(F.log2(F.abs(x)) * F.lit(BUCKETS_PER_OCTAVE)) + F.lit(BUCKET_OFFSET)
    bucket = (
        F.when(x.isNull(), F.lit(NULL_BUCKET))
        .when(F.isnan(x), F.lit(NAN_BUCKET))
        .when(x == F.lit(float("inf")), F.lit(INFINITY_BUCKET))
        .when(x == F.lit(float("-inf")), F.lit(-INFINITY_BUCKET))
        .when(x == 0, F.lit(0))
        .when(x > 0, mag)
        .otherwise(-mag)
        .cast("long")
    )
    # Every branch is non-NULL already; the coalesce lets the optimizer know,
    # so a join on the bucket infers no extra filter.
    return F.coalesce(bucket, F.lit(NULL_BUCKET).cast("long"))


# Cells of each further level.  A bucket spans about 2**43.5 doubles, so after two
# levels of 2**16 cells each at most some 3,000 neighbouring doubles are left.
CELLS = 1 << 16
LEVELS = 2


def value_histogram(df: DataFrame, value: str | Column,
                    by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``(*by, _v, _c)``: how many non-NULL rows of each group hold each value.

    A combinable aggregate, reduced map-side.  NULL values keep their group's
    row (its quantiles are then NULL) with a count of 0."""
    v = F.col(value) if isinstance(value, str) else value
    by = list(by)
    return df.select(*by, v.alias("_v")).groupBy(*by, "_v").agg(F.count("_v").alias("_c"))


def exact_quantiles(df: DataFrame, value: str | Column, probs: list[tuple[str, float]],
                    by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """One row per group (one row overall without ``by``) with a column per
    ``(name, q)`` of ``probs``; NULL when the group has no non-NULL value."""
    return quantiles_from_histogram(value_histogram(df, value, by), probs, by)


def _same(a: DataFrame, b: DataFrame, by: list[str], on: list[str] = ()) -> Column:
    # Group keys may be NULL, so they join null-safely.
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[f"_o_{c}"]) for c in by]
                  + [a[c] == b[f"_o_{c}"] for c in on])


def _holding(totals: DataFrame, keys: list[str], place: str) -> DataFrame:
    """``totals`` (keys, place, _n, _lo, _hi) with _upto, the running total by place."""
    upto = Window.partitionBy(*keys).orderBy(place).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return totals.withColumn("_upto", F.sum("_n").over(upto))


def _bucket_of_ranks(hist: DataFrame, by: list[str], probs: list[tuple[str, float]]) -> DataFrame:
    """(by, _b, _name, _rank, _lo, _hi): the bucket that holds each rank, the rank
    counted from the bucket's first value."""
    totals = hist.groupBy(*by, "_b").agg(
        F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    all_rows = F.sum("_n").over(Window.partitionBy(*by))
    ranked = _holding(totals.withColumn("_all", all_rows), by, "_b")
    wanted = F.array(*[F.struct(
        F.lit(name).alias("name"),
        F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("_all"))).cast("long").alias("rank"))
        for name, q in probs])
    before = F.col("_upto") - F.col("_n")
    here = F.filter(wanted, lambda w: (before < w.rank) & (w.rank <= F.col("_upto")))
    return ranked.select(*by, "_b", "_lo", "_hi", before.alias("_before"),
                         F.explode(here).alias("_w")).select(
        *by, "_b", F.col("_w.name").alias("_name"),
        (F.col("_w.rank") - F.col("_before")).alias("_rank"), "_lo", "_hi")


def _values_between(hist: DataFrame, ends: DataFrame, by: list[str]) -> DataFrame:
    """The values of ``hist`` in the ranges of ``ends``, with name, rank and range."""
    ends = ends.withColumnsRenamed({c: f"_o_{c}" for c in [*by, "_b"]})
    return hist.select(*by, "_b", "_v", "_c").join(
        ends, _same(hist, ends, by, ["_b"])).where(
        (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))).select(
        *by, "_b", "_v", "_c", "_name", "_rank", "_lo", "_hi")


def _narrowed(hist: DataFrame, ends: DataFrame, by: list[str]) -> DataFrame:
    """``ends`` for the one cell of each range that holds the rank."""
    v, lo, hi = (F.col(c).cast("double") for c in ("_v", "_lo", "_hi"))
    cell = F.when(hi > lo, F.least(F.lit(CELLS - 1), F.floor(
        F.try_divide(v - lo, hi - lo) * CELLS).cast("int"))).otherwise(F.lit(0))
    keys = [*by, "_name"]
    totals = _values_between(hist, ends, by).groupBy(
        *keys, "_b", "_rank", F.coalesce(cell, F.lit(0)).alias("_cell")).agg(
        F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    before = F.col("_upto") - F.col("_n")
    return _holding(totals, keys, "_cell").where(
        (before < F.col("_rank")) & (F.col("_rank") <= F.col("_upto"))).select(
        *by, "_b", "_name", (F.col("_rank") - before).alias("_rank"), "_lo", "_hi")


def quantiles_from_histogram(hist: DataFrame, probs: list[tuple[str, float]],
                             by: list[str] | tuple[str, ...] = (),
                             extra: list[Column] | None = None) -> DataFrame:
    """:func:`exact_quantiles` over a histogram ``(*by, _v, _c)`` with one row
    per group and value (as :func:`value_histogram` builds).

    ``extra`` are further aggregates over the histogram's rows per group, which
    may use its other columns."""
    by = list(by)
    extra = list(extra or [])
    totals = hist.groupBy(*by).agg(*extra, F.count(F.lit(1)).alias("_rows_of_group"))
    names = [c for c in totals.columns if c not in by]
    counts = hist.where(F.col("_v").isNotNull()).select(
        *by, "_v", "_c", value_bucket(F.col("_v")).alias("_b"))
    ends = _bucket_of_ranks(counts, by, probs)
    for _ in range(LEVELS):
        ends = _narrowed(counts, ends, by)
    left = _holding(_values_between(counts, ends, by).withColumnRenamed("_c", "_n"),
                    [*by, "_name"], "_v").where("_upto >= _rank")
    picked = left.groupBy(*by, "_name").agg(F.min("_v").alias("_v"))
    # One row of totals and one per rank and group: folded without a join.
    rows = totals.select(*by, *names, F.lit(None).cast("string").alias("_name"),
                         F.lit(None).cast(counts.schema["_v"].dataType).alias("_v")).unionByName(
        picked.select(*by, *[F.lit(None).cast(totals.schema[n].dataType).alias(n) for n in names],
                      "_name", "_v"))
    return rows.groupBy(*by).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name, _ in probs],
        *[F.max(n).alias(n) for n in names]).drop("_rows_of_group")


def approx_quantiles(df: DataFrame, value: str | Column, probs: list[tuple[str, float]],
                     by: list[str] | tuple[str, ...] = (),
                     accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    """Same shape as :func:`exact_quantiles`, from ``percentile_approx``."""
    v = F.col(value) if isinstance(value, str) else value
    q = F.percentile_approx(v, [p for _, p in probs], accuracy)
    row = df.groupBy(*by).agg(q.alias("_q"))
    return row.select(*by, *[F.col("_q")[i].alias(n) for i, (n, _) in enumerate(probs)])
