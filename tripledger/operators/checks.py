"""Consistency checks as DataFrame operators.

Each check returns a small DataFrame (one row, or the offending rows) so it
can be asserted in a test, written to a table or shown; none of them pulls
table data to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.config import REQUIRED_COLUMNS, Scope
from tripledger.sources.schema import absent


def _count_row(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")


def conservation(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Bronze, silver and quarantine counts; ``diferenca`` must be 0.

    Three independent counts unioned and folded into one row (the original
    used five scalar subqueries)."""
    rows = reduce(DataFrame.unionByName, [
        _count_row(bronze, "bronze"), _count_row(silver, "silver"),
        _count_row(quarantine, "quarentena"),
    ])

    def pick(name: str):
        return F.coalesce(F.max(F.when(F.col("t") == name, F.col("n"))), F.lit(0)).cast("long")

    return rows.agg(
        pick("bronze").alias("bronze"),
        pick("silver").alias("silver"),
        pick("quarentena").alias("quarentena"),
    ).select(
        "bronze", "silver", "quarentena",
        (F.col("silver") + F.col("quarentena") - F.col("bronze")).alias("diferenca"),
    )


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` and ``b`` that do not pair up, as a multiset.

    Equals ``a.exceptAll(b).count() + b.exceptAll(a).count()`` but in one
    shuffle: each side is tagged +1/-1, grouped by every column, and the
    absolute net count is summed.  NULLs group together, as in ``exceptAll``.
    """
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"column sets differ: {a.columns} vs {b.columns}")
    cols = list(a.columns)
    tagged = a.select(*cols, F.lit(1).alias("_side")).unionByName(
        b.select(*cols, F.lit(-1).alias("_side"))
    )
    net = tagged.groupBy(*cols).agg(F.sum("_side").alias("_net"))
    return net.agg(
        F.coalesce(F.sum(F.abs("_net")), F.lit(0)).cast("long").alias("divergencias")
    )


def required_present(df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> list[str]:
    """C4: required columns missing from ``df`` (case-insensitive); [] is good."""
    return absent(df.columns, required)


def volume_band(period_volume: DataFrame, low: int, high: int) -> DataFrame:
    """Per file period, whether it comes from exactly one file and has a
    row count inside [low, high]."""
    return period_volume.select(
        "*",
        (F.col("arquivos_origem") == 1).alias("um_arquivo"),
        F.col("registros").between(low, high).alias("volume_na_faixa"),
    )


def scope_exact(scope_check: DataFrame, scope: Scope) -> DataFrame:
    """Months of the scope missing from silver and silver months outside
    it, one row per problem; no rows means silver covers exactly the scope."""
    spark = scope_check.sparkSession
    expected = spark.createDataFrame([(p,) for p in scope.periods()], "pickup_year_month string")
    present = scope_check.select("pickup_year_month").distinct()
    missing = expected.join(present, "pickup_year_month", "left_anti").select(
        "pickup_year_month", F.lit("ausente").alias("problema"))
    extra = present.join(expected, "pickup_year_month", "left_anti").select(
        "pickup_year_month", F.lit("fora_do_escopo").alias("problema"))
    return missing.unionByName(extra)
