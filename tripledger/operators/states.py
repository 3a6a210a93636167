"""Profiles (A10, A11, A13, A14, A26) merged from states instead of from trips.

A state is the aggregate of one (file period, source file, trip month) of bronze,
or of one (trip month, file period) of silver.  The states of a period are
replaced when the period is reloaded and merge by sums, minima and maxima.
Distinct counts stay exact: a distinct value is either a group of the states, or
one bit of an exact bitmap (a month has the number 12 * year + month, so each has
a bit of its own).  No aggregate counts distinct trips, and none expands its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.config import DEFAULT_SPEC, SILVER_PARTITION, TripSpec
from tripledger.functions import trips as T

MONTH = "_month"


def bronze_states(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per (file period, source file, trip month), combined map-side."""
    return bronze.groupBy(
        spec.ref_period, "_source_file", T.year_month(spec.pickup).alias(MONTH)
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("_ingested_at").alias("first_ingested"),
        F.min(spec.pickup).alias("first_pickup"),
        F.max(spec.pickup).alias("last_pickup"),
    )


def silver_states(silver: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per (trip month, file period) of silver, combined map-side."""
    return silver.groupBy(SILVER_PARTITION, spec.ref_period).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("pickup_date").alias("first_day"),
        F.max("pickup_date").alias("last_day"),
    )


def _month_number(month: str | Column) -> Column:
    year, rest = F.split_part(month, F.lit("-"), F.lit(1)), F.split_part(month, F.lit("-"), F.lit(2))
    return (year.cast("long") * 12 + rest.cast("long")).cast("long")


def distinct_months(states: DataFrame, month: str = MONTH, by: tuple[str, ...] = ()) -> DataFrame:
    """``by``, ``months``: months of the states, counted as bits of bitmaps of
    32,768 months each; no months give no row.  NULL is no month."""
    number = _month_number(F.col(month))
    return states.where(F.col(month).isNotNull()).select(
        *by, F.bitmap_bucket_number(number).alias("_bucket"),
        F.bitmap_bit_position(number).alias("_bit"),
    ).groupBy(*by, "_bucket").agg(
        F.bitmap_count(F.bitmap_construct_agg("_bit")).alias("_months")
    ).groupBy(*by).agg(F.sum("_months").alias("months"))


def period_volume(states: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """A10: a period's files are the groups of its states."""
    per_file = states.groupBy(spec.ref_period, "_source_file").agg(
        F.sum("rows").alias("rows"), F.min("first_ingested").alias("first_ingested"))
    return per_file.groupBy(spec.ref_period).agg(
        F.sum("rows").alias("registros"),
        F.count("_source_file").alias("arquivos_origem"),
        F.min("first_ingested").alias("ingerido_em"),
    ).orderBy(spec.ref_period)


def out_of_month(states: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """A11."""
    other = F.when(F.col(MONTH) != F.col(spec.ref_period), F.col("rows")).otherwise(F.lit(0))
    return states.groupBy(spec.ref_period).agg(
        F.min("first_pickup").alias("pickup_minimo"),
        F.max("last_pickup").alias("pickup_maximo"),
        F.sum(other).alias("corridas_fora_do_mes"),
        F.sum("rows").alias("_n"),
    ).select(
        spec.ref_period, "pickup_minimo", "pickup_maximo", "corridas_fora_do_mes",
        T.percent(F.col("corridas_fora_do_mes"), F.col("_n"), 4).alias("pct_fora_do_mes"),
    ).orderBy(spec.ref_period)


def panorama(states: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Totals per period and the bits of the months, put together."""
    totals = states.groupBy(spec.ref_period).agg(
        F.sum("rows").alias("rows"), F.min("first_pickup").alias("lo"),
        F.max("last_pickup").alias("hi"))
    both = totals.withColumn("months", F.lit(0).cast("long")).unionByName(
        distinct_months(states), allowMissingColumns=True)
    return both.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("registros"),
        F.count(spec.ref_period).alias("competencias"),
        F.min("lo").alias("pickup_minimo"),
        F.max("hi").alias("pickup_maximo"),
        F.coalesce(F.sum("months"), F.lit(0)).cast("long").alias("meses_distintos"),
    )


def month_sources(states: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """A14."""
    return states.groupBy(F.col(MONTH).alias("mes_real")).agg(
        F.sum("rows").alias("registros"),
        F.sort_array(F.collect_set(spec.ref_period)).alias("arquivos_de_origem"),
    ).orderBy("mes_real")


def scope_check(states: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """A month's file periods are the rows of its silver states."""
    return states.groupBy(SILVER_PARTITION).agg(
        F.sum("rows").alias("corridas"),
        F.min("first_day").alias("primeiro_dia"),
        F.max("last_day").alias("ultimo_dia"),
        F.count(spec.ref_period).alias("arquivos_contribuintes"),
    ).orderBy(SILVER_PARTITION)
