"""Trips derived from the driver's test tables.

The monthly trip files of the original data are not available, so every query
reads trips built from ``lineitem JOIN orders``.  The formula is chosen so that
one table exercises every quality rule: ``l_linenumber = 6`` moves a trip three
days forward (a trip delivered in another file's month), ``= 7`` gives an
unknown vendor, ``= 4`` a missing passenger count; the seconds term gives
durations from -600 s to just under 25 h, and ``- 5000`` non-positive amounts.
Money goes through DECIMAL so no engine-specific double rounding enters.
Values are missing too: the pickup, the dropoff, the amount or the vendor of the
lines with certain part keys (``NULL_KEYS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.config import Scope
from tripledger.operators.membership import members, possible_members
from tripledger.session import scratch_path

# Fixed value of the adapter formula: the largest shift from the order date to
# the pickup is 3 days + 23 hours, so 4 days bounds it.
MAX_PICKUP_SHIFT_DAYS = 4

# Fixed values of the adapter formula: a column is NULL where the part key
# leaves this remainder on division by this number.
NULL_KEYS = {
    "tpep_pickup_datetime": (97, 13),
    "tpep_dropoff_datetime": (97, 14),
    "total_amount": (89, 7),
    "VendorID": (83, 5),
}

# The scope and focus month the test data is analysed with.
TEST_SCOPE = Scope("1996-01", "1996-05")
TEST_FOCUS_PERIOD = "1996-05"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# Schemas of the driver tables the queries read (the same at
# every scale).  A read with a declared schema skips the footer-reading job
# that schema inference runs for every ``spark.read.parquet``, and a file
# whose column types differ fails the read instead of changing the plan.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (declared schema where known)."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str, with_source: bool = False,
          pickup_scope: Scope | None = None) -> DataFrame:
    """Bronze-shaped trips: canonical names, ``_ref_period`` of the 'file'.

    ``pickup_scope`` keeps at least every trip whose pickup falls inside the
    scope (and may keep a few before it): the pickup is the order date plus
    0 to 3 days 23 hours, so a pickup in ``[start, end)`` needs an order date
    in ``[start - 4 days, end)``.  That implied range is a plain column range
    on ``orders``, so it reaches the Parquet reader (row groups outside it
    are skipped) and shrinks the join; a membership filter of the remaining
    orders, of bounded size (:mod:`tripledger.operators.membership`), drops the
    other ``lineitem`` rows before they are shuffled.  Trips without a pickup are
    not in any range, so only callers that go on to filter by month may pass it.

    The join is an equi-join of two fact tables on the order key.  ``orders``
    grows with ``lineitem`` (about a quarter of its rows), so it has no size
    bound and is never broadcast: the ``merge`` hint asks for a sort-merge join,
    which spills rather than needing a side in memory and whose skewed
    partitions AQE splits.  Only the columns used below are read.  ``with_source`` adds
    ``_source_file``, the file each row was read from (scan metadata).
    """
    li_cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_extendedprice"]
    li = table(spark, sf_dir, "lineitem")
    li = li.select(*li_cols, F.col("_metadata.file_path").alias("_source_file")) \
        if with_source else li.select(*li_cols)
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    if pickup_scope is not None:
        start = F.lit(pickup_scope.start_literal()).cast("timestamp_ntz")
        end = F.lit(pickup_scope.end_literal()).cast("timestamp_ntz")
        od = od.filter((F.col("o_orderdate") >= start - F.make_dt_interval(
            F.lit(MAX_PICKUP_SHIFT_DAYS))) & (F.col("o_orderdate") < end))
        li = possible_members(li, ["l_orderkey"], members(od, ["o_orderkey"]))
    od = od.hint("merge")
    j = li.join(od, li.l_orderkey == od.o_orderkey)

    shift_days = F.when(F.col("l_linenumber") == 6, F.lit(3)).otherwise(F.lit(0))
    shift_hours = (F.col("l_partkey") % 24).cast("int")
    seconds = ((F.col("l_orderkey") * 37 + F.col("l_partkey") * 911) % 90000 - 600).cast("int")
    pickup = F.col("o_orderdate") + F.make_dt_interval(shift_days, shift_hours)
    dropoff = F.col("o_orderdate") + F.make_dt_interval(
        shift_days, shift_hours, F.lit(0), seconds
    )

    def but_some(value, name):
        """``value``, NULL on the lines that lack it."""
        number, remainder = NULL_KEYS[name]
        lacks = F.coalesce(F.col("l_partkey") % number == remainder, F.lit(False))
        return F.when(~lacks, value).alias(name)

    cols = [
        "l_orderkey",
        "l_linenumber",
        but_some(F.when(F.col("l_linenumber") == 7, F.lit(6))
                 .otherwise((F.col("l_suppkey") % 2 + 1).cast("int")), "VendorID"),
        but_some(pickup, "tpep_pickup_datetime"),
        but_some(dropoff, "tpep_dropoff_datetime"),
        F.when(F.col("l_linenumber") == 4, F.lit(None).cast("int"))
        .otherwise(F.col("l_quantity").cast("int") % 10)
        .alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        (F.col("l_partkey") % 265).cast("int").alias("PULocationID"),
        (F.col("l_suppkey") % 265).cast("int").alias("DOLocationID"),
        but_some((F.col("l_extendedprice").cast("decimal(12,2)") - F.lit(5000)).cast("double"),
                 "total_amount"),
        F.date_format("o_orderdate", "yyyy-MM").alias("_ref_period"),
    ]
    if with_source:
        cols.append("_source_file")
    return j.select(*cols)


# DuckDB text of the same adapter, for the oracle queries.
TRIPS_SQL_DUCKDB = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_partkey % 83 = 5 THEN NULL WHEN l_linenumber = 7 THEN 6
       ELSE CAST(l_suppkey % 2 + 1 AS INT) END AS VendorID,
  CASE WHEN l_partkey % 97 = 13 THEN NULL ELSE
      o_orderdate + to_days(CASE WHEN l_linenumber = 6 THEN 3 ELSE 0 END)
      + to_hours(CAST(l_partkey % 24 AS INT)) END AS tpep_pickup_datetime,
  CASE WHEN l_partkey % 97 = 14 THEN NULL ELSE
      o_orderdate + to_days(CASE WHEN l_linenumber = 6 THEN 3 ELSE 0 END)
      + to_hours(CAST(l_partkey % 24 AS INT))
      + to_seconds(CAST((l_orderkey * 37 + l_partkey * 911) % 90000 - 600 AS INT)) END
      AS tpep_dropoff_datetime,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_quantity AS INT) % 10 END AS passenger_count,
  l_quantity AS trip_distance,
  CAST(l_partkey % 265 AS INT) AS PULocationID,
  CAST(l_suppkey % 265 AS INT) AS DOLocationID,
  CASE WHEN l_partkey % 89 = 7 THEN NULL
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - 5000 AS DOUBLE) END AS total_amount,
  strftime(o_orderdate, '%Y-%m') AS _ref_period
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def bronze(spark: SparkSession, sf_dir: str, with_source: bool = True,
           pickup_scope: Scope | None = None) -> DataFrame:
    """Trips with the bronze audit columns.

    ``_source_file`` is the real lineage of each row (the ``lineitem`` file it
    was read from), ``_ingested_at`` is one timestamp per query, and
    ``_ref_year``/``_ref_month`` split the period.  ``with_source=False``
    leaves ``_source_file`` out for queries that do not read it: a scan that
    references ``_metadata.file_path`` materialises the whole metadata struct
    (row index included) for every row, even when the column is pruned later.
    ``pickup_scope`` is passed to :func:`trips`, for queries that keep only
    pickups within it.
    """
    return trips(spark, sf_dir, with_source=with_source, pickup_scope=pickup_scope).select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.substring("_ref_period", 1, 4).cast("int").alias("_ref_year"),
        F.substring("_ref_period", 6, 2).cast("int").alias("_ref_month"),
    )


def write_trip_landing(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Write the trips as a landing zone, one folder per file period, and
    return ``{period: folder}``.

    The months drift the way the original monthly files do: even months store
    ids as int32 with ``airport_fee``; odd months store them as int64, spell
    the fee ``Airport_fee`` and carry an extra column the canonical schema
    does not know.  Two Spark jobs write all periods (one per schema), each
    partitioned by ``ref_year``/``ref_month``.  Trips without a file period go
    to a folder of their own, ``0000-00``.
    """
    stored = scratch_path(spark, "trips")
    # The join runs once; both schemas are written from its stored result.
    trips(spark, sf_dir).select(
        "*",
        F.coalesce(F.substring("_ref_period", 1, 4), F.lit("0000")).alias("ref_year"),
        F.coalesce(F.substring("_ref_period", 6, 2), F.lit("00")).alias("ref_month"),
        F.when(F.col("PULocationID").isin(132, 138), F.lit(1.75)).otherwise(F.lit(0.0))
        .alias("fee"),
    ).write.parquet(stored)
    base = spark.read.parquet(stored)
    core = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "total_amount"]
    even = base.filter(F.col("ref_month").cast("int") % 2 == 0).select(
        "VendorID", *core, "passenger_count", "PULocationID", "DOLocationID",
        F.col("fee").alias("airport_fee"), "ref_year", "ref_month",
    )
    odd = base.filter(F.col("ref_month").cast("int") % 2 == 1).select(
        F.col("VendorID").cast("long").alias("VendorID"), *core,
        F.col("passenger_count").cast("long").alias("passenger_count"),
        F.col("PULocationID").cast("long").alias("PULocationID"),
        F.col("DOLocationID").cast("long").alias("DOLocationID"),
        F.col("fee").alias("Airport_fee"),
        (F.col("fee") * 0).alias("cbd_congestion_fee"),
        "ref_year", "ref_month",
    )
    target = f"{root.rstrip('/')}/yellow_tripdata"
    for part in (even, odd):
        # Rebalance by the folder columns: one writer per period folder and
        # the writers spread over all cores (AQE splits an oversized period).
        (part.hint("rebalance", "ref_year", "ref_month")
         .write.mode("append").partitionBy("ref_year", "ref_month").parquet(target))
    months = base.select("ref_year", "ref_month").distinct().collect()  # one row per folder
    return {f"{m.ref_year}-{m.ref_month}":
            f"{target}/ref_year={m.ref_year}/ref_month={m.ref_month}" for m in sorted(months)}
