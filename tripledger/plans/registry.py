"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each over the whole driver tables.

Every query reads the trips adapter (``lineitem JOIN orders``) or another
driver table, so its work grows with the data.  Gold keeps unrounded doubles;
where a registered query returns such raw doubles it rounds them to a fixed
number of digits (:func:`fixed_digits`), so that the summation order of one
engine or another cannot change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tripledger.config import Scope
from tripledger.operators import checks as C
from tripledger.operators import metrics as M
from tripledger.operators import profile as P
from tripledger.operators import quality as Q
from tripledger.operators import states as ST
from tripledger.plans import medallion as MD
from tripledger.session import scratch_path, unique_name
from tripledger.sources import testdata as TD
from tripledger.sources.testdata import TEST_FOCUS_PERIOD as FOCUS
from tripledger.sources.testdata import TEST_SCOPE as SCOPE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


def fixed_digits(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating-point column to ``digits`` decimals."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


# --- shared building blocks --------------------------------------------------

def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, for queries that use
    it several times: the trips join runs once."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.classify(TD.trips(spark, sf_dir), SCOPE)


def silver(spark: SparkSession, sf_dir: str, within: Scope | None = None) -> DataFrame:
    """Valid trips.  Queries that go on to keep named months only pass them as
    ``within``, and trips that cannot have a pickup there are not read.  The
    full set is read whole: trips without a pickup are valid too, and no order
    date range holds them."""
    trips = TD.trips(spark, sf_dir, pickup_scope=within)
    return Q.valid_rows(Q.classify(trips, SCOPE))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.discarded_rows(classified(spark, sf_dir))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and tickets per month; only A1 itself needs the median."""
    return M.monthly_sums(silver(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.hourly_passengers(silver(spark, sf_dir, Scope(FOCUS, FOCUS)), FOCUS)


# --- silver -----------------------------------------------------------------

@register("classify_trips")
def classify_trips(spark, sf_dir):
    """Q1 to Q13: every trip with derived columns, flags and discard reason."""
    return classified(spark, sf_dir)


@register("valid_trips")
def valid_trips(spark, sf_dir):
    """Q14: the rows silver keeps."""
    return silver(spark, sf_dir)


@register("quarantined_trips")
def quarantined_trips(spark, sf_dir):
    """Q14: the rows the quarantine keeps, with their reason."""
    return quarantine(spark, sf_dir)


# --- gold ---------------------------------------------------------------------

@register("monthly_revenue")
def monthly_revenue(spark, sf_dir):
    """A1."""
    return fixed_digits(M.monthly_revenue(silver(spark, sf_dir))).orderBy("pickup_year_month")


@register("monthly_revenue_report")
def monthly_revenue_report(spark, sf_dir):
    """A3."""
    return M.monthly_report(monthly(spark, sf_dir))


@register("hourly_passengers")
def hourly_passengers(spark, sf_dir):
    """A2."""
    return fixed_digits(hourly(spark, sf_dir)).orderBy("pickup_hour")


@register("hourly_passengers_report")
def hourly_passengers_report(spark, sf_dir):
    """A4."""
    return M.hourly_report(hourly(spark, sf_dir))


@register("ticket_consolidated")
def ticket_consolidated(spark, sf_dir):
    """A5."""
    return M.ticket_consolidated(monthly(spark, sf_dir))


@register("revenue_consolidated")
def revenue_consolidated(spark, sf_dir):
    """A6."""
    return M.revenue_consolidated(monthly(spark, sf_dir))


@register("hourly_volume_context")
def hourly_volume_context(spark, sf_dir):
    """A7."""
    return fixed_digits(M.hourly_volume_context(hourly(spark, sf_dir)))


@register("hourly_chart")
def hourly_chart(spark, sf_dir):
    """A8."""
    return M.hourly_chart(hourly(spark, sf_dir))


@register("weekday_ticket")
def weekday_ticket(spark, sf_dir):
    """A9."""
    return M.weekday_ticket(silver(spark, sf_dir))


# --- bronze profiling (EDA) ----------------------------------------------------

def bronze(spark: SparkSession, sf_dir: str, with_source: bool = False,
           within: Scope | None = None) -> DataFrame:
    """Bronze-shaped trips; ``_source_file`` only for the queries that read
    it (see :func:`tripledger.sources.testdata.bronze`).  Queries that keep
    only pickups ``within`` a range read only the orders that can yield one."""
    return TD.bronze(spark, sf_dir, with_source=with_source, pickup_scope=within)


@register("period_volume")
def period_volume(spark, sf_dir):
    """A10 (the ingestion time is one value per run and is left out)."""
    return P.period_volume(bronze(spark, sf_dir, with_source=True)).drop("ingerido_em")


@register("out_of_month")
def out_of_month(spark, sf_dir):
    """A11."""
    return P.out_of_month(bronze(spark, sf_dir))


@register("reload_detector")
def reload_detector(spark, sf_dir):
    """A12/C2 over a bronze copy whose focus period was appended twice."""
    path = scratch_path(spark, "reloaded")
    batch = bronze(spark, sf_dir).select("_ref_period", "_ingested_at")
    batch.write.parquet(path)
    again = bronze(spark, sf_dir).select("_ref_period", "_ingested_at")  # a later batch time
    again.where(F.col("_ref_period") == FOCUS).write.mode("append").parquet(path)
    return P.reload_detector(spark.read.schema(batch.schema).parquet(path))


@register("panorama")
def panorama(spark, sf_dir):
    """A13."""
    return P.panorama(bronze(spark, sf_dir))


@register("month_sources")
def month_sources(spark, sf_dir):
    """A14 (the sorted set of periods joined with commas)."""
    df = P.month_sources(bronze(spark, sf_dir))
    return df.withColumn("arquivos_de_origem", F.array_join("arquivos_de_origem", ","))


@register("duration_profile")
def duration_profile(spark, sf_dir):
    """A15."""
    return P.duration_profile(bronze(spark, sf_dir))


@register("amount_nonpositive")
def amount_nonpositive(spark, sf_dir):
    """A16."""
    return P.amount_nonpositive(bronze(spark, sf_dir))


@register("amount_distribution")
def amount_distribution(spark, sf_dir):
    """A17."""
    return P.amount_distribution(bronze(spark, sf_dir))


@register("outlier_weight")
def outlier_weight(spark, sf_dir):
    """A18."""
    return P.outlier_weight(bronze(spark, sf_dir))


@register("passenger_histogram")
def passenger_histogram(spark, sf_dir):
    """A19 + N1."""
    return P.passenger_histogram(bronze(spark, sf_dir))


@register("null_treatment")
def null_treatment(spark, sf_dir):
    """A20 over the focus month."""
    return P.null_treatment(bronze(spark, sf_dir, within=Scope(FOCUS, FOCUS)), FOCUS)


@register("duplicate_summary")
def duplicate_summary(spark, sf_dir):
    """A21 over ``lineitem(l_orderkey, l_linenumber)``, whose pairs repeat."""
    return P.duplicate_summary(TD.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("trip_duplicates")
def trip_duplicates(spark, sf_dir):
    """A21 over the six trip key columns of bronze, in two phases over the stored
    key columns."""
    keys = bronze(spark, sf_dir).select(*P.duplicate_keys())
    return P.duplicate_summary_by_digest(stored(spark, keys, "trip-keys"))


@register("completeness")
def completeness(spark, sf_dir):
    """A22."""
    return P.completeness(bronze(spark, sf_dir))


@register("vendor_domain")
def vendor_domain(spark, sf_dir):
    """A23."""
    return P.vendor_domain(bronze(spark, sf_dir))


@register("month_with_footer")
def month_with_footer(spark, sf_dir):
    """A24 + U1."""
    return P.month_with_footer(bronze(spark, sf_dir, within=SCOPE), SCOPE)


# --- silver / quarantine validation -------------------------------------------

@register("quarantine_summary")
def quarantine_summary(spark, sf_dir):
    """A25."""
    return P.quarantine_summary(quarantine(spark, sf_dir))


@register("scope_check")
def scope_check(spark, sf_dir):
    """A26."""
    return P.scope_check(silver(spark, sf_dir))


@register("flag_totals")
def flag_totals(spark, sf_dir):
    """A27."""
    return P.flag_totals(silver(spark, sf_dir))


@register("conservation")
def conservation(spark, sf_dir):
    """bronze = silver + quarantine, each counted from the stored trips."""
    b = stored(spark, bronze(spark, sf_dir), "conservation")
    rows = Q.classify(b, SCOPE)
    return C.conservation(b, Q.valid_rows(rows), Q.discarded_rows(rows))


@register("volume_band")
def volume_band(spark, sf_dir):
    """Per file period, one source file and a row count within a band."""
    volume = P.period_volume(bronze(spark, sf_dir, with_source=True)).drop("ingerido_em")
    return C.volume_band(volume, 10, 1000)


@register("scope_exact")
def scope_exact(spark, sf_dir):
    """Months by which silver and a scope differ; the scope is moved by a
    month, so that one month is missing, one is beyond it, and the trips
    without a pickup are beyond it too."""
    months = stored(spark, P.scope_check(silver(spark, sf_dir)), "silver-months")
    return C.scope_exact(months, Scope("1996-02", "1996-06"))


@register("discard_rate")
def discard_rate(spark, sf_dir):
    """A28."""
    return P.discard_rate(classified(spark, sf_dir))


@register("implementations_agree")
def implementations_agree(spark, sf_dir):
    """The gold-based and silver-based reports differ in no row."""
    s = stored(spark, silver(spark, sf_dir).select(
        "tpep_pickup_datetime", "pickup_year_month", "pickup_hour", "passenger_count",
        "total_amount", "flag_valor_nao_positivo", "flag_passageiros_ausente"), "agreeing-silver")
    mon = C.symmetric_difference(
        M.monthly_report(M.monthly_revenue(s)), M.monthly_report_from_silver(s)
    ).withColumnRenamed("divergencias", "divergencias_mensal")
    hr = C.symmetric_difference(
        M.hourly_report(M.hourly_passengers(s, FOCUS), label_hours=False),
        M.hourly_report_from_silver(s, FOCUS),
    ).withColumnRenamed("divergencias", "divergencias_horaria")
    return mon.unionByName(hr, allowMissingColumns=True).agg(
        F.max("divergencias_mensal").alias("divergencias_mensal"),
        F.max("divergencias_horaria").alias("divergencias_horaria"),
    )


@register("trip_sample")
def trip_sample(spark, sf_dir):
    """20 trips of the focus month in a total order."""
    return P.trip_sample(silver(spark, sf_dir, Scope(FOCUS, FOCUS)), FOCUS)


# --- metrics stated in the analysis prose (D-series) -------------------------

@register("vendor_discards")
def vendor_discards(spark, sf_dir):
    """D1."""
    return M.vendor_discards(classified(spark, sf_dir))


@register("month_growth")
def month_growth(spark, sf_dir):
    """Second to last month of the scope."""
    return M.month_growth(monthly(spark, sf_dir), SCOPE.periods()[1], SCOPE.last)


@register("peak_hours")
def peak_hours(spark, sf_dir):
    """D3."""
    return M.peak_hours(hourly(spark, sf_dir))


@register("hourly_spread")
def hourly_spread(spark, sf_dir):
    """D4."""
    return M.hourly_spread(hourly(spark, sf_dir))


@register("missing_by_hour")
def missing_by_hour(spark, sf_dir):
    """D5."""
    return M.missing_by_hour(hourly(spark, sf_dir))


@register("double_violations")
def double_violations(spark, sf_dir):
    """D6."""
    return M.double_violations(classified(spark, sf_dir), SCOPE)


# --- sources, sinks and the table builds ---------------------------------------
# These write under the shared work folder (``spark.checkpoint.dir``), each
# run into fresh, uniquely named folders and databases.

def _landing(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    return TD.write_trip_landing(spark, sf_dir, scratch_path(spark, "landing"))


def _tables() -> "MD.Tables":
    return MD.Tables.prefixed(unique_name("t"))


# Canonical spec applied to ``events``: one name differing only in case, one
# optional column the source lacks (NULL), and ``props`` left out (ignored).
EVENT_TYPES = {
    "Event_Id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "EVENT_TYPE": "string",
    "value": "double",
    "session_id": "string",
}
EVENT_REQUIRED = ("event_id", "ts")


@register("canonical_scan")
def canonical_scan(spark, sf_dir):
    """``events`` cast to a canonical spec."""
    from tripledger.sources.landing import read_landing

    read = read_landing(spark, f"{sf_dir.rstrip('/')}/events.parquet", "0000-00",
                        EVENT_TYPES, EVENT_REQUIRED)
    return read.df.select(*EVENT_TYPES)


@register("unified_months")
def unified_months(spark, sf_dir):
    """S1 + U3: trips written as drifting monthly files (int32 / int64 ids,
    renamed and extra columns), read back per schema group and unioned."""
    from tripledger.sources.landing import read_landing_grouped

    df = read_landing_grouped(spark, _landing(spark, sf_dir))
    return df.groupBy("_ref_period").agg(
        F.count(F.lit(1)).alias("registros"),
        F.sum("passenger_count").alias("soma_passageiros"),
        F.round(F.sum("total_amount"), 2).alias("soma_valor"),
    )


@register("partition_overwrite")
def partition_overwrite(spark, sf_dir):
    """Load every period, reload the focus month's file period
    twice through the single-partition overwrite; rows per period."""
    paths = _landing(spark, sf_dir)
    t = _tables()
    MD.load_bronze_all(spark, paths, t)
    for _ in range(2):
        MD.load_bronze_period(spark, paths[FOCUS], FOCUS, t)
    return spark.table(t.bronze).groupBy("_ref_period").agg(
        F.count(F.lit(1)).alias("registros"),
        F.countDistinct("_ingested_at").alias("lotes_distintos"),
    )


@register("load_history")
def load_history(spark, sf_dir):
    """Rows per load of every period, one of them reloaded, read
    back from the load history."""
    paths = _landing(spark, sf_dir)
    t = _tables()
    MD.load_bronze_all(spark, paths, t)
    MD.load_bronze_period(spark, paths[FOCUS], FOCUS, t)
    return MD.W.load_history(spark, t.bronze).select("partition_value", "rows")


@register("medallion_roundtrip")
def medallion_roundtrip(spark, sf_dir):
    """Landing -> bronze -> silver + quarantine -> gold
    tables; returns the gold monthly table."""
    paths = _landing(spark, sf_dir)
    t = _tables()
    MD.load_bronze_all(spark, paths, t)
    MD.build_silver(spark, SCOPE, t)
    MD.build_gold(spark, FOCUS, t)
    return fixed_digits(spark.table(t.monthly))


@register("streaming_refresh")
def streaming_refresh(spark, sf_dir):
    """The landing zone consumed by the Structured Streaming file stream
    in micro-batches of at most 40 files.  The first batch builds bronze,
    silver, quarantine and gold; each later one reloads its periods and
    refreshes only the trip months they touch.  Returns gold monthly, which
    must equal the one built in a single pass."""
    from tripledger.streaming import incremental as S

    root = scratch_path(spark, "landing")
    TD.write_trip_landing(spark, sf_dir, root)
    t = _tables()
    q = S.start(spark, root, SCOPE, FOCUS, t, max_files_per_trigger=40)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"landing stream failed: {q.exception()}")
    return fixed_digits(spark.table(t.monthly))


@register("profile_refresh")
def profile_refresh(spark, sf_dir):
    """A10, A13, A26 from mergeable states: every period loaded and profiled, the
    focus month's file period reloaded, its states and those of the months it
    touches replaced, and the profiles merged from all states."""
    paths = _landing(spark, sf_dir)
    t = _tables()
    MD.load_bronze_all(spark, paths, t)
    MD.build_silver(spark, SCOPE, t)
    MD.build_profiles(spark, t)
    MD.load_bronze_period(spark, paths[FOCUS], FOCUS, t)
    refreshed = MD.refresh_silver(spark, [FOCUS], SCOPE, t)
    MD.refresh_profiles(spark, [FOCUS], refreshed["meses"], t)
    b, s = spark.table(t.bronze_states), spark.table(t.silver_states)
    months = ST.distinct_months(b, by=("_ref_period",))
    per_period = ST.out_of_month(b).join(
        ST.period_volume(b).select("_ref_period", "registros"), "_ref_period").join(
        months, "_ref_period", "left")
    day = "timestamp_ntz"
    return (
        per_period.select(
            F.lit("A10").alias("perfil"), F.col("_ref_period").alias("chave"), "registros",
            F.coalesce("months", F.lit(0)).cast("long").alias("distintos"),
            F.col("pickup_minimo").alias("minimo"), F.col("pickup_maximo").alias("maximo"))
        .unionByName(ST.panorama(b).select(
            F.lit("A13").alias("perfil"), F.col("competencias").cast("string").alias("chave"),
            "registros", F.col("meses_distintos").alias("distintos"),
            F.col("pickup_minimo").alias("minimo"), F.col("pickup_maximo").alias("maximo")))
        .unionByName(ST.scope_check(s).select(
            F.lit("A26").alias("perfil"), F.col("pickup_year_month").alias("chave"),
            F.col("corridas").alias("registros"),
            F.col("arquivos_contribuintes").alias("distintos"),
            F.col("primeiro_dia").cast(day).alias("minimo"),
            F.col("ultimo_dia").cast(day).alias("maximo")))
    )


@register("landing_listing")
def landing_listing(spark, sf_dir):
    """The driver's Parquet files with sizes (no content read)."""
    from tripledger.sources.landing import landing_listing as listing

    return listing(spark, sf_dir)


@register("landing_fingerprint")
def landing_fingerprint(spark, sf_dir):
    """L1: SHA-256 and size of each of the driver's Parquet files."""
    from tripledger.sources.landing import landing_fingerprint as fingerprint

    return fingerprint(spark, sf_dir)


@register("schema_probe")
def schema_probe(spark, sf_dir):
    """Columns and types of each driver table, from the footers."""
    from functools import reduce

    from tripledger.sources.landing import schema_probe as probe

    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(TD.TABLES)) as pool:
        frames = list(pool.map(lambda t: probe(spark, f"{sf_dir.rstrip('/')}/{t}.parquet"),
                               TD.TABLES))
    return reduce(DataFrame.unionByName, frames)


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landing runs over the driver's files: the first against an empty
    manifest (everything loads) and appends its records; the second against
    that manifest (everything unchanged is skipped)."""
    from tripledger.operators import ingest as I
    from tripledger.sources.landing import MANIFEST_SCHEMA, landing_fingerprint, read_manifest

    # Stored, so that every file is hashed once, not once per use.
    fp = stored(spark, landing_fingerprint(spark, sf_dir).withColumn(
        "period", F.regexp_extract("landing_path", r"([^/]+)\.parquet$", 1)), "fingerprints")
    manifest_dir = scratch_path(spark, "manifest")
    empty = spark.createDataFrame([], MANIFEST_SCHEMA)
    first = I.ingest_decision(fp, empty)
    I.manifest_records(first).write.mode("append").json(manifest_dir)
    second = I.ingest_decision(fp, read_manifest(spark, manifest_dir))
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))


@register("ingest_decision")
def ingest_decision(spark, sf_dir):
    """L2 + L3: load/skip decision per landed file over two runs."""
    return _decisions(spark, sf_dir)


@register("ingest_summary")
def ingest_summary(spark, sf_dir):
    """Files and MiB per status, per run."""
    from tripledger.operators import ingest as I

    return I.ingest_summary(_decisions(spark, sf_dir), by=("run",))


@register("sql_twins_agree")
def sql_twins_agree(spark, sf_dir):
    """U2/C3 across APIs: Spark SQL twins against the DataFrame operators
    (A3, A4, A12, A14, A21); every count is 0 when they agree."""
    from tripledger.plans import sql as S

    b = stored(spark, bronze(spark, sf_dir), "twins-bronze")
    s = Q.valid_rows(Q.classify(b, SCOPE))
    pairs = {
        "divergencias_a3": (S.monthly_report_sql(spark, s), M.monthly_report(M.monthly_sums(s))),
        "divergencias_a4": (S.hourly_report_sql(spark, s, FOCUS),
                            M.hourly_report(M.hourly_passengers(s, FOCUS))),
        "divergencias_a12": (S.reload_detector_sql(spark, b), P.reload_detector(b)),
        "divergencias_a14": (S.month_sources_sql(spark, b).withColumn(
            "arquivos_de_origem", F.array_join("arquivos_de_origem", ",")),
            P.month_sources(b).withColumn("arquivos_de_origem",
                                          F.array_join("arquivos_de_origem", ","))),
        "divergencias_a21": (S.duplicate_summary_sql(spark, b), P.duplicate_summary(b)),
    }
    rows = [C.symmetric_difference(a, d.select(*a.columns))
            .select(F.lit(name).alias("_k"), "divergencias") for name, (a, d) in pairs.items()]
    from functools import reduce

    both = reduce(DataFrame.unionByName, rows)
    return both.agg(*[F.max(F.when(F.col("_k") == n, F.col("divergencias"))).alias(n)
                      for n in pairs])
