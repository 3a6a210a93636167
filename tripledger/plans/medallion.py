"""Table builds: landing -> bronze -> silver + quarantine -> gold.

* bronze: one partition per file period, replaced idempotently (W1, W4);
  nothing is filtered.  Its commits count the rows per (file period, trip
  month): the index that refreshes go by.
* silver and quarantine: views over one table of classified rows, whose
  partitions ("slots") are the *trip* months of the valid rows and the file
  periods of the discarded ones (W5).  One job reads bronze once and writes
  both, and one commit publishes both.
* gold: the two answers, monthly revenue and hourly passengers (W6), merged
  from states per (file period, trip month): amounts with their counts, and
  passenger sums per hour.
* ``refresh_silver``, ``refresh_gold``: after some periods were reloaded (E1),
  from the bronze partitions that the index names; a period's states replace
  its old ones, and only the affected months are written.

Each write is one Spark job (scan -> project -> write), with a shuffle only
where a metric groups, and one commit (see ``sinks.tables``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.config import (
    BRONZE_PARTITION,
    DEFAULT_SPEC,
    REASON_COLUMN,
    SILVER_PARTITION,
    Scope,
    TripSpec,
)
from tripledger.functions import trips as T
from tripledger.operators import metrics as M
from tripledger.operators import quality as Q
from tripledger.operators import states as ST
from tripledger.sinks import tables as W
from tripledger.sources.landing import read_landing, read_landing_grouped

TABLE_COMMENTS = {
    "bronze": "Bronze: source schema cast to canonical types plus audit columns; no row filtered.",
    "silver": "Silver: one row per valid trip, suspicious rows kept and flagged in flag_* columns.",
    "quarantine": "Quarantine: rows removed from silver, with the reason in motivo_descarte.",
    "monthly": "Gold: monthly total_amount, as mean ticket and as fleet revenue, with and "
               "without non-positive amounts.",
    "hourly": "Gold: mean passengers per pickup hour of one month, with the null treatments.",
}


@dataclass(frozen=True)
class Tables:
    """Catalog names of the layers (``database.table``)."""

    bronze: str = "bronze.yellow_tripdata"
    silver: str = "silver.fact_yellow_trips"
    quarantine: str = "silver.fact_yellow_trips_quarantine"
    monthly: str = "gold.yellow_trips_monthly"
    hourly: str = "gold.yellow_trips_hourly_passengers"
    classified: str = "silver.classified_trips"
    monthly_states: str = "gold.monthly_states"
    hourly_states: str = "gold.hourly_states"
    bronze_states: str = "gold.bronze_states"
    silver_states: str = "gold.silver_states"

    def databases(self) -> tuple[str, ...]:
        names = [t.split(".")[0] for t in (self.bronze, self.silver, self.quarantine,
                                           self.monthly, self.hourly)]
        return tuple(dict.fromkeys(names))

    @classmethod
    def prefixed(cls, prefix: str) -> "Tables":
        """Same layout in databases named ``<prefix>_bronze`` etc."""
        d = cls()
        return cls(**{k: f"{prefix}_{v}" for k, v in d.__dict__.items()})


@dataclass
class LoadResult:
    period: str
    status: str
    rows: int | None = None
    error: str | None = None
    missing_optional: list[str] = field(default_factory=list)
    unexpected: list[str] = field(default_factory=list)


def _replace_bronze(spark: SparkSession, df: DataFrame, periods: list[str],
                    tables: Tables, spec: TripSpec = DEFAULT_SPEC) -> int:
    """The bronze partitions of ``periods`` become the rows of ``df``; their trip
    months are counted in the same commit."""
    return W.replace_partitions(spark, df, tables.bronze, BRONZE_PARTITION, periods,
                                T.year_month(spec.pickup), TABLE_COMMENTS["bronze"])


def load_bronze_period(spark: SparkSession, path: str, period: str,
                       tables: Tables = Tables()) -> LoadResult:
    """Read one period's landing file(s) and replace its bronze partition."""
    read = read_landing(spark, path, period)
    rows = _replace_bronze(spark, read.df, [period], tables)
    return LoadResult(period, "loaded", rows, None, read.missing_optional, read.unexpected)


def build_bronze(spark: SparkSession, paths: dict[str, str],
                 tables: Tables = Tables()) -> list[LoadResult]:
    """W4 + L4: load every period; a failing period is reported as failed and
    the others still load.  Use :func:`assert_complete` before going on."""
    W.ensure_namespaces(spark, tables.databases())
    results = []
    for period, path in sorted(paths.items()):
        try:
            results.append(load_bronze_period(spark, path, period, tables))
        except Exception as exc:  # noqa: BLE001 - isolation per period is the point
            results.append(LoadResult(period, "failed", error=f"{type(exc).__name__}: {exc}"))
    return results


def load_bronze_all(spark: SparkSession, paths: dict[str, str],
                    tables: Tables = Tables()) -> int:
    """W4 in one pass: every period, read per schema group, written and published
    as one replacement of exactly the given periods: one that was republished
    without rows ends up empty, not stale.

    The per-period loop of :func:`build_bronze` runs one job per period; this
    runs one scan per schema group and a single write, which is what a
    thousand-file backfill needs.  Returns the rows written."""
    W.ensure_namespaces(spark, tables.databases())
    return _replace_bronze(spark, read_landing_grouped(spark, paths), list(paths), tables)


def assert_complete(results: list[LoadResult]) -> None:
    """Refuse to continue on a partial load."""
    failed = [r.period for r in results if r.status == "failed"]
    if failed:
        raise RuntimeError(f"incomplete load, failed periods: {failed}")


# A slot is the partition of a classified row: its kind, then month or period.
SLOT, VALID, DISCARDED = "_slot", "s", "q"


def _slot(kind: str, value: str | None) -> str:
    return kind + (value or "")


def _with_slot(classified: DataFrame) -> DataFrame:
    kept = F.col(REASON_COLUMN).isNull()
    return Q.stamp_processed(classified).withColumn(SLOT, F.when(kept, F.concat(
        F.lit(VALID), F.coalesce(SILVER_PARTITION, F.lit("")))).otherwise(
        F.concat(F.lit(DISCARDED), F.coalesce(BRONZE_PARTITION, F.lit("")))))


def _layer_views(spark: SparkSession, tables: Tables) -> None:
    """Silver and quarantine as readers see them; their partition columns are read
    off the slot, so that filters on them prune folders."""
    columns = [c for c in spark.table(tables.classified).columns if c != SLOT]
    layers = ((tables.silver, VALID, SILVER_PARTITION, TABLE_COMMENTS["silver"]),
              (tables.quarantine, DISCARDED, BRONZE_PARTITION, TABLE_COMMENTS["quarantine"]))
    for name, kind, part, comment in layers:
        others = [f"`{c}`" for c in columns if c != part
                  and not (kind == VALID and c == REASON_COLUMN)]
        spark.sql(
            f"CREATE OR REPLACE VIEW {name} COMMENT '{comment}' AS SELECT {', '.join(others)}, "
            f"nullif(substring({SLOT}, 2), '') AS {part} FROM {tables.classified} "
            f"WHERE substring({SLOT}, 1, 1) = '{kind}'")


def _rows_of(counts: list[list], kind: str) -> int:
    return sum(rows for slot, _, rows in counts if slot.startswith(kind))


def build_silver(spark: SparkSession, scope: Scope, tables: Tables = Tables(),
                 spec: TripSpec = DEFAULT_SPEC) -> dict[str, int]:
    """Rebuild silver and quarantine from the whole bronze table.

    One job reads bronze once and writes every row to its slot; both layers
    change in the one commit of the classified table."""
    W.ensure_namespaces(spark, tables.databases())
    rows = _with_slot(Q.classify(spark.table(tables.bronze), scope, spec))
    counts = W.commit(spark, rows, tables.classified, SLOT, "all", F.col(BRONZE_PARTITION))
    _layer_views(spark, tables)
    return {"validos": _rows_of(counts, VALID), "descartados": _rows_of(counts, DISCARDED)}


def affected_months(spark: SparkSession, periods: list[str], tables: Tables = Tables(),
                    scope: Scope | None = None) -> list[str | None]:
    """Trip months whose silver rows can change when bronze ``periods`` were
    reloaded: the months that the index counts in the new bronze rows, and those
    of the silver rows of these periods (None: trips without a pickup, which are
    valid and have a slot too), of ``scope`` only if given.  Reads manifests, no table."""
    new = set(W.manifest(spark, tables.bronze).marks_of(periods))
    old = {slot[1:] or None for slot in W.manifest(spark, tables.classified).values_with(periods)
           if slot.startswith(VALID)}
    return sorted((m for m in new | old if m is None or scope is None
                   or scope.first <= m <= scope.last), key=lambda m: (m is None, m or ""))


def _pruned_bronze(spark: SparkSession, periods: set[str | None], tables: Tables) -> DataFrame:
    named = [p for p in periods if p is not None]
    col = F.col(BRONZE_PARTITION)
    return spark.table(tables.bronze).where(
        col.isin(named) | col.isNull() if None in periods else col.isin(named))


def refresh_silver(spark: SparkSession, periods: list[str], scope: Scope,
                   tables: Tables = Tables(), spec: TripSpec = DEFAULT_SPEC) -> dict:
    """Bring silver and quarantine up to date after bronze ``periods``
    were reloaded, rewriting only what can have changed, in one job and commit:
    the quarantine slots of these periods and the silver slots of every affected
    trip month.

    The index names the file periods that hold rows of the affected months, so
    only their bronze partitions are read.  An emptied month or period ends up
    empty, not stale, and a failure leaves both layers as they were.
    """
    months = affected_months(spark, periods, tables, scope)
    sources = W.manifest(spark, tables.bronze).values_with(months) | set(periods)
    slots = [_slot(VALID, m) for m in months] + [_slot(DISCARDED, p) for p in periods]
    rows = _with_slot(Q.classify(_pruned_bronze(spark, sources, tables), scope, spec))
    counts = W.commit(spark, rows.where(F.col(SLOT).isin(slots)), tables.classified, SLOT, slots,
                      F.col(BRONZE_PARTITION))
    return {"quarentena": _rows_of(counts, DISCARDED), "silver": _rows_of(counts, VALID),
            "meses": months}


def _write_states(spark: SparkSession, valid: DataFrame, tables: Tables, spec: TripSpec,
                  periods: list[str] | str) -> None:
    """Gold states of these file periods (or ``"all"``) from their valid rows."""
    month = F.col(SILVER_PARTITION)
    for table, states in (
            (tables.monthly_states, M.amount_counts(valid, spec, [BRONZE_PARTITION])),
            (tables.hourly_states, M.hourly_parts(
                valid, spec, [BRONZE_PARTITION, SILVER_PARTITION]))):
        W.commit(spark, states, table, BRONZE_PARTITION, periods, month)


def _states(spark: SparkSession, table: str, months: list[str | None]) -> DataFrame:
    """The states of these months, from the file periods that have any."""
    periods = [p for p in W.manifest(spark, table).values_with(months)]
    month = F.col(SILVER_PARTITION)
    wanted = month.isin([m for m in months if m is not None])
    return spark.table(table).where(F.col(BRONZE_PARTITION).isin(periods)).where(
        wanted | month.isNull() if None in months else wanted)


def _write_hourly(spark: SparkSession, focus_period: str, tables: Tables) -> int:
    hourly = M.hourly_from_parts(_states(spark, tables.hourly_states, [focus_period]))
    return W.rebuild(spark, hourly.coalesce(1), tables.hourly, comment=TABLE_COMMENTS["hourly"])


def build_gold(spark: SparkSession, focus_period: str, tables: Tables = Tables(),
               spec: TripSpec = DEFAULT_SPEC) -> dict[str, int]:
    """Materialise the two answers from silver (unrounded), and their states."""
    W.ensure_namespaces(spark, tables.databases())
    _write_states(spark, spark.table(tables.silver), tables, spec, "all")
    monthly = M.monthly_from_amounts(spark.table(tables.monthly_states))
    n_m = W.rebuild(spark, monthly.coalesce(1), tables.monthly, SILVER_PARTITION,
                    TABLE_COMMENTS["monthly"])
    return {"monthly": n_m, "hourly": _write_hourly(spark, focus_period, tables)}


def refresh_gold(spark: SparkSession, periods: list[str], months: list[str | None], scope: Scope,
                 focus_period: str, tables: Tables = Tables(),
                 spec: TripSpec = DEFAULT_SPEC) -> dict[str, int]:
    """Gold after bronze ``periods`` were reloaded and silver refreshed in
    ``months``: the states of the periods are replaced, from their bronze
    partitions, and the affected months merged anew from all states."""
    batch = Q.classify(_pruned_bronze(spark, set(periods), tables), scope, spec)
    _write_states(spark, Q.valid_rows(batch), tables, spec, periods)
    monthly = M.monthly_from_amounts(_states(spark, tables.monthly_states, months))
    n_m = W.replace_partitions(spark, monthly.coalesce(1), tables.monthly, SILVER_PARTITION, months)
    n_h = _write_hourly(spark, focus_period, tables) if focus_period in months else 0
    return {"monthly": n_m, "hourly": n_h}


def build_profiles(spark: SparkSession, tables: Tables = Tables(),
                   spec: TripSpec = DEFAULT_SPEC) -> None:
    """The states that A10, A11, A13, A14 and A26 are merged from: one scan of
    bronze and one of silver."""
    W.ensure_namespaces(spark, tables.databases())
    W.commit(spark, ST.bronze_states(spark.table(tables.bronze), spec),
             tables.bronze_states, BRONZE_PARTITION)
    W.commit(spark, ST.silver_states(spark.table(tables.silver), spec),
             tables.silver_states, SILVER_PARTITION)


def refresh_profiles(spark: SparkSession, periods: list[str], months: list[str | None],
                     tables: Tables = Tables(), spec: TripSpec = DEFAULT_SPEC) -> None:
    """After bronze ``periods`` were reloaded and silver refreshed in
    ``months``, their states are replaced; only their partitions are read."""
    W.replace_partitions(
        spark, ST.bronze_states(_pruned_bronze(spark, set(periods), tables), spec),
        tables.bronze_states, BRONZE_PARTITION, periods)
    col = F.col(SILVER_PARTITION)
    named = col.isin([m for m in months if m is not None])
    rows = spark.table(tables.silver).where(named | col.isNull() if None in months else named)
    W.replace_partitions(spark, ST.silver_states(rows, spec), tables.silver_states,
                         SILVER_PARTITION, months)


def conservation_tables(spark: SparkSession, tables: Tables = Tables()) -> DataFrame:
    """C1 over the written tables."""
    from tripledger.operators.checks import conservation

    return conservation(spark.table(tables.bronze), spark.table(tables.silver),
                        spark.table(tables.quarantine))
