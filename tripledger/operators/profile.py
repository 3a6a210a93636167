"""Profiling queries over bronze (file-level) and silver/quarantine tables.

The single-row profiles A16, A18 and A22 are projections of one fused
aggregate, :func:`global_profile`.  Catalyst prunes the aggregate expressions
a projection does not use, so a single profile costs only its own work while
asking for all of them costs one scan and one aggregate.  A15 and A17 need
exact quantiles, so they count rows per value first and read every column
off that histogram in one final aggregate.  Distinct counts
are done in two phases (group by the values first), so the ``Expand`` that
Spark uses for several distinct counts runs over the aggregated pairs, never
over the trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.config import (
    DEFAULT_SPEC,
    FLAG_COLUMNS,
    REASON_COLUMN,
    REQUIRED_COLUMNS,
    Scope,
    TripSpec,
)
from tripledger.functions import trips as T
from tripledger.operators.membership import members, possible_members
from tripledger.operators.quantiles import quantiles_from_histogram, value_histogram

# Quantiles of the amount distribution (A17), in output order.
AMOUNT_QUANTILES = (("p01", 0.01), ("p25", 0.25), ("mediana", 0.5), ("p75", 0.75),
                    ("p99", 0.99), ("p9999", 0.9999))

# Output names of the completeness profile (A22), per required column.
NULL_COUNT_NAMES = {
    "VendorID": "vendor_nulo",
    "tpep_pickup_datetime": "pickup_nulo",
    "tpep_dropoff_datetime": "dropoff_nulo",
    "passenger_count": "passageiros_nulo",
    "total_amount": "valor_nulo",
}


def period_volume(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """A10: per file period, rows, distinct source files, first ingestion."""
    return (
        bronze.groupBy(spec.ref_period)
        .agg(
            F.count(F.lit(1)).alias("registros"),
            F.countDistinct("_source_file").alias("arquivos_origem"),
            F.min("_ingested_at").alias("ingerido_em"),
        )
        .orderBy(spec.ref_period)
    )


def out_of_month(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Per file period, pickup range and trips whose month is another."""
    other = T.year_month(spec.pickup) != F.col(spec.ref_period)
    return (
        bronze.groupBy(spec.ref_period)
        .agg(
            F.min(spec.pickup).alias("pickup_minimo"),
            F.max(spec.pickup).alias("pickup_maximo"),
            T.count_if(other).alias("corridas_fora_do_mes"),
            F.count(F.lit(1)).alias("_n"),
        )
        .select(
            spec.ref_period, "pickup_minimo", "pickup_maximo", "corridas_fora_do_mes",
            T.percent(F.col("corridas_fora_do_mes"), F.col("_n"), 4).alias("pct_fora_do_mes"),
        )
        .orderBy(spec.ref_period)
    )


def reload_detector(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Periods holding more than one ingestion batch (expected: none)."""
    return (
        bronze.groupBy(spec.ref_period)
        .agg(F.countDistinct("_ingested_at").alias("lotes_distintos"))
        .filter(F.col("lotes_distintos") > 1)
    )


def _period_month_counts(bronze: DataFrame, spec: TripSpec) -> DataFrame:
    """(file period, trip month) pairs with row count and pickup range."""
    return bronze.groupBy(
        F.col(spec.ref_period).alias("_p"), T.year_month(spec.pickup).alias("_m")
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(spec.pickup).alias("_lo"),
        F.max(spec.pickup).alias("_hi"),
    )


def panorama(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows, file periods, pickup range, distinct trip months.

    Two phases: group by (period, month), then a small global aggregate."""
    pairs = _period_month_counts(bronze, spec)
    return pairs.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("registros"),
        F.countDistinct("_p").alias("competencias"),
        F.min("_lo").alias("pickup_minimo"),
        F.max("_hi").alias("pickup_maximo"),
        F.countDistinct("_m").alias("meses_distintos"),
    )


def month_sources(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows per trip month and the sorted set of file periods feeding it."""
    return (
        bronze.groupBy(T.year_month(spec.pickup).alias("mes_real"))
        .agg(
            F.count(F.lit(1)).alias("registros"),
            F.sort_array(F.collect_set(spec.ref_period)).alias("arquivos_de_origem"),
        )
        .orderBy("mes_real")
    )


def global_profile(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """One row with the single-row bronze profiles (A15 to A18, A22) except
    their quantiles.  A16, A18 and A22 are projections of it; A15 and A17,
    which need exact quantiles, read the same counts off their histogram."""
    secs = T.elapsed_seconds(spec)
    amount = F.col(spec.amount)
    aggs = [
        F.count(F.lit(1)).alias("total"),
        # A15 duration
        T.count_if(secs.isNull()).alias("sem_duracao"),
        T.count_if(secs < 0).alias("duracao_negativa"),
        T.count_if(secs == 0).alias("duracao_zero"),
        T.count_if(secs > 86400).alias("acima_de_24h"),
        F.round(F.avg(secs) / 60, 1).alias("media_minutos"),
        F.round(F.max(secs) / 3600, 1).alias("maximo_horas"),
        # A16 non-positive amounts
        T.count_if(amount.isNull()).alias("nulos"),
        T.count_if(amount < 0).alias("negativos"),
        T.count_if(amount == 0).alias("zerados"),
        T.count_if(amount <= 0).alias("_nao_positivos"),
        F.round(F.sum(F.when(amount < 0, amount).otherwise(F.lit(0.0))), 2).alias("soma_dos_negativos"),
        # A17 distribution
        F.round(F.min(amount), 2).alias("minimo"),
        F.round(F.avg(amount), 2).alias("media"),
        F.round(F.max(amount), 2).alias("maximo"),
        # A18 outlier weight
        F.round(F.avg(amount), 4).alias("media_bruta"),
        F.round(F.avg(F.when(amount > 0, amount)), 4).alias("media_positivos"),
        F.round(F.avg(F.when(amount.between(0.01, 1000), amount)), 4).alias("media_ate_1000"),
        F.count(F.when(amount > 1000, F.lit(1))).alias("acima_de_1000"),
    ]
    aggs += [T.count_if(F.col(c).isNull()).alias(NULL_COUNT_NAMES.get(c, f"{c}_nulo"))
             for c in _required_names(spec)]
    row = bronze.agg(*aggs)
    return row.select(
        "*", T.percent(F.col("_nao_positivos"), F.col("total"), 4).alias("pct_nao_positivos"),
    ).drop("_nao_positivos")


def _required_names(spec: TripSpec) -> list[str]:
    """The required columns under the names ``spec`` uses, in A22 order."""
    by_default = {
        "VendorID": spec.vendor, "tpep_pickup_datetime": spec.pickup,
        "tpep_dropoff_datetime": spec.dropoff, "passenger_count": spec.passengers,
        "total_amount": spec.amount,
    }
    order = ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
             "passenger_count", "total_amount")
    assert set(order) == set(REQUIRED_COLUMNS)
    return [by_default[c] for c in order]


def duration_profile(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Duration counts by sign, over 24 h, mean/median minutes, max hours.

    One pipeline: rows are counted per duration (map-side), and every column,
    the exact median included (see :mod:`tripledger.operators.quantiles`), is
    read off that histogram in one final aggregate.  The mean sums doubles,
    as ``avg`` does."""
    secs = T.elapsed_seconds(spec)
    hist = bronze.select(secs.alias("_v")).groupBy("_v").agg(
        F.count("_v").alias("_c"), F.count(F.lit(1)).alias("_rows"))
    v, rows = F.col("_v"), F.col("_rows")

    def rows_where(cond):
        return F.sum(F.when(cond, rows).otherwise(F.lit(0))).cast("long")

    known = F.when(v.isNotNull(), rows)
    extra = [
        F.sum(rows).cast("long").alias("total"),
        rows_where(v.isNull()).alias("sem_duracao"),
        rows_where(v < 0).alias("duracao_negativa"),
        rows_where(v == 0).alias("duracao_zero"),
        rows_where(v > 86400).alias("acima_de_24h"),
        F.round(F.try_divide(F.sum(v.cast("double") * known), F.sum(known).cast("double"))
                / 60, 1).alias("media_minutos"),
        F.round(F.max(v) / 3600, 1).alias("maximo_horas"),
    ]
    out = quantiles_from_histogram(hist, [("_med", 0.5)], extra=extra)
    return out.select(
        "total", "sem_duracao", "duracao_negativa", "duracao_zero", "acima_de_24h",
        "media_minutos", F.round(F.col("_med") / 60, 1).alias("mediana_minutos"),
        "maximo_horas")


def amount_nonpositive(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """NULL, negative and zero amounts, their share and negative sum."""
    return global_profile(bronze, spec).select(
        "total", "nulos", "negativos", "zerados", "pct_nao_positivos", "soma_dos_negativos",
    )


def amount_distribution(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Min, p01, p25, median, mean, p75, p99, p99.99, max (2 dp).

    One pipeline: rows are counted per amount (map-side) and the exact
    quantiles (see :mod:`tripledger.operators.quantiles`), the extremes and
    the mean are read off that histogram in one final aggregate."""
    hist = value_histogram(bronze, spec.amount).withColumn("_w", F.col("_c"))
    v, w = F.col("_v"), F.col("_w")
    extra = [
        F.round(F.min(v), 2).alias("minimo"),
        F.round(F.try_divide(F.sum(v * w), F.sum(F.when(v.isNotNull(), w)).cast("double")), 2)
        .alias("media"),
        F.round(F.max(v), 2).alias("maximo"),
    ]
    q = quantiles_from_histogram(hist, list(AMOUNT_QUANTILES), extra=extra)
    return q.select(
        "minimo", *[F.round(n, 2).alias(n) for n, _ in AMOUNT_QUANTILES[:3]], "media",
        *[F.round(n, 2).alias(n) for n, _ in AMOUNT_QUANTILES[3:]], "maximo")


def outlier_weight(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Mean raw, positive only, within [0.01, 1000]; count above 1000."""
    return global_profile(bronze, spec).select(
        "media_bruta", "media_positivos", "media_ate_1000", "acima_de_1000",
    )


def completeness(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Total rows and NULL count of each required column."""
    return global_profile(bronze, spec).select(
        "total", *[NULL_COUNT_NAMES.get(c, f"{c}_nulo") for c in _required_names(spec)]
    )


def passenger_histogram(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """A19 + N1: rows per passenger value and percent of all rows, NULL first.

    The ratio-to-total window runs over the aggregated rows (one per distinct
    value), so its single-partition exchange is tiny."""
    counts = bronze.groupBy(spec.passengers).agg(F.count(F.lit(1)).alias("registros"))
    total = F.sum("registros").over(Window.partitionBy())
    return counts.select(
        spec.passengers, "registros", T.percent(F.col("registros"), total, 4).alias("pct")
    ).orderBy(F.col(spec.passengers).asc_nulls_first())


def null_treatment(bronze: DataFrame, period: str, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """The three passenger means of one month, and its trip count."""
    p = F.col(spec.passengers)
    return bronze.filter(T.in_month(period, spec.pickup)).agg(
        F.round(F.avg(p), 4).alias("media_ignorando_nulos"),
        F.round(F.avg(F.coalesce(p, F.lit(0))), 4).alias("media_nulo_como_zero"),
        F.round(F.avg(F.when(p > 0, p)), 4).alias("media_so_positivos"),
        F.count(F.lit(1)).alias("corridas_maio"),
    )


def duplicate_keys(spec: TripSpec = DEFAULT_SPEC) -> list[str]:
    """The six columns that identify a trip candidate."""
    return [spec.vendor, spec.pickup, spec.dropoff, spec.pickup_location,
            spec.dropoff_location, spec.amount]


def duplicate_summary(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Repeated key combinations, rows involved, excess rows, largest group.

    The group count is combinable, so a hot key is counted map-side before the
    shuffle and no task ever holds the rows of one key.  Sums are NULL when
    nothing repeats, as in SQL."""
    keys = keys or duplicate_keys()
    repeated = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("ocorrencias"))
        .filter(F.col("ocorrencias") > 1)
    )
    return repeated.agg(
        F.count(F.lit(1)).alias("combinacoes_repetidas"),
        F.sum("ocorrencias").alias("registros_envolvidos"),
        F.sum(F.col("ocorrencias") - 1).alias("excedentes"),
        F.max("ocorrencias").alias("maior_repeticao"),
    )


def duplicate_summary_by_digest(df: DataFrame, keys: list[str] | None = None,
                                digest: Column | None = None) -> DataFrame:
    """A21 in two phases, for keys much wider than 64 bits.

    First only a 64-bit ``digest`` of each row's key is shuffled and counted;
    then the whole keys of just the rows whose digest occurs more than once,
    picked by a membership filter of those digests, whose size is bounded.  The
    counts are those of whole keys, so colliding digests, and rows that pass the
    filter by chance, cost work but never change the result.  Equal keys must
    have equal digests, as those of ``xxhash64`` have (NULLs, NaNs and both zeros
    included).  ``df`` is read twice, so it should be a stored table; where most
    keys repeat, :func:`duplicate_summary` does less."""
    keys = keys or duplicate_keys()
    rows = df.select(*keys, (F.xxhash64(*keys) if digest is None else digest).alias("_digest"))
    repeated = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return duplicate_summary(
        possible_members(rows, ["_digest"], members(repeated, ["_digest"])), keys)


def vendor_domain(bronze: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows per vendor code, most frequent first."""
    return (
        bronze.groupBy(spec.vendor)
        .agg(F.count(F.lit(1)).alias("registros"))
        .orderBy(F.desc("registros"), spec.vendor)
    )


def month_with_footer(bronze: DataFrame, scope: Scope, spec: TripSpec = DEFAULT_SPEC,
                      footer_label: str = "MÉDIA DOS MESES") -> DataFrame:
    """A24 + U1: per trip month in scope, trips, mean ticket and revenue, plus
    a footer row with the average of the months (trips widen to double)."""
    amount = F.col(spec.amount)
    per_month = (
        bronze.filter(T.in_period_range(scope, spec.pickup))
        .groupBy(T.year_month(spec.pickup).alias("mes"))
        .agg(
            F.sum(amount).alias("faturamento"),
            F.avg(amount).alias("ticket_medio"),
            F.count(F.lit(1)).alias("corridas"),
        )
    )
    detail = per_month.select(
        "mes",
        F.col("corridas").cast("double").alias("corridas"),
        F.round("ticket_medio", 2).alias("ticket_medio_leitura_a"),
        F.round("faturamento", 2).alias("faturamento_do_mes"),
    )
    footer = per_month.agg(
        F.lit(footer_label).alias("mes"),
        F.round(F.avg("corridas")).alias("corridas"),
        F.round(F.avg("ticket_medio"), 2).alias("ticket_medio_leitura_a"),
        F.round(F.avg("faturamento"), 2).alias("faturamento_do_mes"),
    )
    return detail.unionByName(footer).orderBy("mes")


def quarantine_summary(quarantine: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows and pickup range per discard reason, largest first."""
    return (
        quarantine.groupBy(REASON_COLUMN)
        .agg(
            F.count(F.lit(1)).alias("registros"),
            F.min(spec.pickup).alias("pickup_minimo"),
            F.max(spec.pickup).alias("pickup_maximo"),
        )
        .orderBy(F.desc("registros"), REASON_COLUMN)
    )


def scope_check(silver: DataFrame, spec: TripSpec = DEFAULT_SPEC) -> DataFrame:
    """Per silver month, trips, first and last day, contributing files."""
    return (
        silver.groupBy("pickup_year_month")
        .agg(
            F.count(F.lit(1)).alias("corridas"),
            F.min("pickup_date").alias("primeiro_dia"),
            F.max("pickup_date").alias("ultimo_dia"),
            F.countDistinct(spec.ref_period).alias("arquivos_contribuintes"),
        )
        .orderBy("pickup_year_month")
    )


FLAG_TOTAL_NAMES = {
    "flag_valor_nao_positivo": "valor_nao_positivo",
    "flag_duracao_extrema": "duracao_extrema",
    "flag_passageiros_ausente": "passageiros_ausente",
    "flag_passageiros_zero": "passageiros_zero",
    "flag_passageiros_implausivel": "passageiros_implausivel",
    "flag_vendor_fora_dicionario": "vendor_fora_dicionario",
}


def flag_totals(silver: DataFrame) -> DataFrame:
    """Total rows and how many carry each quality flag."""
    return silver.agg(
        F.count(F.lit(1)).alias("total"),
        *[T.count_if(F.col(f)).alias(FLAG_TOTAL_NAMES[f]) for f in FLAG_COLUMNS],
    )


def discard_rate(classified: DataFrame) -> DataFrame:
    """Kept, discarded, total and the discard percentage (4 dp)."""
    row = classified.agg(
        T.count_if(F.col(REASON_COLUMN).isNull()).alias("validos"),
        T.count_if(F.col(REASON_COLUMN).isNotNull()).alias("descartados"),
        F.count(F.lit(1)).alias("total"),
    )
    return row.select(
        "*", T.percent(F.col("descartados"), F.col("total"), 4).alias("pct_descarte")
    )


def trip_sample(silver: DataFrame, period: str, n: int = 20,
                spec: TripSpec = DEFAULT_SPEC, order: list[str] | None = None) -> DataFrame:
    """Consumer projection of one month, first ``n`` rows in a total
    order (the original sample had no order and so no fixed answer)."""
    cols = [spec.vendor, spec.pickup, spec.dropoff, spec.passengers, spec.amount,
            "pickup_year_month", "pickup_hour", "trip_duration_seconds"]
    order = order or cols
    return (
        silver.filter((F.col("pickup_year_month") == period) & T.in_month(period, spec.pickup))
        .select(*cols, *[c for c in order if c not in cols])
        .orderBy(*order)
        .limit(n)
        .select(*cols)
    )
