"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; none of them needs a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger.config import DEFAULT_SPEC, DEFAULT_THRESHOLDS, Scope, Thresholds, TripSpec


def duration_seconds(spec: TripSpec = DEFAULT_SPEC) -> Column:
    """Whole seconds between pickup and dropoff (each side truncated first)."""
    return F.unix_timestamp(F.col(spec.dropoff)) - F.unix_timestamp(F.col(spec.pickup))


def elapsed_seconds(spec: TripSpec = DEFAULT_SPEC) -> Column:
    """Seconds between pickup and dropoff, the difference truncated.

    Differs from :func:`duration_seconds` only for sub-second timestamps; the
    profiling queries use this one, the silver layer the other.
    """
    return F.timestamp_diff("SECOND", F.col(spec.pickup), F.col(spec.dropoff))


def year_month(col: str | Column) -> Column:
    """``yyyy-MM`` of a timestamp (needs the session zone pinned to UTC)."""
    return F.date_format(col, "yyyy-MM")


def out_of_scope(scope: Scope, spec: TripSpec = DEFAULT_SPEC) -> Column:
    """True when the trip's month is outside ``scope``; NULL for a NULL pickup.

    Same answer as testing ``yyyy-MM`` of the pickup against the period range,
    but as a timestamp range: no string formatting per row, and pushable."""
    return ~in_period_range(scope, spec.pickup)


def in_period_range(scope: Scope, col: str) -> Column:
    """Half-open timestamp range equivalent of ``year_month(col) in scope``.

    Unlike a ``date_format`` test, both bounds reach the Parquet reader as
    pushed filters, so row groups outside the scope are skipped.
    """
    c = F.col(col)
    return (c >= F.lit(scope.start_literal()).cast("timestamp_ntz")) & (
        c < F.lit(scope.end_literal()).cast("timestamp_ntz")
    )


def in_month(period: str, col: str) -> Column:
    """Half-open timestamp range of one month, pushable to the scan."""
    return in_period_range(Scope(period, period), col)


def flag_columns(spec: TripSpec = DEFAULT_SPEC,
                 thresholds: Thresholds = DEFAULT_THRESHOLDS,
                 duration: Column | None = None) -> dict[str, Column]:
    """The six quality flags, keyed by output name, in table order."""
    duration = duration if duration is not None else F.col("trip_duration_seconds")
    passengers = F.col(spec.passengers)
    return {
        "flag_valor_nao_positivo": F.col(spec.amount) <= 0,
        "flag_duracao_extrema": duration > thresholds.extreme_duration_seconds,
        "flag_passageiros_ausente": passengers.isNull(),
        "flag_passageiros_zero": passengers == 0,
        "flag_passageiros_implausivel": passengers > thresholds.max_passengers,
        "flag_vendor_fora_dicionario": ~F.col(spec.vendor).isin(*thresholds.vendors),
    }


def discard_reason(scope: Scope, spec: TripSpec = DEFAULT_SPEC,
                   duration: Column | None = None) -> Column:
    """First matching discard reason, NULL for a row that stays."""
    from tripledger.config import REASON_BAD_DURATION, REASON_OUT_OF_SCOPE

    duration = duration if duration is not None else F.col("trip_duration_seconds")
    return F.when(out_of_scope(scope, spec), F.lit(REASON_OUT_OF_SCOPE)).when(
        duration <= 0, F.lit(REASON_BAD_DURATION)
    )


def count_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as BIGINT (NULL cond counts 0)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``round(100 * part / whole, digits)`` as DOUBLE; NULL when whole is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), digits)


def hour_label(col: str | Column) -> Column:
    """Hour as a two-digit label with an ``h`` suffix: 3 -> ``03h``."""
    return F.concat(F.lpad(F.col(col) if isinstance(col, str) else col, 2, "0"), F.lit("h"))
