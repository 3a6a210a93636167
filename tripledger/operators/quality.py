"""Row classification: derived columns, quality flags and the discard reason.

``classify`` only annotates; it never filters, so the same projection feeds
both the valid rows and the quarantine and the two can never disagree.  It is
one ``select`` over the input, which Catalyst fuses with the scan and with the
filters of ``split`` into a single code-generated stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.config import (
    DEFAULT_SPEC,
    DEFAULT_THRESHOLDS,
    REASON_COLUMN,
    Scope,
    Thresholds,
    TripSpec,
)
from tripledger.functions import trips as T


def classify(df: DataFrame, scope: Scope, spec: TripSpec = DEFAULT_SPEC,
             thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Input columns + 5 derived columns + 6 flags + ``motivo_descarte``.

    The discard reason is the first that applies: out of scope, then a
    non-positive duration.  NULL pickups give a NULL scope test and therefore
    fall through to "valid" with a NULL month, as in the original rules.
    """
    duration = T.duration_seconds(spec)
    derived = [
        duration.alias("trip_duration_seconds"),
        T.year_month(spec.pickup).alias("pickup_year_month"),
        F.to_date(F.col(spec.pickup)).alias("pickup_date"),
        F.hour(F.col(spec.pickup)).alias("pickup_hour"),
        F.dayofweek(F.col(spec.pickup)).alias("pickup_day_of_week"),
    ]
    flags = [c.alias(n) for n, c in T.flag_columns(spec, thresholds, duration).items()]
    reason = T.discard_reason(scope, spec, duration).alias(REASON_COLUMN)
    return df.select("*", *derived, *flags, reason)


def valid_rows(classified: DataFrame) -> DataFrame:
    """Rows without a discard reason, reason column dropped."""
    return classified.filter(F.col(REASON_COLUMN).isNull()).drop(REASON_COLUMN)


def discarded_rows(classified: DataFrame) -> DataFrame:
    """Rows with a discard reason (the quarantine)."""
    return classified.filter(F.col(REASON_COLUMN).isNotNull())


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, discarded) over one classified plan."""
    return valid_rows(classified), discarded_rows(classified)


def stamp_processed(df: DataFrame) -> DataFrame:
    """Add ``_processed_at``: one timestamp per query, fixed at planning."""
    return df.withColumn("_processed_at", F.current_timestamp())
