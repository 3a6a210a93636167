"""Landing decisions as table work: which landed files to (re)load, the
manifest records of a load, and the run summary.

The original downloader decided per period on the driver; here the same
decision is a join of the file listing (with fingerprints) against the latest
manifest record per period, so it runs as one Spark job however many files
there are.  A file is skipped only if a previous load recorded the same size
*and* the same SHA-256; a size-preserving republication is therefore caught.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUS_LOAD = "load"
STATUS_SKIP = "skip"
UNKNOWN_SIZE = "size_unknown"  # a recorded file is kept, not fetched again


def latest_manifest(manifest: DataFrame, key: str = "period") -> DataFrame:
    """Latest manifest record per key (by ``ingested_at``), downloads only."""
    rec = F.struct("ingested_at", "bytes", "sha256")
    return (
        manifest.filter(F.col("status").isin("downloaded", "loaded"))
        .groupBy(key)
        .agg(F.max_by(rec, F.col("ingested_at")).alias("_last"))
        .select(key,
                F.col("_last.bytes").alias("manifest_bytes"),
                F.col("_last.sha256").alias("manifest_sha256"),
                F.col("_last.ingested_at").alias("manifest_ingested_at"))
    )


def ingest_decision(fingerprints: DataFrame, manifest: DataFrame, key: str = "period",
                    force: bool = False) -> DataFrame:
    """L2: one row per landed file with ``status`` load/skip and why.

    ``fingerprints`` has (key, landing_path, bytes, sha256); ``manifest`` the
    manifest schema.  Both sides have one row per file/period, so the join is
    small next to the data it gates; Spark broadcasts only under its size
    threshold."""
    last = latest_manifest(manifest, key)
    j = fingerprints.join(last, key, "left")
    reason = (
        F.when(F.lit(force), F.lit("forced"))
        .when(F.col("manifest_bytes").isNull(), F.lit("new"))
        .when(F.col("manifest_bytes") != F.col("bytes"), F.lit("size_changed"))
        .when(F.col("bytes").isNull(), F.lit(UNKNOWN_SIZE))
        .when(~F.col("manifest_sha256").eqNullSafe(F.col("sha256")), F.lit("content_changed"))
    )
    return j.select(
        key, "landing_path", "bytes", "sha256", "manifest_bytes", "manifest_sha256",
        F.when(reason.isNull() | (reason == UNKNOWN_SIZE), F.lit(STATUS_SKIP))
        .otherwise(F.lit(STATUS_LOAD)).alias("status"),
        F.coalesce(reason, F.lit("unchanged")).alias("reason"),
    )


def manifest_records(decisions: DataFrame, key: str = "period",
                     source_url: str | None = None) -> DataFrame:
    """L3: manifest rows for the files a run loads (skips are not logged)."""
    return decisions.filter(F.col("status") == STATUS_LOAD).select(
        F.col(key).alias("period"),
        F.lit("downloaded").alias("status"),
        F.col("bytes").cast("long").alias("bytes"),
        "sha256",
        F.lit(source_url).cast("string").alias("source_url"),
        "landing_path",
        F.lit(None).cast("double").alias("duration_seconds"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ingested_at"),
    )


def ingest_summary(decisions: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Files per status (and any ``by`` columns) and their MiB (1 dp)."""
    return decisions.groupBy(*by, "status").agg(
        F.count(F.lit(1)).alias("arquivos"),
        F.round(F.sum("bytes") / F.lit(1048576.0), 1).alias("total_mib"),
    ).orderBy(*by, "status")
