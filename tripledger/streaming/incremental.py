"""Incremental loading with Structured Streaming.

Month files keep arriving in the landing zone (new months, and republished
versions of old ones).  A file stream over the landing folder notices them;
each micro-batch then

1. replaces the bronze partition of every period that received a file,
   reading that period's folder in full (one version per period), in one
   dynamic overwrite (one scan per schema group),
2. refreshes silver and quarantine for just the trip months those periods
   touch (:func:`tripledger.plans.medallion.refresh_silver`), and
3. replaces the periods' gold states and merges just those months anew.

Only file *metadata* flows through the stream (path, size, time: the
``binaryFile`` source does not read content unless asked), and a micro-batch
holds at most ``max_files_per_trigger`` files.  Every step is a partition
overwrite, so replaying a batch after a failure gives the same tables; the
checkpoint under the shared work folder records which files were handled, so
a restarted query resumes where it stopped.
"""

from __future__ import annotations

import logging
import posixpath
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripledger.config import Scope
from tripledger.plans import medallion as MD
from tripledger.session import work_root

log = logging.getLogger(__name__)

# Fixed schema of the ``binaryFile`` source (a stream needs it up front).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"

_DIRS = re.compile(r"ref_year=(\d{4})/ref_month=(\d{2})")
_NAME = re.compile(r"(\d{4}-\d{2})\.parquet$")


def landing_files(spark: SparkSession, root: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming DataFrame of new Parquet files under ``root`` (no content)."""
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def period_folder(path: str) -> tuple[str, str] | None:
    """(period, folder to read for it) of a landed file, or None."""
    folder = posixpath.dirname(path)
    m = _DIRS.search(path)
    if m:
        return f"{m.group(1)}-{m.group(2)}", folder
    m = _NAME.search(path)
    if m:  # every dated file of the period beside it, not only the new one
        return m.group(1), f"{folder}/*{m.group(1)}.parquet"
    return None


def process_batch(spark: SparkSession, files: DataFrame, scope: Scope, focus_period: str,
                  tables: MD.Tables) -> dict[str, int]:
    """Handle one micro-batch of new landing files (see the module notes)."""
    found: dict[str, str] = {}
    for row in files.select("path").collect():  # bounded by maxFilesPerTrigger
        pf = period_folder(row.path)
        if pf is None:
            raise ValueError(f"landing file without a period: {row.path}")
        if found.setdefault(*pf) != pf[1]:
            raise ValueError(f"period {pf[0]} is landed in two places: {found[pf[0]]}, {pf[1]}")
    if not found:
        return {"periodos": 0}
    first_load = not MD.W.table_exists(spark, tables.monthly)
    # One scan per schema group and one dynamic overwrite of exactly the
    # periods seen, however many files the batch holds; any failure fails the
    # batch, which the stream retries from its checkpoint.
    MD.load_bronze_all(spark, found, tables)
    if first_load:
        counts = MD.build_silver(spark, scope, tables)
        MD.build_gold(spark, focus_period, tables)
    else:
        periods = sorted(found)
        counts = MD.refresh_silver(spark, periods, scope, tables)
        MD.refresh_gold(spark, periods, counts["meses"], scope, focus_period, tables)
    return {"periodos": len(found), **counts}


def default_checkpoint(spark: SparkSession, tables: MD.Tables) -> str:
    """The stream's checkpoint folder: one per target bronze table, under the
    shared work folder, so a restarted stream (new driver, same tables)
    resumes from the files it already handled."""
    return f"{work_root(spark)}/tripledger/checkpoints/landing-{tables.bronze}"


def start(spark: SparkSession, landing_root: str, scope: Scope, focus_period: str,
          tables: MD.Tables = MD.Tables(), checkpoint: str | None = None,
          available_now: bool = True, processing_time: str = "1 minute",
          max_files_per_trigger: int = 100) -> StreamingQuery:
    """Start the incremental load.  ``available_now`` handles what is in the
    landing zone and stops (scheduled runs); otherwise it polls every
    ``processing_time``."""
    checkpoint = checkpoint or default_checkpoint(spark, tables)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # Tables are written through the caller's session (the batch runs in a
        # clone of it), so its cached file listings are refreshed by the writes.
        out = process_batch(spark, batch, scope, focus_period, tables)
        log.info("batch %s: %s", epoch_id, out)

    writer = (
        landing_files(spark, landing_root, max_files_per_trigger)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time)
    return writer.start()
