"""Session settings and the shared work folder.

The settings here are the ones the results depend on (session time zone,
Parquet calendar rebase) plus the execution knobs that matter at scale
(adaptive execution, skew handling, partition sizing).  ``configure`` applies
the runtime-settable ones to an existing session, so a cluster session made
elsewhere gets the same semantics without being rebuilt.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results: wall-clock NTZ values must not move with the
# session zone when formatted, and pre-1900 Parquet dates must read as written.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
}

# Execution settings of local sessions: adaptive re-planning coalesces tiny
# shuffles (the gold tables have 5 and 24 rows) and splits skewed partitions.
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that change results to ``spark`` and return it.

    Partition sizes and adaptive execution stay as the session has them: they
    are the cluster's to choose.
    """
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def _local_heap() -> str:
    """Heap for a local run: 60% of physical memory, at most 16 GiB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, int(total * 0.6 / 2**30)))}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tripledger") -> SparkSession:
    """Build (or reuse) a local session for tests and benchmarks.

    The Spark UI stays off, and a checkpoint folder is created only because a
    local run has no cluster-provided one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TRIPLEDGER_DRIVER_MEMORY",
                                                      _local_heap()))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tripledger-wh-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tripledger-ckpt-"))
    )
    for key, value in {**SEMANTIC_CONF, **EXECUTION_CONF}.items():
        builder = builder.config(key, value)
    event_log = os.environ.get("TRIPLEDGER_EVENT_LOG_DIR")
    if event_log:  # stage and task times without the UI
        builder = builder.config("spark.eventLog.enabled", "true") \
            .config("spark.eventLog.dir", event_log)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_root(spark)
    return configure(spark)


def _checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        value = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - not available on every deployment
        value = None
    return value or None


def work_root(spark: SparkSession) -> str:
    """Shared folder for tables and checkpoints written by our jobs.

    On a cluster this is the folder named by ``spark.checkpoint.dir``, which
    every executor can reach.  Only a local-mode session without that setting
    gets a fresh folder of its own (tests, benchmarks).
    """
    root = _checkpoint_dir(spark)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: a cluster run needs a shared "
                "folder for written tables and checkpoints"
            )
        root = tempfile.mkdtemp(prefix="tripledger-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused folder under the work root for one job."""
    return f"{work_root(spark)}/tripledger/{label}-{uuid.uuid4().hex[:12]}"


def unique_name(label: str) -> str:
    """A catalog-safe name that reruns and parallel calls cannot share."""
    return f"{label}_{uuid.uuid4().hex[:12]}"
