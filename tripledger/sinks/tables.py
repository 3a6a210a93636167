"""Catalog tables: namespaces, all-or-nothing commits, load history, comments.

A table is a view over a Parquet table that holds its files, under the shared
work folder (``spark.checkpoint.dir``).  Every write stages its rows in a
partition folder of their own (``_load=<id>``), which no reader sees, and is
published by replacing the view: one catalog statement changes, together,
which partitions were written and which emptied, the schema and the load
history.  A failure before it changes nothing, and a write may read the table
that it replaces.

What a commit publishes is its manifest, one small JSON file that the view
names: the live load of each partition, the history, and counts per partition
(``marks``) that serve as an index for later refreshes.  The view itself lists
the live (load, partition) pairs as literals, so a filter on the partition
column prunes folders as it would on a plain table.

The driver holds one entry per live partition, load record and mark, never
rows.  One writer per table at a time is assumed.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.session import work_root

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")
LOAD = "_load"  # partition column of the staged files, hidden from readers
_MANIFEST = "tripledger.manifest"
HISTORY_SCHEMA = "table_name string, partition_value string, rows long, written_at timestamp"


def _check_ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"not a plain table name: {name!r}")
    return name


def _quote_literal(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_location(spark: SparkSession, table: str) -> str:
    """Folder of a table we create, under the shared work root."""
    db, _, name = table.rpartition(".")
    return f"{work_root(spark)}/warehouse/{db or 'default'}.db/{name}"


def ensure_namespaces(spark: SparkSession, names: tuple[str, ...]) -> None:
    """Create the databases if missing, located under the work root."""
    for db in names:
        _check_ident(db)
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {db} "
            f"LOCATION {_quote_literal(f'{work_root(spark)}/warehouse/{db}.db')}"
        )


def list_namespaces(spark: SparkSession, pattern: str = "*") -> list[str]:
    """The databases of the catalog whose name matches ``pattern``."""
    return sorted(r[0] for r in spark.sql(
        f"SHOW DATABASES LIKE {_quote_literal(pattern)}").collect())


def table_exists(spark: SparkSession, table: str) -> bool:
    """W9."""
    return spark.catalog.tableExists(table)


@dataclass
class Manifest:
    """What one commit publishes."""

    base: str  # catalog table of the files
    columns: list[str]  # as readers see them, the partition column last
    partition_col: str | None
    live: list[list] = field(default_factory=list)  # [partition value, load]
    marks: list[list] = field(default_factory=list)  # [partition value, mark, rows]
    history: list[list] = field(default_factory=list)  # [partition value, rows, time]
    comment: str | None = None

    def marks_of(self, values) -> dict[str | None, int]:
        """Rows per mark in these partitions."""
        out: dict[str | None, int] = {}
        for value, mark, rows in self.marks:
            if value in values:
                out[mark] = out.get(mark, 0) + rows
        return out

    def values_with(self, marks) -> set[str | None]:
        """Partitions that hold rows of one of these marks."""
        return {value for value, mark, rows in self.marks if mark in marks}


def manifest(spark: SparkSession, table: str) -> Manifest | None:
    """The published manifest of ``table``, None before its first commit."""
    if not table_exists(spark, _check_ident(table)):
        return None
    found = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if _MANIFEST not in found:
        raise ValueError(f"{table} exists, but was not written by commits")
    text = spark.read.text(_manifest_path(spark, found[_MANIFEST]), wholetext=True).first()[0]
    return Manifest(**json.loads(text))


def _manifest_path(spark: SparkSession, number: str) -> str:
    # Views name a manifest by number: Spark hides property values that look like
    # a secret or a URL, as a path may.
    return f"{work_root(spark)}/tripledger/manifests/{number}"


def _live_rows(state: Manifest) -> str:
    """SQL condition for the rows of the live (load, partition) pairs."""
    if state.partition_col is None:
        return " OR ".join(f"{LOAD} = {_quote_literal(load)}" for _, load in state.live) or "false"
    by_load: dict[str, list] = {}
    for value, load in state.live:
        by_load.setdefault(load, []).append(value)
    col, parts = f"`{state.partition_col}`", []
    for load, values in sorted(by_load.items()):
        named = ", ".join(_quote_literal(v) for v in sorted(v for v in values if v is not None))
        either = [f"{col} IN ({named})"] * bool(named) + [f"{col} IS NULL"] * (None in values)
        parts.append(f"({LOAD} = {_quote_literal(load)} AND ({' OR '.join(either)}))")
    return " OR ".join(parts) or "false"


def _publish(spark: SparkSession, table: str, state: Manifest) -> None:
    """Make ``state`` what readers of ``table`` see: the one step that counts."""
    number = uuid.uuid4().hex
    spark.createDataFrame([(json.dumps(asdict(state)),)], "value string").coalesce(
        1).write.text(_manifest_path(spark, number))
    columns = ", ".join(f"`{c}`" for c in state.columns)
    comment = f"COMMENT {_quote_literal(state.comment)} " if state.comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {table} {comment}"
              f"TBLPROPERTIES ('{_MANIFEST}' = {_quote_literal(number)}) "
              f"AS SELECT {columns} FROM {state.base} WHERE {_live_rows(state)}")


def _stage(spark: SparkSession, df: DataFrame, base: str, load: str,
           partition_col: str | None) -> None:
    """Write ``df`` as load ``load`` of ``base`` (created if missing); nobody reads it yet."""
    parts = [LOAD] + ([partition_col] if partition_col else [])
    rows = df.withColumn(LOAD, F.lit(load)).select(
        *[c for c in df.columns if c != partition_col], *parts)
    if table_exists(spark, base):
        rows.write.insertInto(base)
    else:
        (rows.write.format("parquet").partitionBy(*parts)
         .option("path", table_location(spark, base)).saveAsTable(base))


def _staged_counts(spark: SparkSession, base: str, load: str, partition_col: str | None,
                   marks: Column | None) -> list[list]:
    """[partition value, mark, rows] of a staged load: reads footers, and the mark's columns."""
    value = F.col(partition_col) if partition_col else F.lit(None).cast("string")
    mark = marks if marks is not None else F.lit(None)
    return [list(r) for r in spark.table(base).where(F.col(LOAD) == load).groupBy(
        value.alias("value"), mark.cast("string").alias("mark")).count().collect()]


def _drop_files(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def commit(spark: SparkSession, df: DataFrame, table: str, partition_col: str | None = None,
           replaces: list[str | None] | str = "all", marks: Column | None = None,
           comment: str | None = None) -> list[list]:
    """Stage ``df`` and publish it in one step; [partition value, mark, rows] written.

    ``replaces`` names the partitions that hold exactly the rows of ``df``
    afterwards (possibly none; a row outside them fails the job): a list of
    values, None standing for rows without a value; ``"present"`` for those
    that ``df`` has rows of; ``"all"`` for the whole table, schema included,
    whose old files go once the new ones are published.  ``marks`` is an
    expression whose rows are counted per partition, for :func:`manifest`.
    """
    _check_ident(table)
    if partition_col is not None:
        _check_ident(partition_col)
    if not [c for c in df.columns if c != partition_col]:
        raise ValueError("nothing to write besides the partition column")
    before = manifest(spark, table)
    load = uuid.uuid4().hex[:12]
    columns = [c for c in df.columns if c != partition_col] + ([partition_col] if partition_col else [])
    fresh = before is None or replaces == "all"
    base = f"{table}__{load}" if fresh else before.base
    if not fresh:
        if (sorted(before.columns), before.partition_col) != (sorted(columns), partition_col):
            raise ValueError(f"columns of {table} differ from the input: "
                             f"{sorted(set(before.columns) ^ set(columns))}")
        columns = before.columns
        df = df.select(*columns)
    if isinstance(replaces, list):
        value, named = F.col(partition_col), [v for v in replaces if v is not None]
        df = df.withColumn(partition_col, F.when(
            value.isin(*named) | (F.lit(None in replaces) & value.isNull()), value).otherwise(
            F.raise_error(F.concat(
                F.lit(f"row outside partitions {partition_col} in {replaces}: "),
                F.coalesce(value.cast("string"), F.lit("NULL"))))))
    _stage(spark, df, base, load, partition_col)
    counts = _staged_counts(spark, base, load, partition_col, marks)

    written: dict[str | None, int] = {}
    for value, _, rows in counts:
        written[value] = written.get(value, 0) + rows
    # Nothing of an emptied partition is staged: it only leaves the live list.
    gone = set(replaces) if isinstance(replaces, list) else set(written)
    old = Manifest(base, columns, partition_col) if before is None else before
    keep = (lambda value: value not in gone) if not fresh else (lambda value: False)
    now = _dt.datetime.now(_dt.timezone.utc).isoformat()
    loaded = sorted(gone | set(written), key=lambda v: (v is None, v or "")) or [None]
    state = Manifest(
        base, columns, partition_col,
        [x for x in old.live if keep(x[0])] + [[v, load] for v in written],
        [x for x in old.marks if keep(x[0])] + (counts if marks is not None else []),
        old.history + [[v, written.get(v, 0), now] for v in loaded],
        comment if comment is not None else old.comment)
    _publish(spark, table, state)
    if fresh and before is not None:  # the old snapshot was readable up to here
        spark.sql(f"DROP TABLE IF EXISTS {before.base}")
        _drop_files(spark, table_location(spark, before.base))
    return counts


def _total(counts: list[list]) -> int:
    return sum(rows for _, _, rows in counts)


def replace_partitions(spark: SparkSession, df: DataFrame, table: str, partition_col: str,
                       values: list[str | None], marks: Column | None = None,
                       comment: str | None = None) -> int:
    """W1 for a known set of partitions: afterwards, partition ``v`` of
    ``table`` holds exactly the rows of ``df`` with ``partition_col == v``,
    for every ``v`` in ``values`` (possibly none), and nothing else changed.
    None stands for the partition of the rows without a value.  One commit;
    returns the rows written."""
    return _total(commit(spark, df, table, partition_col, list(values), marks, comment))


def overwrite_partition(spark: SparkSession, df: DataFrame, table: str,
                        partition_col: str, value: str) -> int:
    """Replace one partition of ``table`` with ``df``; returns rows written.

    Creates the partitioned table on first use.  Every row must carry
    ``partition_col == value`` (a row outside it fails the write, as the
    predicate of a selective overwrite would); a failed or interrupted job
    leaves the old partition intact; an empty ``df`` empties the partition.
    """
    return replace_partitions(spark, df, table, partition_col, [value])


def overwrite_partitions(spark: SparkSession, df: DataFrame, table: str,
                         partition_col: str) -> int:
    """W1 for many partitions at once: replace exactly the partitions present
    in ``df``, leave all others; returns rows written."""
    return _total(commit(spark, df, table, partition_col, "present"))


def rebuild(spark: SparkSession, df: DataFrame, table: str, partition_by: str | None = None,
            comment: str | None = None) -> int:
    """Replace the whole table (schema included); returns rows written.

    The old table stays readable until the new one is published, and ``df``
    may read it."""
    return _total(commit(spark, df, table, partition_by, "all", comment=comment))


def vacuum(spark: SparkSession, table: str) -> int:
    """Delete the files that replaced partitions and failed loads left; returns
    how many partition folders went."""
    state = manifest(spark, table)
    live = {(load, value) for value, load in state.live}
    old = 0
    for row in spark.sql(f"SHOW PARTITIONS {state.base}").collect():
        spec = dict(x.split("=", 1) for x in row[0].split("/"))
        value = spec.get(state.partition_col)
        value = None if value == "__HIVE_DEFAULT_PARTITION__" else value
        if (spec[LOAD], value) in live:
            continue
        named = ", ".join(f"`{c}` = {_quote_literal(None if v == '__HIVE_DEFAULT_PARTITION__' else v)}"
                          for c, v in spec.items())
        spark.sql(f"ALTER TABLE {state.base} DROP IF EXISTS PARTITION ({named})")
        _drop_files(spark, f"{table_location(spark, state.base)}/{row[0]}")
        old += 1
    return old


def comment_table(spark: SparkSession, table: str, text: str) -> None:
    """The comment stays through later commits."""
    state = manifest(spark, table)
    state.comment = text
    _publish(spark, table, state)


def load_history(spark: SparkSession, table: str) -> DataFrame:
    """One record per partition and commit of ``table``, latest first."""
    rows = [(table, value, rows, _dt.datetime.fromisoformat(at))
            for value, rows, at in manifest(spark, table).history]
    return spark.createDataFrame(rows, HISTORY_SCHEMA).orderBy(
        F.desc("written_at"), "partition_value")


def describe(spark: SparkSession, table: str) -> DataFrame:
    """Column name, type and comment of a table."""
    return spark.sql(f"DESCRIBE TABLE {_check_ident(table)}")
