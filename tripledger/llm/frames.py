"""Shared frame helpers: input tables, row keys, stages in the shared folder."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.session import scratch_path

# Stands for a missing doc_id inside the operators: sorts before every other.
NO_ID = -(2**63)

# Spark removes the shuffle files of a finished job under this setting.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _shuffles_removed(spark: SparkSession):
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what follows reads files that every executor reaches, so
    a lost executor costs only its running tasks.  The shuffle files of the
    job that wrote the stage go when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    schema = df.schema
    with _shuffles_removed(spark):
        df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._stage_path = path  # for release()
    return out


def release(*stages: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in stages:
        path = getattr(df, "_stage_path", None)
        if path:
            spark = df.sparkSession
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def fold(col: str | Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus`` (NULL id: of empty text)."""
    text = F.coalesce(F.col(col).cast("string") if isinstance(col, str) else col, F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)).cast("int")


def key_columns() -> list[Column]:
    """``did`` and ``rid`` of a row of a documents table (see ``keyed``)."""
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return [did.alias("did"),
            F.xxhash64(did, F.coalesce(F.col("text"), F.lit(""))).alias("rid")]


def keyed(documents: DataFrame) -> DataFrame:
    """(did, rid, text) of every row of a documents table.

    ``did`` is doc_id with NULL as the smallest value, ``rid`` a hash of id and
    text that tells rows of one doc_id apart (repeated rows share it and get
    equal results), ``text`` never NULL.  No other column is carried, so extra
    columns cannot clash with the operators' own.
    """
    return documents.select(*key_columns(), F.coalesce("text", F.lit("")).alias("text"))


def whole_row(columns: list[str]) -> Column:
    """These columns as one struct, whatever their names hold."""
    quoted = ["`" + c.replace("`", "``") + "`" for c in columns]
    return F.struct(*[F.col(q).alias(c) for q, c in zip(quoted, columns)])


def of_row(struct: str, column: str) -> Column:
    """A column of a struct, whatever its name holds."""
    return F.col(struct).getField(column).alias(column)


def public_id(col: str = "did") -> Column:
    """The doc_id that ``keyed`` replaced: NULL again where it was."""
    return F.when(F.col(col) != F.lit(NO_ID), F.col(col))
