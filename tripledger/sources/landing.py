"""Landing-zone reads: month files with drifting schemas, the file listing,
file fingerprints and the ingestion manifest.

Month files are read one schema group at a time and cast *above* the scan:
the Parquet reader cannot read an int64 file as int, nor merge int and long
schemas, but a ``cast`` in the projection handles both.  The file listing and
fingerprints use the listing of the ``binaryFile`` source, so they are distributed
Spark jobs (one task per file group), not driver-side directory walks.
"""

from __future__ import annotations

import hashlib
import logging
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripledger.config import CANONICAL_TYPES, REQUIRED_COLUMNS
from tripledger.sources.schema import fit_or_refuse

log = logging.getLogger(__name__)

PERIOD_RE = r"(\d{4}-\d{2})\.parquet$"

WHOLE_FILE = 128 << 20  # bytes of a file that a task may hold to hash it
HASH_BLOCK = 4 << 20  # bytes that a task reads of a file at a time

MANIFEST_SCHEMA = (
    "period string, status string, bytes long, sha256 string, source_url string, "
    "landing_path string, duration_seconds double, ingested_at string"
)


@dataclass
class LandingRead:
    """A canonical DataFrame plus what fitting its files' footers left over."""

    df: DataFrame
    period: str
    missing_optional: list[str] = field(default_factory=list)
    unexpected: list[str] = field(default_factory=list)


_IN_FOLDER = re.compile(r"/ref_year=[0-9]{4}/ref_month=[0-9]{2}/[^/]+$")


@dataclass(frozen=True)
class LandedFile:
    """One landed Parquet file: its period and its footer's schema."""

    period: str
    path: str
    schema: StructType

    @property
    def names_its_period(self) -> bool:
        """Whether ``period_from_path`` reads the period off the path."""
        year, month = self.period.split("-")
        return self.path.endswith(f"{self.period}.parquet") or \
            f"ref_year={year}/ref_month={month}/" in self.path

    @property
    def in_period_folder(self) -> bool:
        """Whether ``period_from_folder`` tells what ``period_from_path`` does: the
        file lies right in the path's only ``ref_year=/ref_month=`` folder."""
        return (_IN_FOLDER.search(self.path) is not None
                and re.search(PERIOD_RE, self.path) is None
                and self.path.count("ref_year=") == self.path.count("ref_month=") == 1)


# Stores whose files tasks open by ``pyarrow.fs`` to read a footer.
TASK_STORES = ("file", "hdfs", "s3", "gs")
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"  # fixed key of a footer


def _roots(spark: SparkSession, paths: dict[str, str]) -> dict[str, str]:
    """Period by qualified path; no path may lie in another's folder."""
    roots = {}
    for period, path in paths.items():
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        own = str(store.makeQualified(hadoop).toString()).rstrip("/")
        if own in roots:
            raise ValueError(f"the periods {roots[own]} and {period} have one path: {path}")
        roots[own] = period
    for own in roots:
        if _owner(own.rpartition("/")[0], roots) is not None:
            raise ValueError(f"{own} lies in the folder of another period")
    return roots


def _owner(path: str, roots: dict[str, str]) -> str | None:
    """The period whose path is ``path`` or a folder above it."""
    while path and path not in roots:
        path = path.rpartition("/")[0]
    return roots.get(path)


def _footer_schema(spark: SparkSession, path: str) -> StructType:
    """Spark's schema of one Parquet file (reads its footer)."""
    return spark.read.parquet(path).schema


def landed_files(spark: SparkSession, paths: dict[str, str]) -> list[LandedFile]:
    """Every Parquet file under each period's path, with its own footer schema.

    Metadata only, never rows: one listing of all paths and one job whose tasks
    open the footers and give a digest of each one's schema.  The driver gets
    the file names, which a scan needs there, and reads one footer per distinct
    digest.  Stores that tasks cannot open (``TASK_STORES`` are those they can)
    have their footers read one by one.  A period without any file is an error."""
    roots = _roots(spark, paths)
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .option("pathGlobFilter", "*.parquet").load(list(paths.values()))
               .select("path", F.col("_metadata.file_path").alias("uri")))
    key = _SPARK_SCHEMA

    def digests(batches):
        for batch in batches:
            found = []
            for uri in batch.column("uri").to_pylist():
                store, own = pafs.FileSystem.from_uri(uri)
                with store.open_input_file(own) as file:
                    footer = pq.read_metadata(file)
                # The first line names the Python object, the others the fields.
                fields = str(footer.schema).partition("\n")[2].encode()
                told = (footer.metadata or {}).get(key, b"")
                found.append(hashlib.sha256(fields + b"\0" + told).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(found, pa.string())], names=["path", "footer"])

    if all(own.partition(":")[0] in TASK_STORES for own in roots):
        listed = listing.mapInArrow(digests, "path string, footer string").collect()
    else:
        listed = [(r["path"], r["path"]) for r in listing.select("path").collect()]
    files = sorted((_owner(path, roots), path, footer) for path, footer in listed)
    empty = sorted(set(paths) - {period for period, _, _ in files})
    if empty:
        raise FileNotFoundError(f"no Parquet file for the periods {empty}")
    one_of = {footer: path for _, path, footer in reversed(files)}
    with ThreadPoolExecutor(max_workers=16) as pool:
        schemas = dict(zip(one_of, pool.map(lambda f: _footer_schema(spark, f), one_of.values())))
    return [LandedFile(period, path, schemas[footer]) for period, path, footer in files]


def _named(periods: list[str]) -> str:
    return ", ".join(periods) if len(periods) < 4 else \
        f"{periods[0]} to {periods[-1]}, {len(periods)} periods"


def _read_files(spark: SparkSession, files: list[LandedFile], types: dict[str, str],
                required: tuple[str, ...]) -> LandingRead:
    """The files in the canonical schema with lineage: one scan per footer schema.

    Every footer is fitted before any scan is planned, so one unreadable file
    refuses the load whatever the order of the files.  Files whose path does
    not carry their period get a scan per period, and those right in a period's
    folder one that cuts it out of the path without searching every row's."""
    if not files:
        raise ValueError("no periods given")
    alike: dict[tuple[str, str | None, bool], list[LandedFile]] = {}
    for f in files:
        named = f.names_its_period
        alike.setdefault((f.schema.json(), None if named else f.period,
                          named and f.in_period_folder), []).append(f)
    fits = {k: fit_or_refuse(members[0].schema, f"[{members[0].period}] {members[0].path}",
                             types, required)
            for k, members in alike.items()}
    scans = []
    for k, members in alike.items():
        period = F.lit(k[1]) if k[1] is not None else \
            period_from_folder() if k[2] else period_from_path()
        # Year and month are cut out of the period above it, so that a row's path
        # is looked at once.
        scans.append(
            spark.read.schema(members[0].schema).parquet(*[f.path for f in members]).select(
                *fits[k].columns(),
                F.col("_metadata.file_path").alias("_source_file"),
                F.current_timestamp().alias("_ingested_at"),
                period.alias("_ref_period"),
            ).select(
                "*",
                F.substring("_ref_period", 1, 4).cast("int").alias("_ref_year"),
                F.substring("_ref_period", 6, 2).cast("int").alias("_ref_month"),
            ))
    read = LandingRead(
        reduce(DataFrame.unionByName, scans), _named(sorted({f.period for f in files})),
        sorted({c for x in fits.values() for c in x.missing}),
        sorted({c for x in fits.values() for c in x.unexpected}))
    for what, columns in (("filled with NULL", read.missing_optional),
                          ("not read", read.unexpected)):
        if columns:
            log.warning("[%s] columns %s: %s", read.period, what, ", ".join(columns))
    return read


def read_landing(spark: SparkSession, path: str, period: str,
                 types: dict[str, str] = CANONICAL_TYPES,
                 required: tuple[str, ...] = REQUIRED_COLUMNS) -> LandingRead:
    """One period's file(s) in the canonical schema with lineage.

    The schema is decided per file: a file lacking a required column refuses
    the period (``SchemaMismatch``, a ``ValueError``), a missing optional
    column becomes a typed NULL in that file's rows, unknown columns are not
    read; the last two are returned and logged."""
    return _read_files(spark, landed_files(spark, {period: path}), types, required)


def read_landing_grouped(spark: SparkSession, paths: dict[str, str],
                         types: dict[str, str] = CANONICAL_TYPES,
                         required: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """Several periods at once; drifting types never meet inside a reader.

    Files of one footer schema share a scan (one set of tasks), whatever their
    period; the scans are unioned by name."""
    return _read_files(spark, landed_files(spark, paths), types, required).df


def landing_listing(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Every landed file with its size in MiB (1 dp) and modification time.

    Only path, length and time are selected, so no file content is read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("arquivo"),
        F.col("path").alias("caminho"),
        F.col("length").alias("bytes"),
        F.round(F.col("length") / F.lit(1048576.0), 1).alias("tamanho_mib"),
        F.col("modificationTime").alias("modificado_em"),
        F.nullif(F.regexp_extract("path", PERIOD_RE, 1), F.lit("")).alias("period"),
    )


def landing_fingerprint(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """L1: SHA-256 and byte size of every landed file.

    Tasks read their files block by block (``_hashed_in_blocks``), so that no
    task holds more than ``HASH_BLOCK`` bytes of a file of any size.  In stores
    that tasks cannot open (``TASK_STORES`` are those they can), files of up to
    ``WHOLE_FILE`` bytes are one row of the ``binaryFile`` source each; longer
    ones are read in pieces, which the sort of a task puts in order and spills."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    if all(own.partition(":")[0] in TASK_STORES for own in _roots(spark, {"": root})):
        hashed = _hashed_in_blocks(files.select(
            "path", "length", F.col("_metadata.file_path").alias("uri")))
    else:
        hashed = _hashed_by_rows(spark, files, root, glob)
    return hashed.select(
        F.col("path").alias("landing_path"),
        F.nullif(F.regexp_extract("path", PERIOD_RE, 1), F.lit("")).alias("period"),
        F.col("length").alias("bytes"),
        "sha256",
    )


def _hashed_in_blocks(files: DataFrame) -> DataFrame:
    """(path, length, sha256) of files that tasks open themselves.

    The bytes hashed are counted against the listed size."""
    size = HASH_BLOCK

    def run(batches):
        for batch in batches:
            found = []
            for uri, length in zip(batch.column("uri").to_pylist(),
                                   batch.column("length").to_pylist()):
                store, own = pafs.FileSystem.from_uri(uri)
                digest, read = hashlib.sha256(), 0
                with store.open_input_file(own) as file:
                    while block := file.read(size):
                        digest.update(block)
                        read += len(block)
                if read != length:
                    raise ValueError(f"{uri}: {read} bytes read of {length}")
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("length"), pa.array(found, pa.string())],
                names=["path", "length", "sha256"])

    return files.mapInArrow(run, "path string, length long, sha256 string")


def _hashed_by_rows(spark: SparkSession, files: DataFrame, root: str, glob: str) -> DataFrame:
    """(path, length, sha256) of files that only Spark's readers can open."""
    limit = min(WHOLE_FILE, int(spark.conf.get("spark.sql.sources.binaryFile.maxLength")))
    hashed = files.where(F.col("length") <= F.lit(limit).cast("long")).select(
        "path", "length", F.sha2(F.col("content"), 256).alias("sha256"))
    large = files.where(F.col("length") > F.lit(limit).cast("long")).select(
        "path", "length", F.col("_metadata.file_path").alias("file"))
    if not large.isEmpty():
        hashed = hashed.union(large.join(_hashed_in_pieces(spark, root, glob, limit), "file", "left")
                              .select("path", "length", "sha256"))
    return hashed


def _hashed_in_pieces(spark: SparkSession, root: str, glob: str, limit: int) -> DataFrame:
    """(file, sha256) of the files of more than ``limit`` bytes.

    The bytes between two line feeds are a row; splits are read by many tasks,
    a file's rows meet in order of place (the sort spills) and are hashed one
    after the other.  The bytes hashed are counted against the file's size."""
    pieces = (
        spark.read.option("lineSep", "\n")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .text(root)
        .where(F.col("_metadata.file_size") > F.lit(limit).cast("long"))
        .select(F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_size").alias("size"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("at"),
                F.col("value").cast("binary").alias("piece"))
    )

    def run(batches):
        file, size, read, digest = None, 0, 0, None

        def ended():
            if read + 1 == size:  # a line feed ends the file
                digest.update(b"\n")
            elif read != size:
                raise ValueError(f"{file}: {read} bytes read of {size}")
            return pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([digest.hexdigest()])], names=["file", "sha256"])

        for batch in batches:
            for name, length, piece in zip(*(batch.column(i) for i in range(3))):
                if name.as_py() != file:
                    if digest is not None:
                        yield ended()
                    file, size, read, digest = name.as_py(), length.as_py(), 0, hashlib.sha256()
                else:
                    digest.update(b"\n")
                    read += 1
                piece = piece.as_buffer()
                digest.update(piece)
                read += piece.size
        if digest is not None:
            yield ended()

    return pieces.repartition("file").sortWithinPartitions("file", "block", "at").select(
        "file", "size", "piece").mapInArrow(run, "file string, sha256 string")


def schema_probe(spark: SparkSession, path: str) -> DataFrame:
    """Column name, type and nullability of one Parquet file (or folder),
    read from its footer; one row per column."""
    schema = spark.read.parquet(path).schema
    rows = [(path, i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(
        rows, "arquivo string, posicao int, coluna string, tipo string, anulavel boolean")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Ingestion manifest (JSON lines) read with its fixed schema."""
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


def period_from_path() -> "F.Column":
    """``yyyy-MM`` of the file a row came from: from a ``ref_year=/ref_month=``
    folder, else from a ``..._yyyy-MM.parquet`` file name."""
    path = F.col("_metadata.file_path")
    from_dirs = F.concat(F.regexp_extract(path, r"ref_year=(\d{4})", 1), F.lit("-"),
                         F.regexp_extract(path, r"ref_month=(\d{2})", 1))
    from_name = F.regexp_extract(path, r"(\d{4}-\d{2})\.parquet$", 1)
    return F.when(from_name != "", from_name).otherwise(from_dirs)


def period_from_folder() -> "F.Column":
    """The same for a file right in its ``ref_year=/ref_month=`` folder
    (``LandedFile.in_period_folder``), by place instead of by search."""
    tail = F.substring_index(F.col("_metadata.file_path"), "/", -3)
    start = len("ref_year=") + 1
    return F.concat(F.substring(tail, start, 4), F.lit("-"),
                    F.substring(tail, start + len("yyyy/ref_month="), 2))
