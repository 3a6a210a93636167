"""WARC archives with a two-level capture index.

1. ``write_archive``: every page is a record, a gzip member of its own, in an
   archive file of its task.  Of records with equal payloads the one with the
   smallest page_id is a response, the others revisit it; the first of each
   payload is found on digests alone, so html is shuffled once, and a payload
   that very many pages share is dealt over salts.
2. ``build_index``: capture lines are sorted by reversed-host URL key (a range
   partitioning, which splits a hot key by page_id) and packed into compressed
   blocks of ``LINES`` lines.  Each index file ends with its directory: first
   key, offset and length of every block.
3. ``lookup``: a requested URL is dealt to the index files whose key range
   covers it; there the directory is searched by halves, only the blocks that
   may hold the key are read, by range, and searched by halves again.
4. ``fetch``: captures are dealt by archive file and read in order of offset,
   neighbouring ranges in one read; digests are verified.

Files are written and read by tasks through ``pyarrow.fs``, in the shared
folder only.  A task's rows name its files, so files that a lost or repeated
task left behind are in no index.  The driver sees one row per index file, two
keys of at most ``KEY_BYTES`` each.

Payloads count as equal if their length and SHA-256 are.  The record's payload
digest is SHA-1 in base32, as is customary; a revisit also carries the payload
length.

Defined results: NULL html is the empty payload; NULL url is the empty URL;
page_id NULL counts as larger than every other, so such a record is a response
only if all of its payload's are, and is written as ``none``; rows with equal
payload and equal smallest page_id are a response each; payloads shorter than
``least`` bytes are all responses; an empty table gives no records; other input
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm import frames
from tripledger.llm.frames import stage
from tripledger.session import scratch_path

LINES = 3000  # capture lines of an index block
ROLL = 1 << 30  # bytes after which an archive file is closed
SPAN = 64 << 20  # bytes of an archive that one task reads
READ, GAP = 8 << 20, 64 << 10  # one read at most; a gap that it reads over
KEY_BYTES = 256  # of a key that bounds an index file
SALTS = 64

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
DATE = "1970-01-01T00:00:00Z"  # of the records: the pages carry none
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_MAGIC = b"2LEVELIX"
_URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)(.*)", re.S)
_UNSAFE = re.compile(rb"[\x00-\x20\x7f-\xff]")

_CAPTURE = "key string, page_id long, url string, file string, offset long, length long"
_RECORD = ("page_id long, url string, record_type string, refers_to long, "
           "payload_bytes long, payload_digest string, payload binary")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    columns = zip(*rows) if rows else [()] * len(_names(schema))
    return pa.RecordBatch.from_arrays(
        [pa.array(v, types[c.split()[1]]) for v, c in zip(columns, schema.split(", "))],
        names=_names(schema))


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _escape(url: str) -> bytes:
    return _UNSAFE.sub(lambda m: b"%%%02X" % m.group()[0], url.encode("utf-8"))


def url_key(url: str) -> str:
    """Reversed host, then path: ``http://a.example.org/x`` is ``org,example,a)/x``."""
    found = _URL.match(url)
    host, rest = found.groups() if found else ("", url)
    return _escape(",".join(reversed(host.lower().split("."))) + ")" + rest).decode("ascii")


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    own = record_id[len("<urn:page:"):-1]
    return None if own == "none" else int(own)


def to_record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit of the page ``refers_to``."""
    block = HTTP % len(payload)
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE),
              ("WARC-Target-URI", _escape(url).decode("ascii")),
              ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
              ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        block += payload
    else:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to)),
                   ("WARC-X-Payload-Length", str(len(payload)))]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode("ascii")
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def from_record(raw: bytes):
    """(page_id, record_type, refers_to, payload_bytes, payload_digest, payload) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("ascii").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if version.encode() + b"\r\n" != VERSION or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    page_id, kind = _page_id(fields["WARC-Record-ID"]), fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "revisit":
        return (page_id, kind, _page_id(fields["WARC-Refers-To"]),
                int(fields["WARC-X-Payload-Length"]), digest, None)
    payload = rest[:size].partition(b"\r\n\r\n")[2]
    if payload_digest(payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return page_id, kind, None, len(payload), digest, payload


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def originals(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to (NULL: a response) of every row."""
    same = ["bytes", "sha"]
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumns({
            "bytes": F.octet_length("payload"), "sha": F.sha2("payload", 256),
            "salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))})
    shares = rows.where(F.col("bytes") >= least).groupBy(*same, "salt").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = shares.groupBy(*same).agg(
        F.min("first").alias("first"), F.sum("n").alias("n"),
        F.collect_list("salt").alias("salts")).where("n > 1")
    return rows.join(shared.select(*same, "first", F.explode("salts").alias("salt")),
                     [*same, "salt"], "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


class _Archive:
    """The archive files of one task, one gzip member a record."""

    def __init__(self, folder: str):
        self.folder, self.out, self.path, self.at = folder, None, None, 0

    def add(self, record: bytes) -> tuple[str, int, int]:
        """(file, offset, length) of the record."""
        if self.out is None:
            self.path, self.at = f"{self.folder}/{uuid.uuid4().hex}.warc.gz", 0
            fs, path = _store(self.path)
            self.out = fs.open_output_stream(path, compression=None)
        member = _member(record)
        self.out.write(member)
        spot = self.path, self.at, len(member)
        self.at += len(member)
        if self.at >= ROLL:
            self.close()
        return spot

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _make_folder(path: str) -> str:
    fs, own = _store(path)
    fs.create_dir(own, recursive=True)
    return path


def write_archive(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write every page; the stored captures (``_CAPTURE``) say where."""
    folder = _make_folder(scratch_path(pages.sparkSession, "warc"))

    def run(batches):
        archive = _Archive(folder)
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, first in zip(*(c for c in batch.columns)):
                    page_id, url = page_id.as_py(), url.as_py()
                    record = to_record(page_id, url, payload.as_py(), first.as_py())
                    rows.append((url_key(url), page_id, url, *archive.add(record)))
                yield _batch(rows, _CAPTURE)
        finally:
            archive.close()

    return stage(originals(pages, least).mapInArrow(run, _CAPTURE), "captures")


def build_index(captures: DataFrame, lines: int = LINES) -> DataFrame:
    """Write the index files; the stored directory of them: file, first, last, n."""
    folder = _make_folder(scratch_path(captures.sparkSession, "warc-index"))
    schema = "file string, first string, last string, n long"

    def run(batches):
        out, path, at, n = None, None, 0, 0
        directory, held, last = [], [], None

        def flush():
            nonlocal at
            block = _member("".join(line for _, line in held).encode("utf-8"))
            out.write(block)
            directory.append((held[0][0], at, len(block)))
            at += len(block)
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.cdx"
                    fs, own = _store(path)
                    out = fs.open_output_stream(own, compression=None)
                held.append((row[0], f"{row[0]} {json.dumps(row[1:])}\n"))
                n, last = n + 1, row[0]
                if len(held) >= lines:
                    flush()
        if out is not None:
            if held:
                flush()
            sparse = _member(json.dumps(directory).encode("utf-8"))
            out.write(sparse + struct.pack("<qq8s", at, len(sparse), _MAGIC))
            out.close()
            yield _batch([(path, directory[0][0][:KEY_BYTES], last[:KEY_BYTES], n)], schema)

    return stage(captures.repartitionByRange("key", "page_id").sortWithinPartitions(
        "key", "page_id").mapInArrow(run, schema), "index-files")


class _IndexFile:
    """One index file, read by ranges."""

    def __init__(self, path: str):
        fs, own = _store(path)
        self.file = fs.open_input_file(own)
        size = self.file.size()
        at, length, magic = struct.unpack("<qq8s", self.file.read_at(24, size - 24))
        if magic != _MAGIC:
            raise ValueError(f"{path} is no index file")
        self.blocks = json.loads(zlib.decompress(self.file.read_at(length, at), 31))
        self.firsts = [b[0] for b in self.blocks]
        self.block, self.lines = None, []

    def _read(self, i: int) -> list[str]:
        if self.block != i:
            _, at, length = self.blocks[i]
            self.lines = zlib.decompress(self.file.read_at(length, at), 31).decode(
                "utf-8").split("\n")[:-1]
            self.block = i
        return self.lines

    def find(self, key: str):
        """The captures of ``key``, block by block."""
        i = max(0, bisect_left(self.firsts, key) - 1)
        while i < len(self.blocks) and self.firsts[i] <= key:
            lines = self._read(i)
            own = lambda line: line[:line.index(" ")]
            yield from ((key, *json.loads(line[len(key) + 1:])) for line in
                        lines[bisect_left(lines, key, key=own):bisect_right(lines, key, key=own)])
            i += 1


def lookup(index: DataFrame, requests: DataFrame) -> DataFrame:
    """Captures of the requested URLs (column ``url``), each once."""
    files = sorted((r["first"], r["last"], r["file"]) for r in index.collect())
    firsts, lasts = [f[0] for f in files], [f[1] for f in files]

    def route(batches):
        for batch in batches:
            rows = []
            for url in batch.column(0).to_pylist():
                key = url_key(url)
                # Bounds are cut at KEY_BYTES: compare with as much of the key.
                lo = bisect_left(lasts, key[:KEY_BYTES])
                rows += [(files[i][2], key) for i in
                         range(lo, bisect_right(firsts, key[:KEY_BYTES]))]
            yield _batch(rows, "file string, key string")

    def read(batches):
        path, shard, latest = None, None, None
        for batch in batches:
            rows = []
            for own, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own != path:
                    path, shard, latest = own, _IndexFile(own), None
                if key == latest:  # another URL of the same key
                    continue
                latest = key
                for row in shard.find(key):
                    rows.append(row)
                    if len(rows) >= 4096:
                        yield _batch(rows, _CAPTURE)
                        rows = []
            yield _batch(rows, _CAPTURE)

    urls = requests.select(F.coalesce("url", F.lit("")).alias("url")).distinct()
    routed = urls.mapInArrow(route, "file string, key string")
    part = F.pmod(F.xxhash64("key"), F.lit(8))  # requests of one file may be many
    return routed.repartition("file", part).sortWithinPartitions("file", "key").mapInArrow(
        read, _CAPTURE)


def _reads(rows: list[tuple]):
    """Captures of one file in order of offset, dealt into single reads."""
    held, start, end = [], 0, 0
    for row in rows:
        file, at, length = row[:3]
        if held and (file != held[0][0] or at > end + GAP or at + length > start + READ):
            yield held, start, end
            held = []
        if not held:
            start = end = at
        held.append(row)
        end = max(end, at + length)
    if held:
        yield held, start, end


def fetch(captures: DataFrame, payloads: bool = True) -> DataFrame:
    """The records (``_RECORD``) of captures, payload only if ``payloads``."""
    def read(batches):
        path, source = None, None
        for batch in batches:
            for held, start, end in _reads(list(zip(*(c.to_pylist() for c in batch.columns)))):
                if held[0][0] != path:
                    path = held[0][0]
                    fs, own = _store(path)
                    source = fs.open_input_file(own)
                raw = source.read_at(end - start, start)
                rows = []
                for _, at, length, url in held:
                    page_id, kind, first, size, digest, payload = from_record(
                        zlib.decompress(raw[at - start:at - start + length], 31))
                    rows.append((page_id, url, kind, first, size, digest,
                                 payload if payloads else None))
                yield _batch(rows, _RECORD)

    span = F.floor(F.col("offset") / SPAN)
    return captures.select("file", "offset", "length", "url").repartition(
        "file", span).sortWithinPartitions("file", "offset").mapInArrow(read, _RECORD)


def op12(spark, sf_dir: str) -> DataFrame:
    """All ``pages`` archived, then looked up by URL and read back."""
    pages = frames.table(spark, sf_dir, "pages")
    index = build_index(write_archive(pages))
    return fetch(lookup(index, pages), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
