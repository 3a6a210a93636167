"""Suffix-array dedup of byte strings.

Removes every byte covered by a string of ``length`` bytes that also starts
earlier (in a smaller document, or further left in the same one).

The suffixes that take part are sampled by content: of the short strings
("leads", ``LEAD`` bytes) inside each window of ``length`` bytes the one of
smallest hash is the window's anchor.  Equal windows have their anchors at the
same offset, so it is enough to compare windows of equal anchors.

1. ``_sample``: per document, its anchors' lead hashes; one shuffle finds
   leads that occur in several documents (``repeats``), a scan those that occur
   twice in one.
2. ``_records``: documents with repeated leads give one record per anchor: the
   bytes that its run of windows covers.  Among the records a task holds at
   once (``HELD``), equal ones collapse onto the earliest and the others are
   settled there and then, so a passage that a third of all documents share
   costs one record for each such portion.
3. Spark range-partitions the records by their leads with sampled splitters.
   Equal leads always fall into one range, so no match crosses a boundary:
   suffixes to either side differ within their leading bytes.
   A lead with more windows than a task sorts at once is taken out before:
   ``_hot_spans`` deals its windows by their whole bytes instead, so that no
   task holds all the contexts of one lead.
4. ``_sort_bucket``: inside a bucket equal records collapse onto the earliest,
   and the windows of the others are sorted by multikey quicksort: by lead and
   offset first, then four bytes at a time, going on only with windows whose
   bytes were equal so far.  Windows equal to the end form a class; all but its
   earliest start are repeats.
5. Spans of repeats are cut out of the documents.

All comparisons are of the bytes themselves; hashes only choose anchors and
drop what cannot repeat.  A bucket is worked through lead by lead, and no lead
in it has more than ``WINDOWS`` windows, so memory does not follow the data.

Defined results: NULL or empty text has no bytes: 0, 0, 0 and the digest of the
empty string; NULL doc_id counts as smaller than every other; different texts
under one doc_id are ordered by a hash of the text; repeated rows of one doc_id
and text are one document and get equal results; an empty table gives no rows;
other input columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.llm import frames
from tripledger.llm import textbytes as tb
from tripledger.llm.frames import release, stage
from tripledger.llm.repeats import long_lists, repeated_keys, split_keys

LENGTH = 100
LEAD = 48
WINDOWS = 400_000  # windows that a task sorts at once
HELD = 8 << 20  # bytes of records that a task holds to collapse equal ones

RECORD_SCHEMA = "did long, rid long, start long, n int, back int, text binary, lead long"


class _Anchors:
    """Runs of windows of equal anchor in a chunk of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, lead: int):
        empty = np.zeros(0, np.int64)
        if len(data) < length:
            self.anchor, self.first, self.n, self.row = empty, empty, empty, empty
            self.key = np.zeros(0, np.uint64)
            return
        running = tb.prefix_hash(data)
        _, inverse = tb.powers(len(data))
        n = len(data) - lead + 1
        key = tb.mix((running[lead:] - running[:n]) * inverse[:n])
        anchor = tb.minimizers(key, length - lead + 1)
        sizes = np.diff(offsets)
        room = np.repeat(offsets[1:], sizes)[:len(anchor)] - np.arange(len(anchor)) >= length
        good = np.flatnonzero(room)
        anchor = anchor[good]
        row = np.repeat(np.arange(len(sizes)), sizes)[good]
        new = np.ones(len(good), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (good[1:] != good[:-1] + 1)
        at = np.flatnonzero(new)
        self.first = good[at]  # first window of the run
        self.n = np.diff(np.append(at, len(good)))
        self.anchor = anchor[at]
        self.row = row[at]
        self.key = key[self.anchor]

    def by_row(self, rows: int) -> np.ndarray:
        return np.searchsorted(self.row, np.arange(rows + 1))


def _twice(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[place] > 1


def _sample(docs: DataFrame, length: int, lead: int) -> DataFrame:
    """Per row: bytes, digest of the whole text, anchors' leads, own repeats."""
    def run(batches):
        for batch in batches:
            sizes, digests, keys, own = [], [], [], []
            for _, _, data, offsets in tb.chunks(batch.column(2)):
                a = _Anchors(data, offsets, length, lead)
                cut = a.by_row(len(offsets) - 1)
                raw = data.tobytes()
                for i in range(len(offsets) - 1):
                    sizes.append(int(offsets[i + 1] - offsets[i]))
                    digests.append(hashlib.sha256(raw[offsets[i]:offsets[i + 1]]).hexdigest())
                    mine = a.key[cut[i]:cut[i + 1]]
                    distinct = np.unique(mine)
                    keys.append(distinct)
                    own.append(len(distinct) < len(mine))
            test, known = split_keys(keys)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(own, pa.bool_()),
                 long_lists(test), long_lists(known)],
                names=["did", "rid", "n_bytes", "whole_sha256", "own", "test", "known"])

    return docs.mapInArrow(run, "did long, rid long, n_bytes long, whole_sha256 string, "
                                "own boolean, test array<long>, known array<long>")


def _records(joined: DataFrame, length: int, lead: int) -> DataFrame:
    """One record per anchor whose lead repeats.

    ``text`` holds the ``n`` windows that start at byte ``start`` of the
    document; the lead is at ``back`` in it and ``lead`` is its hash.  A record
    without ``text`` and ``lead`` is settled: an equal one starts earlier in the
    same portion.
    """
    def settle(dids, rids, found):
        """One Arrow batch of the records found, equal ones collapsed."""
        row, start, n, back = (np.concatenate(x) for x in list(zip(*found))[:4])
        texts = [t for f in found for t in f[4]]
        leads = np.concatenate([f[5] for f in found]).view(np.int64)
        did, rid = dids[row], rids[row]
        earliest: dict[tuple, tuple] = {}
        settled = np.zeros(len(texts), bool)
        for k in np.lexsort((start, rid, did)).tolist():
            me = (did[k], rid[k], start[k])
            before = earliest.setdefault((texts[k], back[k]), me)
            settled[k] = before != me
        shown = [None if s else t for s, t in zip(settled.tolist(), texts)]
        return pa.RecordBatch.from_arrays(
            [pa.array(did), pa.array(rid), pa.array(start, pa.int64()),
             pa.array(n.astype(np.int32)), pa.array(back.astype(np.int32)),
             pa.array(shown, pa.binary()), pa.array(leads, pa.int64(), mask=settled)],
            names=["did", "rid", "start", "n", "back", "text", "lead"])

    def run(batches):
        for batch in batches:
            dids, rids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            lists, found, held = batch.column(3), [], 0
            for i, j, data, offsets in tb.chunks(batch.column(2)):
                a = _Anchors(data, offsets, length, lead)
                cut = a.by_row(j - i)
                hit = np.zeros(len(a.key), bool)
                for r in range(j - i):
                    part = slice(cut[r], cut[r + 1])
                    keys = np.asarray(lists[i + r].as_py() or [], np.int64).view(np.uint64)
                    hit[part] = np.isin(a.key[part], keys) | _twice(a.key[part])
                spot = np.flatnonzero(hit)
                if not len(spot):
                    continue
                first, n, row, raw = a.first[spot], a.n[spot], a.row[spot], data.tobytes()
                texts = [raw[s:e] for s, e in zip(
                    first.tolist(), (first + n - 1 + length).tolist())]
                found.append((row + i, first - offsets[row], n, a.anchor[spot] - first, texts,
                              a.key[spot]))
                held += int((n + length).sum())
                if held > HELD:
                    yield settle(dids, rids, found)
                    found, held = [], 0
            if found:
                yield settle(dids, rids, found)

    return joined.mapInArrow(run, RECORD_SCHEMA)


def multikey_sort(buffer: np.ndarray, starts: np.ndarray, offset: np.ndarray,
                  classes: np.ndarray, length: int, lead: int) -> np.ndarray:
    """Classes of equal windows of ``length`` bytes, from classes of equal lead.

    Windows of one given class have equal leads at equal ``offset``, so only the
    bytes before and after the lead are read, four at a time as one character.
    Each round sorts what is still tied by (class so far, next character) and
    splits the classes; a window alone in its class is done.
    """
    padded = np.concatenate([buffer, np.zeros(4, np.uint8)]).astype(np.uint64)
    n = len(buffer)
    char = ((padded[:n] << np.uint64(24)) | (padded[1:n + 1] << np.uint64(16))
            | (padded[2:n + 2] << np.uint64(8)) | padded[3:n + 3])
    out = np.empty(len(starts), np.int64)
    live, done = np.arange(len(starts)), 0
    rounds_before = -(-offset // 4)  # characters before the lead, the last one reaching into it
    for k in range(-(-(length - lead) // 4) + 1):
        alone = np.bincount(classes)[classes] == 1
        single = live[alone]
        out[single] = done + np.arange(len(single))
        done += len(single)
        live, classes = live[~alone], classes[~alone]
        if not len(live):
            return out
        mine, before = offset[live], rounds_before[live]
        at = np.where(k < before, 4 * k, mine + lead + 4 * (k - before))
        missing = np.clip(at + 4 - length, 0, 4)  # bytes past the window's end
        spot = np.minimum(starts[live] + at, n - 1)
        letter = (char[spot] >> (8 * missing).astype(np.uint64)) * (missing < 4)
        key = (classes.astype(np.uint64) << np.uint64(32)) | letter
        order = np.argsort(key)
        ordered = key[order]
        new = np.ones(len(order), np.int64)
        new[1:] = ordered[1:] != ordered[:-1]
        live, classes = live[order], np.cumsum(new) - 1
    out[live] = done + classes
    return out


def _sort_groups(records: list[tuple], length: int, lead: int):
    """Repeated windows of whole lead groups: (record, first window, windows) runs.

    The records are distinct and in order of place: did, rid, start.
    """
    texts = [r[5] for r in records]
    sizes = np.array([len(t) for t in texts])
    base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    n = np.array([r[3] for r in records])
    back = np.array([r[4] for r in records])
    record = np.repeat(np.arange(len(records)), n)
    window = np.arange(len(record)) - np.repeat(np.cumsum(n) - n, n)
    # Equal leads are grouped by their bytes, windows by the lead's offset.
    numbers: dict[bytes, int] = {}
    group = np.array([numbers.setdefault(t[b:b + lead], len(numbers))
                      for t, b in zip(texts, back.tolist())])[record]
    offset = back[record] - window
    classes = multikey_sort(buffer, base[record] + window, offset,
                            group * (length - lead + 1) + offset, length, lead)
    # Equal windows have equal offsets, so a record has one window of a class
    # at most, and the first record of a class holds its earliest start.
    order = np.argsort((classes.astype(np.uint64) << np.uint64(32)) | record.astype(np.uint64))
    ordered = classes[order]
    repeat = np.zeros(len(order), bool)
    repeat[order[1:]] = ordered[1:] == ordered[:-1]
    # Runs of repeated windows of one record.
    edge = np.ones(len(record) + 1, bool)
    edge[1:-1] = (repeat[1:] != repeat[:-1]) | (record[1:] != record[:-1])
    cut = np.flatnonzero(edge)
    on = repeat[cut[:-1]]
    yield from zip(record[cut[:-1][on]].tolist(), window[cut[:-1][on]].tolist(),
                   np.diff(cut)[on].tolist())


def _lead_bytes(record: tuple, lead: int) -> bytes:
    return record[5][record[4]:record[4] + lead]


def _apart(records: list[tuple], lead: int) -> tuple[list[tuple], list[tuple]]:
    """(records to sort, copies) of records in order of place.

    All windows of a copy, a record with the bytes and the lead's offset of an
    earlier one, start earlier too.  Windows of one record have the lead at
    different offsets, so a record alone with its lead has nothing to compare."""
    first: dict[tuple, tuple] = {}
    copies = [r for r in records if first.setdefault((r[5], r[4]), r) is not r]
    leads = [_lead_bytes(r, lead) for r in first.values()]
    count = Counter(leads)
    return [r for r, own in zip(first.values(), leads) if count[own] > 1], copies


def _hot_leads(records: DataFrame) -> DataFrame:
    """Leads (their hashes) with more windows than a task sorts at once."""
    return records.where("lead IS NOT NULL").groupBy("lead").agg(
        F.sum("n").alias("windows")).where(F.col("windows") > WINDOWS).select("lead")


def _hot_spans(records: DataFrame, length: int, lead: int) -> DataFrame:
    """Spans (did, rid, start, stop) of repeats among records of hot leads.

    The windows that one task holds at once are sorted and all but the earliest
    of a class settled; the others are dealt by their bytes.  A class that is
    still large is only compared with its first row and spills.
    """
    def run(batches):
        held, windows = [], 0

        def opened():
            rows = sorted(set(held))
            out = []
            settled = [np.zeros(r[3], bool) for r in rows]
            for k, w, m in _sort_groups(rows, length, lead):
                settled[k][w:w + m] = True
                out.append((*rows[k][:2], rows[k][2] + w, rows[k][2] + w + m - 1 + length, None))
            for r, gone in zip(rows, settled):
                out += [(r[0], r[1], r[2] + w, r[2] + w + length, r[5][w:w + length])
                        for w in np.flatnonzero(~gone).tolist()]
            for i in range(0, len(out), 1 << 16):
                columns = list(zip(*out[i:i + (1 << 16)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:4]]
                    + [pa.array(columns[4], pa.binary())],
                    names=["did", "rid", "start", "stop", "window"])

        for batch in batches:
            for r in zip(*[batch.column(k).to_pylist() for k in range(6)]):
                held.append(r)
                windows += r[3]
                if windows > WINDOWS // 2:
                    yield from opened()
                    held, windows = [], 0
        if held:
            yield from opened()

    found = stage(records.select("did", "rid", "start", "n", "back", "text").mapInArrow(
        run, "did long, rid long, start long, stop long, window binary"), "hot-windows")
    # A row may be there more than once: of the first place, all have rank 1.
    place = Window.partitionBy("window").orderBy("did", "rid", "start")
    later = found.where("window IS NOT NULL").withColumn("place", F.rank().over(place)).where(
        "place > 1")
    spans = ["did", "rid", "start", "stop"]
    return found.where("window IS NULL").select(*spans).union(later.select(*spans))


def _sort_bucket(records: DataFrame, length: int, lead: int) -> DataFrame:
    """Spans (did, rid, start, stop) of repeats; the input is in order of ``lead``."""
    def run(batches):
        held, windows = [], 0

        def spans():
            # By place; a row may be there more than once.
            rows, copies = _apart(sorted(set(held)), lead)
            out = [(*r[:2], r[2], r[2] + r[3] - 1 + length) for r in copies]
            if rows:
                out += [(*rows[k][:2], rows[k][2] + w, rows[k][2] + w + m - 1 + length)
                        for k, w, m in _sort_groups(rows, length, lead)]
            columns = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["did", "rid", "start", "stop"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for r in zip(*columns):
                if windows > WINDOWS and _lead_bytes(r, lead) != _lead_bytes(held[-1], lead):
                    yield spans()
                    held, windows = [], 0
                held.append(r)
                windows += r[3]
        if held:
            yield spans()

    return records.mapInArrow(run, "did long, rid long, start long, stop long")


def _covered(size: int, spans: pa.ListScalar) -> np.ndarray:
    """Which of ``size`` bytes lie in one of the (start, stop) spans."""
    begin, end = (np.asarray(x) for x in spans.values.flatten())
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step)[:-1] > 0


def _cut_out(joined: DataFrame) -> DataFrame:
    """Kept bytes, removed bytes and spans of documents with their (start, stop) list."""
    def run(batches):
        for batch in batches:
            lists, kept, removed, spans = batch.column(3), [], [], []
            for i, j, data, offsets in tb.chunks(batch.column(2)):
                for r in range(j - i):
                    own = data[offsets[r]:offsets[r + 1]]
                    gone = _covered(len(own), lists[i + r])
                    kept.append(own[~gone].tobytes())
                    removed.append(int(gone.sum()))
                    spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(kept, pa.binary()),
                 pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
                names=["did", "rid", "kept", "n_removed", "n_spans"])

    return joined.mapInArrow(
        run, "did long, rid long, kept binary, n_removed long, n_spans long")


def repeated_spans(documents: DataFrame, length: int = LENGTH, lead: int = LEAD):
    """(rows, spans): per row n_bytes and whole_sha256; per affected row its spans."""
    docs = frames.keyed(documents)
    rows = stage(_sample(docs, length, lead), "anchors")
    found = repeated_keys(rows).join(
        rows.where("own").select("did", "rid").distinct(), ["did", "rid"], "full_outer")
    found = stage(found.select("did", "rid", "keys"), "repeated")
    # A row may be there more than once; it is one document.
    joined = docs.join(found, ["did", "rid"])
    records = stage(_records(joined, length, lead), "records")
    release(found)
    bins = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lead_bytes = F.expr(f"substring(text, back + 1, {lead})")
    open_records = records.where("text IS NOT NULL")
    settled = records.where("text IS NULL").select(
        "did", "rid", "start", (F.col("start") + F.col("n") - 1 + length).alias("stop"))
    hot = stage(_hot_leads(records), "hot-leads")
    if not hot.isEmpty():
        settled = settled.union(_hot_spans(
            open_records.join(hot, "lead", "left_semi"), length, lead))
        open_records = open_records.join(hot, "lead", "left_anti")
    buckets = open_records.drop("lead").repartitionByRange(
        bins, lead_bytes).sortWithinPartitions(lead_bytes)
    spans = _sort_bucket(buckets, length, lead).union(settled)
    spans = stage(spans.groupBy("did", "rid").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")
    release(records)
    return rows, spans


def dedup(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows, spans = repeated_spans(documents, length)
    docs = frames.keyed(documents)
    changed = stage(_cut_out(docs.join(spans, ["did", "rid"])).groupBy("did", "rid").agg(
        F.first("n_removed").alias("n_removed"), F.first("n_spans").alias("n_spans"),
        F.sha2(F.first("kept"), 256).alias("sha")), "changed")
    zero = F.lit(0).cast("long")
    return rows.select("did", "rid", "n_bytes", "whole_sha256").join(
        changed, ["did", "rid"], "left").select(
        frames.public_id().alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("sha", "whole_sha256").alias("kept_sha256"))


def cut_texts(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents as given, their texts without what starts earlier too.

    All columns stay; ``n_chars``, where there is one, follows the new text.  A
    character of which a cut leaves some bytes only goes with it.  Texts without
    repeats (NULL too) stay as they are.
    """
    _, spans = repeated_spans(documents, length)
    others = [c for c in documents.columns if c != "text"]
    rows = documents.select(*frames.key_columns(), F.col("text"), frames.whole_row(others).alias("other"))
    joined = rows.join(spans, ["did", "rid"], "left").select("text", "spans", "other")

    def run(batches):
        for batch in batches:
            texts, lists = batch.column(0), batch.column(1)
            out = texts.to_pylist()
            for r in np.flatnonzero(np.asarray(lists.is_valid())).tolist():
                gone = _covered(len(out[r].encode("utf-8")), lists[r])
                kept = np.frombuffer(out[r].encode("utf-8"), np.uint8)[~gone]
                out[r] = kept.tobytes().decode("utf-8", "ignore")
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.string()), lists.is_valid(), batch.column(2)],
                names=["text", "changed", "other"])

    schema = T.StructType([joined.schema["text"], T.StructField("changed", T.BooleanType()),
                           joined.schema["other"]])
    cut = joined.mapInArrow(run, schema)
    columns = {c: frames.of_row("other", c) for c in others} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("changed"), F.length("text").cast(
            documents.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return cut.select(*[columns[c].alias(c) for c in documents.columns])


def op10(spark, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier too, removed from ``documents``."""
    return dedup(frames.table(spark, sf_dir, "documents"), LENGTH)
