"""Substring dedup of word windows by level-wise doubling.

Windows of a short length are tested for repetition across documents; only
where one repeats are windows of twice the length looked at, and so on up to
the target length.  Each level reads again only documents that still hold
candidates.

Level 0 does not test every short window: of the short windows inside a target
window the one of smallest hash is tested (chosen by content, so equal target
windows choose equal short ones), about 2 / (target - length + 2) of all.  A
target window can only repeat if its chosen short window does.  On the later
levels a window's length doubles from there (the last is the target) and every
candidate window is tested.

At the target length a window is two independent 64-bit hashes of its words'
bytes, 128 bits; the smallest doc_id per window decides.  Equal windows of one Arrow batch are
settled inside the task, so a passage that a third of all documents share
costs one row per batch.

Defined results: NULL or empty text has no words: 0, 0 and the digest of the
empty string; NULL doc_id counts as smaller than every other; rows that share a
doc_id do not remove from each other; repeated rows get equal results; an empty
table gives no rows; other input columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripledger.llm import frames
from tripledger.llm import textbytes as tb
from tripledger.llm.frames import release, stage
from tripledger.llm.repeats import long_lists, repeated_keys, split_keys

TARGET = 13


def levels(target: int) -> list[int]:
    """Window lengths: each twice the one before, the last the target."""
    out = [target]
    while out[0] > 8:
        out.insert(0, (out[0] + 1) // 2)
    return out


class _Windows:
    """Word windows of a chunk of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, longest: int):
        self.starts, self.ends, self.first = tb.words(data, offsets)
        self.data = data
        self.word = tb.word_hash(data, self.starts, self.ends)
        self.factor = tb._random_longs(2 * longest, "window")
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def hashes(self, length: int, other: bool = False) -> np.ndarray:
        """Hash of the window of ``length`` words from every word on."""
        n = len(self.word) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.zeros(n, np.uint64)
        word = tb.word_hash(self.data, self.starts, self.ends, 1) if other else self.word
        shift = len(self.factor) // 2 if other else 0
        for j in range(length):
            out += word[j:j + n] * self.factor[shift + j]
        return tb.mix(out)

    def inside(self, length: int) -> np.ndarray:
        """Which windows of ``length`` words lie in one row."""
        n = max(0, len(self.word) - length + 1)
        return self.row[:n] == self.row[len(self.row) - n:]

    def chosen(self, length: int, target: int):
        """(target window, its chosen short window) for all target windows of one row."""
        at = tb.minimizers(self.hashes(length), target - length + 1)
        good = np.flatnonzero(self.inside(target))
        return good, at[good]


def _removal(n_words: int, windows: np.ndarray, target: int) -> np.ndarray:
    """Words that the windows starting at the given words cover."""
    step = np.zeros(n_words + 1, np.int64)
    np.add.at(step, windows, 1)
    np.add.at(step, windows + target, -1)
    return np.cumsum(step)[:n_words] > 0


def _sample(docs: DataFrame, length: int, target: int) -> DataFrame:
    """Per row: word count, digest of all words, sampled short windows."""
    def run(batches):
        for batch in batches:
            counts, digests, keys = [], [], []
            for _, _, data, offsets in tb.chunks(batch.column(2)):
                w = _Windows(data, offsets, target)
                short = w.hashes(length)
                good, at = w.chosen(length, target)
                row = w.row[good]
                cut = np.searchsorted(row, np.arange(len(offsets)))
                raw = data.tobytes()
                for i in range(len(offsets) - 1):
                    counts.append(int(w.first[i + 1] - w.first[i]))
                    digests.append(hashlib.sha256(b" ".join(
                        raw[offsets[i]:offsets[i + 1]].split())).hexdigest())
                    keys.append(np.unique(short[at[cut[i]:cut[i + 1]]]))
            test, known = split_keys(keys)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(digests, pa.string()), long_lists(test), long_lists(known)],
                names=["did", "rid", "n_words", "whole_sha256", "test", "known"])

    return docs.mapInArrow(run, "did long, rid long, n_words long, whole_sha256 string, "
                                "test array<long>, known array<long>")


def _wanted(w: _Windows, rows_keys: list, length: int, target: int, grown: list[int]):
    """Target windows of a chunk that may repeat, given each row's repeated windows.

    ``rows_keys`` holds the repeated keys of windows of ``length``: on level 0
    of the chosen ones, later of all.  ``grown`` tells whether it is level 0.
    """
    good, at = w.chosen(grown[0], target)
    if length == grown[0]:
        own = w.hashes(length)[at]
        spots = [own]
    else:  # every window of this length inside the target window must repeat
        full = w.hashes(length)
        spots = [full[good + j] for j in (0, target - length)]
    keep = np.ones(len(good), bool)
    cut = np.searchsorted(w.row[good], np.arange(len(rows_keys) + 1))
    for i, keys in enumerate(rows_keys):
        part = slice(cut[i], cut[i + 1])
        known = np.asarray(keys, np.int64).view(np.uint64)
        for spot in spots:
            keep[part] &= np.isin(spot[part], known)
    return good[keep]


def _middle(joined: DataFrame, length: int, longer: int, target: int, grown) -> DataFrame:
    """A level between: windows of ``longer`` words where those of ``length`` repeat."""
    def run(batches):
        for batch in batches:
            lists, keys = batch.column(3), []
            for i, j, data, offsets in tb.chunks(batch.column(2)):
                w = _Windows(data, offsets, target)
                good = _wanted(w, lists[i:j].to_pylist(), length, target, grown)
                full = w.hashes(longer)
                cut = np.searchsorted(w.row[good], np.arange(j - i + 1))
                for r in range(j - i):
                    here = good[cut[r]:cut[r + 1]]
                    keys.append(np.unique(np.concatenate(
                        [full[here], full[here + target - longer]])))
            test, known = split_keys(keys)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), long_lists(test), long_lists(known)],
                names=["did", "rid", "test", "known"])

    return joined.mapInArrow(run, "did long, rid long, test array<long>, known array<long>")


def _last(joined: DataFrame, length: int, target: int, grown) -> DataFrame:
    """Candidate windows of the target length: (key, other, did, rid, known).

    Of equal windows in a batch the smallest document's goes on to be compared
    with the rest of the corpus; those of larger documents are ``known``.
    """
    def run(batches):
        for batch in batches:
            dids = np.asarray(batch.column(0))
            lists, ones, twos, rows = batch.column(3), [], [], []
            for i, j, data, offsets in tb.chunks(batch.column(2)):
                w = _Windows(data, offsets, target)
                good = _wanted(w, lists[i:j].to_pylist(), length, target, grown)
                ones.append(w.hashes(target)[good])
                twos.append(w.hashes(target, other=True)[good])
                rows.append(w.row[good] + i)
            if not ones:
                continue
            one, two, row = map(np.concatenate, (ones, twos, rows))
            did = dids[row]
            order = np.lexsort((row, did, two, one))
            one, two, row, did = one[order], two[order], row[order], did[order]
            new = np.ones(len(one), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            head = np.maximum.accumulate(np.where(new, np.arange(len(one)), 0))
            known = did > did[head]
            again = np.zeros(len(one), bool)
            again[1:] = ~new[1:] & (row[1:] == row[:-1])
            keep = ~again
            yield pa.RecordBatch.from_arrays(
                [pa.array(one[keep].view(np.int64)), pa.array(two[keep].view(np.int64)),
                 batch.column(0).take(pa.array(row[keep])),
                 batch.column(1).take(pa.array(row[keep])), pa.array(known[keep])],
                names=["key", "other", "did", "rid", "known"])

    return joined.mapInArrow(
        run, "key long, other long, did long, rid long, known boolean")


def _remove(joined: DataFrame, target: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            lists, removed, digests = batch.column(3), [], []
            for i, j, data, offsets in tb.chunks(batch.column(2)):
                w = _Windows(data, offsets, target)
                full = w.hashes(target)
                inside = w.inside(target)
                raw = data.tobytes()
                for r in range(j - i):
                    a, b = int(w.first[r]), int(w.first[r + 1])
                    keys = np.asarray(lists[i + r].as_py(), np.int64).view(np.uint64)
                    hit = np.flatnonzero(np.isin(full[a:b], keys) & inside[a:b])
                    gone = _removal(b - a, hit, target)
                    words = raw[offsets[r]:offsets[r + 1]].split()
                    kept = [words[k] for k in np.flatnonzero(~gone)]
                    removed.append(int(gone.sum()))
                    digests.append(b" ".join(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
                 pa.array(digests, pa.binary()).cast(pa.string())],
                names=["did", "rid", "n_removed", "kept_text"])

    return joined.mapInArrow(run, "did long, rid long, n_removed long, kept_text string")


def repeated_windows(documents: DataFrame, target: int = TARGET):
    """(rows, windows): per row of the table its n_words and whole_sha256, and per
    affected row the keys of target windows that a smaller doc_id has as well."""
    docs = frames.keyed(documents)
    grown = levels(target)
    samples = stage(_sample(docs, grown[0], target), "samples")
    found = stage(repeated_keys(samples), "repeated")
    # The sampled keys, many more bytes than the rest, go before the windows come.
    rows = stage(samples.select("did", "rid", "n_words", "whole_sha256"), "rows")
    release(samples)
    for length, longer in zip(grown, grown[1:-1]):
        joined = docs.dropDuplicates(["did", "rid"]).join(found, ["did", "rid"])
        tested = stage(_middle(joined, length, longer, target, grown), "level")
        release(found)
        found = stage(repeated_keys(tested), "repeated")
        release(tested)
    length = grown[-2] if len(grown) > 1 else grown[0]
    candidates = stage(_last(docs.join(found, ["did", "rid"]), length, target, grown),
                       "windows")
    release(found)
    smallest = F.min("did").over(Window.partitionBy("key", "other"))
    open_ = candidates.where("NOT known").withColumn("least", smallest).where("did > least")
    windows = stage(
        open_.select("did", "rid", "key").union(
            candidates.where("known").select("did", "rid", "key"))
        .groupBy("did", "rid").agg(F.collect_set("key").alias("keys")), "removed-windows")
    release(candidates)
    return rows, windows


def dedup(documents: DataFrame, target: int = TARGET) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    rows, windows = repeated_windows(documents, target)
    docs = frames.keyed(documents)
    changed = stage(_remove(docs.join(windows, ["did", "rid"]), target).groupBy("did", "rid").agg(
        F.first("n_removed").alias("n_removed"),
        F.sha2(F.first("kept_text").cast("binary"), 256).alias("sha")), "changed")
    return rows.join(
        changed, ["did", "rid"], "left").select(
        frames.public_id().alias("doc_id"), "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("sha", "whole_sha256").alias("kept_sha256"))


def op9(spark, sf_dir: str) -> DataFrame:
    """Windows of 13 words that a smaller doc_id has too, removed from ``documents``."""
    return dedup(frames.table(spark, sf_dir, "documents"), TARGET)
