"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  A line's own score is linear in its features and in
some of its neighbours'; the chain adds a score for each pair of labels that
follow one another.  Forward and backward passes give each line's probability
of being good; a document's quality is the mean of its lines' probabilities,
weighted by line length and mapped to the label's scale by a fitted logistic
curve.

The field is fitted on a bounded sample of labelled documents (``SAMPLE``, the
first by a hash of their id), each line taking its document's label.  Line
features are computed in tasks; only those of the sample reach the driver.
Scoring is a scan without shuffle over whole texts.

Defined results: text without lines that hold a word (NULL and empty texts
too) has quality 0, the lowest score; NULL doc_id is carried through; labels
given twice count once (the smaller); without labels of both classes the score
is 0.5 everywhere; repeated rows are scored each; an empty table gives no rows;
other input columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.llm import frames
from tripledger.llm import textbytes as tb

SAMPLE = 4000  # labelled documents that the field is fitted on, at most
FOLDS = 5
THRESHOLD = 0.3
STEPS = 150

_UPPER, _DIGIT, _SYMBOL, _BANG, _POINT, _HIGH, _SPACE, _BAR = range(8)
_KINDS = np.zeros((8, 256), np.int32)
_KINDS[_UPPER, 65:91] = 1
_KINDS[_DIGIT, 48:58] = 1
_KINDS[_SYMBOL, list(b"#*$%&<>")] = 1
_KINDS[_BANG, list(b"!")] = 1
_KINDS[_POINT, list(b".,;:?")] = 1
_KINDS[_HIGH, 128:] = 1
_KINDS[_SPACE, tb.SPACE] = 1
_KINDS[_BAR, list(b"|")] = 1

OWN = 16
NEIGHBOUR = [2, 4, 5, 10, 11, 14, 15]  # features also seen of the lines before and after
WIDTH = OWN + 2 * (len(NEIGHBOUR) + 1)


def line_features(data: np.ndarray, offsets: np.ndarray):
    """(own features per line, bytes per line, first line of each row and the total).

    A line is what stands between line ends; lines without bytes are left out.
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    cut[1:][data == 0x0A] = True
    edge = np.flatnonzero(cut)
    start, stop = edge[:-1], edge[1:]
    if not len(start):
        return np.zeros((0, OWN)), np.zeros(0), np.zeros(len(offsets), np.int64)
    stop = stop - (data[stop - 1] == 0x0A)
    start, stop = start[stop > start], stop[stop > start]
    size = (stop - start).astype(np.float64)
    share = []
    for kind in _KINDS:
        running = np.concatenate(([0], np.cumsum(kind[data])))
        share.append((running[stop] - running[start]) / size)
    running = tb.prefix_hash(data)
    w_start, w_stop, _ = tb.words(data, offsets)
    word = tb.span_hash(running, w_start, w_stop)
    line = np.searchsorted(start, w_start, "right") - 1
    count = np.bincount(line, minlength=len(start)).astype(np.float64)
    tagged = np.sort((line.astype(np.uint64) << np.uint64(40)) | (word >> np.uint64(24)))
    fresh = np.ones(len(tagged), bool)
    fresh[1:] = tagged[1:] != tagged[:-1]
    distinct = np.bincount((tagged[fresh] >> np.uint64(40)).astype(np.int64), minlength=len(start))
    twin = np.zeros(len(word))
    twin[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    twins = np.bincount(line, weights=twin, minlength=len(start))
    some = np.maximum(count, 1)
    row = np.searchsorted(offsets, start, "right") - 1
    own_hash = tb.span_hash(running, start, stop) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, first_at = np.unique(own_hash, return_index=True)
    again = np.ones(len(start))
    again[first_at] = 0
    features = np.stack([
        np.ones(len(start)), np.log1p(size) / 5, share[_UPPER], share[_DIGIT], share[_SYMBOL],
        share[_BANG], share[_POINT], share[_HIGH], share[_SPACE],
        np.minimum(size / some, 30) / 10, 1 - distinct / some, twins / some,
        (count == 0).astype(float), np.log1p(count) / 5, again, share[_BAR]], axis=1)
    return features, size, np.searchsorted(row, np.arange(len(offsets)))


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own features, then those of the lines before and after in the same document."""
    n = len(own)
    part = np.concatenate([np.ones((n, 1)), own[:, NEIGHBOUR]], axis=1)
    before, after = np.zeros_like(part), np.zeros_like(part)
    before[1:], after[:-1] = part[:-1], part[1:]
    heads = first[:-1][first[:-1] < first[1:]]
    before[heads] = 0
    after[first[1:][first[:-1] < first[1:]] - 1] = 0
    return np.concatenate([own, before, after], axis=1)


def _through(x: np.ndarray, t: np.ndarray, other: bool = False) -> np.ndarray:
    """Log-odds of a line from its neighbour's, through the pair scores."""
    t = t.T if other else t
    return (np.logaddexp(x + t[1, 1], t[0, 1]) - np.logaddexp(x + t[1, 0], t[0, 0]))


def passes(unary: np.ndarray, first: np.ndarray, t: np.ndarray):
    """Forward and backward log-odds (good against bad) of every line.

    Documents go side by side, longest first, one line of each at a time.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    ahead, behind = unary.copy(), np.zeros_like(unary)
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")  # documents longer than k
    for k in range(1, longest):
        at = begin[:active[k]] + k
        ahead[at] += _through(ahead[at - 1], t)
    for k in range(longest - 1, 0, -1):
        at = begin[:active[k]] + k
        behind[at - 1] = _through(unary[at] + behind[at], t, other=True)
    return ahead, behind


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _weighted(p: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Length-weighted mean over each document's lines; 0 without lines."""
    top = np.concatenate(([0], np.cumsum(p * size)))
    low = np.concatenate(([0], np.cumsum(size)))
    weight = low[first[1:]] - low[first[:-1]]
    return np.where(weight > 0, (top[first[1:]] - top[first[:-1]]) / np.maximum(weight, 1e-9), 0.0)


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


@dataclass
class Field:
    """A fitted field and the curve from line quality to score."""

    weights: np.ndarray
    pairs: np.ndarray
    slope: float
    shift: float

    def quality(self, own, size, first) -> np.ndarray:
        unary = with_neighbours(own, first) @ self.weights
        ahead, behind = passes(unary, first, self.pairs)
        return _weighted(_sigmoid(ahead + behind), size, first)

    def score(self, own, size, first) -> np.ndarray:
        return _sigmoid(self.slope * _logit(self.quality(own, size, first)) + self.shift)


def fit(own, size, first, label, steps: int = STEPS) -> Field:
    """Maximum likelihood with a small quadratic penalty, by Adam."""
    features = with_neighbours(own, first)
    line_label = np.repeat(label, np.diff(first)).astype(float)
    n = max(1, len(features))
    theta = np.zeros(WIDTH + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    follows = np.ones(len(features), bool)
    follows[first[:-1][first[:-1] < len(features)]] = False
    at = np.flatnonzero(follows)
    seen = np.zeros((2, 2))
    np.add.at(seen, (line_label[at - 1].astype(int), line_label[at].astype(int)), 1)
    for step in range(1, steps + 1):
        weights, t = theta[:WIDTH], theta[WIDTH:].reshape(2, 2)
        unary = features @ weights
        ahead, behind = passes(unary, first, t)
        p = _sigmoid(ahead + behind)
        right = unary[at] + behind[at]
        logs = np.stack([np.full(len(at), t[0, 0]), t[0, 1] + right,
                         t[1, 0] + ahead[at - 1], t[1, 1] + ahead[at - 1] + right])
        logs -= logs.max(axis=0, initial=0)
        joint = np.exp(logs)
        expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        gradient = np.concatenate([features.T @ (line_label - p), (seen - expected).ravel()]) / n
        gradient -= 1e-3 * theta
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient ** 2
        theta = theta + 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    field = Field(theta[:WIDTH], theta[WIDTH:].reshape(2, 2), 1.0, 0.0)
    x = _logit(field.quality(own, size, first))
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic fit with a weak prior
        p = _sigmoid(slope * x + shift)
        w = p * (1 - p) + 1e-6
        g = np.array([((label - p) * x).sum() - 0.01 * (slope - 1), (label - p).sum() - 0.01 * shift])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()],
                      [(w * x).sum(), w.sum() + 0.01]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, shift = slope + move[0], shift + move[1]
    field.slope, field.shift = float(max(slope, 1e-3)), float(shift)
    return field


def _label_sample(documents: DataFrame, labels: DataFrame, column: str, keep, limit: int):
    """(text, label) of at most ``limit`` labelled documents, chosen by a hash of the id."""
    given = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & keep).groupBy(
        F.col("doc_id").alias("did")).agg(F.min(column).cast("int").alias("label"))
    chosen = given.orderBy(F.xxhash64("did"), "did").limit(limit)
    return frames.keyed(documents).join(F.broadcast(chosen), "did").dropDuplicates(
        ["did", "rid"]).select("text", "label")


def train(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Field | None:
    """A field from labels outside fold 0; None without labels of both classes."""
    sample = _label_sample(documents, labels, "quality", frames.fold("doc_id", FOLDS) != 0, limit)

    def run(batches):
        for batch in batches:
            label = np.asarray(batch.column(1))
            for i, j, data, offsets in tb.chunks(batch.column(0)):
                own, size, first = line_features(data, offsets)
                for r in range(j - i):
                    part = slice(first[r], first[r + 1])
                    yield pa.RecordBatch.from_pydict({
                        "own": [own[part].astype("<f4").tobytes()],
                        "size": [size[part].astype("<f8").tobytes()], "label": [int(label[i + r])]},
                        schema=pa.schema([("own", pa.binary()), ("size", pa.binary()),
                                          ("label", pa.int32())]))

    rows = sample.mapInArrow(run, "own binary, size binary, label int").toArrow().to_pylist()
    label = np.array([r["label"] for r in rows], float)
    if len(set(label.tolist())) < 2:
        return None
    # In an order of their own, so that the fit does not depend on partitions.
    rows.sort(key=lambda r: (r["label"], r["own"]))
    label = np.sort(label)
    own = np.concatenate([np.frombuffer(r["own"], "<f4").reshape(-1, OWN) for r in rows])
    size = [np.frombuffer(r["size"], "<f8") for r in rows]
    first = np.concatenate(([0], np.cumsum([len(s) for s in size])))
    return fit(own.astype(np.float64), np.concatenate(size), first, label)


def score(documents: DataFrame, field: Field | None, threshold: float = THRESHOLD,
          carry: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    With ``carry`` the row as given comes along as the struct ``carried``.
    """
    def run(batches):
        for batch in batches:
            out = []
            for _, _, data, offsets in tb.chunks(batch.column(1)):
                if field is None:
                    out.append(np.full(len(offsets) - 1, 0.5))
                else:
                    out.append(field.score(*line_features(data, offsets)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:],
                 pa.array(np.concatenate(out) if out else np.zeros(0))],
                names=["doc_id", *batch.schema.names[2:], "score"])

    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                             *([frames.whole_row(documents.columns).alias("carried")] if carry else []))
    schema = T.StructType([f for f in given.schema if f.name != "text"]
                          + [T.StructField("score", T.DoubleType())])
    scored = given.mapInArrow(run, schema)
    return scored.select(
        "doc_id", (frames.fold("doc_id", FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *(["carried"] if carry else []))


def op5(spark, sf_dir: str) -> DataFrame:
    """Quality scores of every document."""
    documents = frames.table(spark, sf_dir, "documents")
    return score(documents, train(documents, frames.table(spark, sf_dir, "labels")))
