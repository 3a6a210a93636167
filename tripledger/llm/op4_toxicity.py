"""Toxicity scores by a counterfactually regularised classifier.

A sentence's score is linear in hashed features of its words (the word and two
of its beginnings); a document is as toxic as its worst sentence.  Training
takes whole documents' labels: every sentence of a harmless document is
harmless, and of a toxic one those that already score highest count as toxic.

Counterfactuals: every sentence of the sample is written again.  Where it names
a group of people, the term is swapped for each other term of its list, and
where it names none, a neutral mention is put in (the terms take turns).  The
change that this makes to the document's pooled score is penalised, so the
classifier cannot learn that naming a group is toxic.  What is fitted, and so
moved by the penalty, are the features that tell the classes apart and those of
the terms.

Fitted on a bounded sample (``SAMPLE`` labelled documents of each class, the
first by a hash of their id, those of over ``SAMPLE_BYTES`` left out), of which
only hashed features reach the driver.  Scoring is a scan without shuffle over
whole texts.

Defined results: text without words (NULL and empty too) has the score of no
evidence; NULL doc_id is carried through; labels given twice count once (the
smaller); without labels of both classes the score is 0.5 everywhere; repeated
rows are scored each; an empty table gives no rows; other input columns are not
read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm import frames
from tripledger.llm import textbytes as tb

SAMPLE = 2000  # labelled documents of each class, at most
SAMPLE_BYTES = 1 << 17  # of each of their texts, at most
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
STEPS = 40
RATE = 0.05
BUCKETS = 1 << 18
PENALTY = 1.0
SIGNIFICANT = 3.0

# Lists of terms that may stand for one another.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys", "trans", "gay", "lesbian", "straight"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["immigrants", "refugees", "foreigners", "natives", "black", "white", "asian", "latino"],
    ["disabled", "deaf", "blind", "elderly", "young", "old"],
    ["frauen", "männer", "mädchen", "jungen", "muslime", "christen", "juden", "ausländer"],
    ["femmes", "hommes", "filles", "garçons", "musulmans", "chrétiens", "juifs", "étrangers"],
    ["mujeres", "hombres", "chicas", "chicos", "musulmanes", "cristianos", "judíos", "extranjeros"],
]

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True
_BEGINNINGS = (4, 6)  # bytes
PER_WORD = 1 + len(_BEGINNINGS)
_SALT = [np.uint64(x) for x in (0, 0x632BE59BD9B4E019, 0xD1B54A32D192ED03)]


def _lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals as small letters."""
    low = tb.LOWER[data]
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low[capital] += 0x20
    return low


def word_features(data: np.ndarray, offsets: np.ndarray):
    """(features per word, 64-bit hash per word, first word of each sentence, of each row)."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros((0, PER_WORD), np.int32), np.zeros(0, np.uint64), none, np.zeros(
            len(offsets), np.int64)
    low = _lowered(data)
    letter = _LETTER[low]
    edge = np.ones(n + 1, bool)
    edge[1:n] = letter[1:] != letter[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    start, stop = at[:-1], at[1:]
    word = letter[start]
    start, stop = start[word], stop[word]
    running = tb.prefix_hash(low)
    full = tb.span_hash(running, start, stop)
    columns = [full]
    for size, salt in zip(_BEGINNINGS, _SALT[1:]):
        columns.append(tb.mix(tb.span_hash(running, start, np.minimum(stop, start + size)) ^ salt))
    features = np.stack([(c & np.uint64(BUCKETS - 1)).astype(np.int32) for c in columns], axis=1)
    row = np.searchsorted(offsets, start, "right") - 1
    stops = np.cumsum(_STOP[data])[start]
    new = np.ones(len(start), bool)
    new[1:] = (row[1:] != row[:-1]) | (stops[1:] != stops[:-1])
    return features, full, np.flatnonzero(new), np.searchsorted(start, offsets)


def term_features() -> tuple[list[str], list[int], np.ndarray, np.ndarray]:
    """Identity terms, the list each is of, their features and hashes."""
    terms = [(t, k) for k, group in enumerate(IDENTITY_TERMS) for t in group]
    raw = [t.encode("utf-8") for t, _ in terms]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    features, hashes, _, _ = word_features(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return [t for t, _ in terms], [k for _, k in terms], features, hashes


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Classifier:
    """Weights per feature and the score of no evidence."""

    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per row: the probability that its worst sentence is toxic."""
        features, _, sentence, first = word_features(data, offsets)
        worst = np.full(len(offsets) - 1, self.bias)
        if len(features):
            z = np.add.reduceat(self.weights[features].sum(axis=1), sentence) + self.bias
            head = np.searchsorted(sentence, first)
            some = np.flatnonzero(head[1:] > head[:-1])
            worst[some] = np.maximum.reduceat(z, head[:-1][some])
        return _sigmoid(worst)


def _telling(features, doc_of_word, label):
    """Features that toxic documents hold significantly more often, and their log odds.

    Counts documents, not occurrences; the test compares the two classes' shares
    (``SIGNIFICANT`` standard errors apart).  Only these features are fitted, so
    rare words cannot be learnt by heart.
    """
    n_docs = int(label.size)
    total, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for column in range(features.shape[1]):
        held = np.unique(features[:, column].astype(np.int64) * n_docs + doc_of_word)
        total += np.bincount(held // n_docs, minlength=BUCKETS)
        toxic += np.bincount(held // n_docs, weights=label[held % n_docs], minlength=BUCKETS)
    n_toxic = label.sum()
    n_other = n_docs - n_toxic
    p, q = (toxic + 0.5) / (n_toxic + 1), (total - toxic + 0.5) / (n_other + 1)
    error = np.sqrt((p + q) / 2 * (1 / (n_toxic + 1) + 1 / (n_other + 1)))
    chosen = (p - q) > SIGNIFICANT * error
    return chosen, np.where(chosen, np.log(p / q), 0.0) / PER_WORD


@dataclass
class Counterfactuals:
    """Sentences written again: a term out (-1: none), a term in, and a weight each."""

    sentence: np.ndarray
    out: np.ndarray
    into: np.ndarray
    weight: np.ndarray


def counterfactuals(named: np.ndarray, sentence: np.ndarray) -> Counterfactuals:
    """All swaps in the sentences of the sample, and a neutral mention in the others.

    ``named`` is the identity term of each word (-1: none).  Swaps weigh 1 in
    all, and so do the mentions put in.
    """
    group = np.array(term_features()[1])
    rows: list[np.ndarray] = []
    at = np.flatnonzero(named >= 0)
    of = np.searchsorted(sentence, at, "right") - 1
    for k in np.unique(group):
        terms = np.flatnonzero(group == k)
        here = np.flatnonzero(group[named[at]] == k)
        for into in terms.tolist():
            other = here[named[at[here]] != into]
            rows.append(np.stack([of[other], named[at[other]], np.full(len(other), into)]))
    swaps = np.concatenate(rows, axis=1)
    bare = np.setdiff1d(np.arange(len(sentence)), of)
    mentions = np.stack([bare, np.full(len(bare), -1), np.arange(len(bare)) % len(group)])
    weight = np.repeat([1 / max(1, swaps.shape[1]), 1 / max(1, mentions.shape[1])],
                       [swaps.shape[1], mentions.shape[1]])
    return Counterfactuals(*np.concatenate([swaps, mentions], axis=1), weight)


def swap_penalty(z: np.ndarray, u: np.ndarray, head: np.ndarray, doc: np.ndarray,
                 swaps: Counterfactuals):
    """(penalty, its gradient by sentence score, by term score).

    The penalty is the weighted mean square of the change of the pooled score
    of the document (the mean of its sentences' scores ``z``, weighted by their
    exponentials) when one sentence's score changes by that of the term put in
    less that of the term taken out (``u``, score per term).
    """
    n_docs, n_terms = len(head), len(u)
    size = np.diff(np.append(head, len(z)))
    z = z - np.repeat(np.maximum.reduceat(z, head), size)  # pooled scores shift alike
    e = np.exp(z)
    whole, mass = np.add.reduceat(e, head), np.add.reduceat(e * z, head)
    pooled = mass / whole
    d, s = doc[swaps.sentence], swaps.sentence
    moved = z[s] + u[swaps.into] - np.where(swaps.out >= 0, u[swaps.out], 0.0)
    e_moved = np.exp(moved)
    whole_after = whole[d] - e[s] + e_moved
    after = (mass[d] - e[s] * z[s] + e_moved * moved) / whole_after
    change = after - pooled[d]
    pull = 2 * swaps.weight * change
    # d pooled / d z_j = e_j (1 + z_j - pooled) / whole, before and after the swap.
    a = np.bincount(d, pull / whole_after, n_docs)
    b = np.bincount(d, pull * after / whole_after, n_docs)
    c = np.bincount(d, pull, n_docs)
    gradient = e * ((1 + z) * a[doc] - b[doc]) - e * (1 + z - pooled[doc]) * (c / whole)[doc]
    own = pull * e_moved * (1 + moved - after) / whole_after
    gradient += np.bincount(s, own - pull * e[s] * (1 + z[s] - after) / whole_after, len(z))
    by_term = np.bincount(swaps.into, own, n_terms)
    gone = swaps.out >= 0
    by_term -= np.bincount(swaps.out[gone], own[gone], n_terms)
    return float((swaps.weight * change ** 2).sum()), gradient, by_term


def fit(features, sentence, doc, label, named, penalty: float = PENALTY,
        steps: int = STEPS) -> Classifier:
    """Adam from the log odds on, on document losses plus the counterfactual penalty.

    ``sentence`` is the first word of each sentence, ``doc`` its document (numbered
    from 0, each with a sentence), ``label`` per document, ``named`` the identity
    term of each word (-1: none).  A document's score is a soft maximum over its
    sentences, so its label reaches the sentences that matter.
    """
    _, _, terms, _ = term_features()
    swaps = counterfactuals(named, sentence)
    flat = features.ravel()
    lengths = np.diff(np.append(sentence, len(features)))
    chosen, weights = _telling(features, np.repeat(doc, lengths), label)
    fitted = chosen.copy()
    fitted[terms.ravel()] = True
    head = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    size = np.diff(np.append(head, len(doc)))
    share_of = np.where(label == 1, 0.5 / max(1, (label == 1).sum()),
                        0.5 / max(1, (label == 0).sum()))
    bias = -2.0
    m, v = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for step in range(1, steps + 1):
        z = np.add.reduceat(weights[features].sum(axis=1), sentence) + bias
        soft = np.exp(z - np.repeat(np.maximum.reduceat(z, head), size))
        soft /= np.repeat(np.add.reduceat(soft, head), size)
        pooled = np.add.reduceat(soft * z, head)
        pull = np.repeat((_sigmoid(pooled) - label) * share_of, size) * soft

        def per_feature(by_sentence):
            return np.bincount(flat, np.repeat(np.repeat(by_sentence, lengths), PER_WORD),
                               minlength=BUCKETS)

        gradient = (per_feature(pull) + 1e-5 * weights) * chosen
        _, by_sentence, by_term = swap_penalty(
            z, weights[terms].sum(axis=1), head, doc, swaps)
        gradient += penalty * fitted * (per_feature(by_sentence) + np.bincount(
            terms.ravel(), np.repeat(by_term, PER_WORD), minlength=BUCKETS))
        whole = np.append(gradient, pull.sum())
        m = 0.9 * m + 0.1 * whole
        v = 0.99 * v + 0.01 * whole ** 2
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Classifier(weights.astype(np.float32), float(bias))


def named_terms(full: np.ndarray) -> np.ndarray:
    """The identity term that each word (by its hash) is, -1 for others."""
    hashes = term_features()[3]
    order = np.argsort(hashes)
    at = order[np.minimum(np.searchsorted(hashes, full, sorter=order), len(hashes) - 1)]
    return np.where(hashes[at] == full, at, -1)


def train(documents: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Classifier | None:
    """A classifier from labels outside the held-out fold; None without both classes."""
    given = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                         & (frames.fold("doc_id", FOLDS) != HELD_OUT)).groupBy(
        F.col("doc_id").alias("did")).agg(F.min("toxic").cast("int").alias("label"))
    chosen = None
    for value in (0, 1):
        some = given.where(F.col("label") == value).orderBy(F.xxhash64("did"), "did").limit(limit)
        chosen = some if chosen is None else chosen.union(some)
    sample = frames.keyed(documents).join(F.broadcast(chosen), "did").dropDuplicates(
        ["did", "rid"]).where(F.octet_length("text") <= SAMPLE_BYTES).select("text", "label")

    def run(batches):
        schema = pa.schema([("features", pa.binary()), ("sentence", pa.binary()),
                            ("named", pa.binary()), ("label", pa.int32())])
        for batch in batches:
            label = np.asarray(batch.column(1))
            for i, j, data, offsets in tb.chunks(batch.column(0)):
                features, full, sentence, first = word_features(data, offsets)
                cut = np.searchsorted(sentence, first)
                named = named_terms(full).astype(np.int8)
                for r in range(j - i):
                    a, b = first[r], first[r + 1]
                    yield pa.RecordBatch.from_pydict({
                        "features": [features[a:b].astype("<i4").tobytes()],
                        "sentence": [(sentence[cut[r]:cut[r + 1]] - a).astype("<i4").tobytes()],
                        "named": [named[a:b].tobytes()],
                        "label": [int(label[i + r])]}, schema=schema)

    rows = sample.mapInArrow(
        run, "features binary, sentence binary, named binary, label int").toArrow().to_pylist()
    # In an order of their own, so that the fit does not depend on partitions.
    rows = sorted((r for r in rows if r["sentence"]), key=lambda r: (r["label"], r["features"]))
    label = np.array([r["label"] for r in rows])
    if len(set(label.tolist())) < 2:
        return None
    features = [np.frombuffer(r["features"], "<i4").reshape(-1, PER_WORD) for r in rows]
    base = np.concatenate(([0], np.cumsum([len(f) for f in features])))
    sentence = [np.frombuffer(r["sentence"], "<i4") + b for r, b in zip(rows, base)]
    doc = np.repeat(np.arange(len(rows)), [len(s) for s in sentence])
    named = np.frombuffer(b"".join(r["named"] for r in rows), np.int8).astype(np.int64)
    return fit(np.concatenate(features), np.concatenate(sentence), doc, label, named)


def score(documents: DataFrame, classifier: Classifier | None,
          threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    def run(batches):
        for batch in batches:
            out = []
            for _, _, data, offsets in tb.chunks(batch.column(1)):
                out.append(np.full(len(offsets) - 1, 0.5) if classifier is None
                           else classifier.score(data, offsets))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(out) if out else np.zeros(0))],
                names=["doc_id", "score"])

    scored = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double")
    return scored.select(
        "doc_id", (frames.fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def op4(spark, sf_dir: str) -> DataFrame:
    """Toxicity scores of every document."""
    documents = frames.table(spark, sf_dir, "documents")
    return score(documents, train(documents, frames.table(spark, sf_dir, "labels")))
