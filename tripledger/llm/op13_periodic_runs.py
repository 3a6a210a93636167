"""Periodic runs of words by an online sparse diagonal programme.

A run is a stretch of consecutive words with smallest period q and a length of
at least ``max(SHORTEST, POWER * q)`` that no neighbouring word extends keeping
period q.

The words of a text are read once, in order.  A word's earlier occurrences name
the lags at which it repeats; an active lag's match length grows while the word
equals the one that many words before, and where it does not, the diagonal ends
and, if long enough, is a run at once.  Only diagonals that can become runs are
made active, which loses none:

* a run's diagonal has at least ``SEED`` matches in a row, so an occurrence
  counts only with the same next ``SEED - 1`` words, and further on the words
  one and two lags ahead must repeat too;
* a diagonal starts where the words before differ, so of the earlier
  occurrences only those after another word are looked at;
* where an active lag q divides d and reaches back d words, the text has period
  q there, so lag d has no run of its own.

Of diagonals that end together on the same stretch the smallest lag is the
period.  A scan without shuffle; memory follows the longest text (some 100
bytes per word).

Defined results: NULL or empty text has no words, no runs and the digest of the
empty string twice; NULL doc_id is carried through; repeated rows get equal
results; an empty table gives no rows; other input columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripledger.llm import frames

SHORTEST, POWER = 6, 4
SEED = SHORTEST - 1  # matches that any run's diagonal has at least

SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, "
          "exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
          "collapsed_text string")


def _numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def _grams(number: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the windows of ``size`` words, equal for equal windows only."""
    out, have = number, 1
    while have < size:
        step = min(have, size - have)
        left, right = out[:len(out) - step], out[step:]
        out = np.unique(left * (int(out.max()) + 1) + right, return_inverse=True)[1]
        have += step
    return out


def find_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n = len(words)
    if n < SHORTEST:
        return []
    number = _numbers(words)
    gram = _grams(number, SEED)
    seen_often = np.bincount(gram)[gram] > 1
    if not seen_often.any():
        return []
    number, gram = number.tolist(), gram.tolist()
    spots = np.flatnonzero(seen_often).tolist()
    # gram -> word before it -> where it was seen
    earlier: dict[int, dict[int, list[int]]] = {}
    active: dict[int, int] = {}  # lag -> where its stretch starts
    runs: list[tuple[int, int, int]] = []
    i, next_spot = 0, 0
    while True:
        if not active:  # on to the next word that may activate a lag
            if next_spot == len(spots):
                break
            i = spots[next_spot]
        ended = [d for d in active if i == n or number[i] != number[i - d]]
        if ended:
            starts = set()
            for d in sorted(ended):
                start = active.pop(d)
                if i - start >= max(SHORTEST, POWER * d) and start not in starts:
                    starts.add(start)
                    runs.append((start, i - start, d))
        if next_spot < len(spots) and spots[next_spot] == i:
            next_spot += 1
            before = number[i - 1] if i else -1
            same = earlier.setdefault(gram[i], {})
            for word, places in same.items():
                if word == before:
                    continue
                for j in reversed(places):
                    d = i - j
                    if i + (POWER - 1) * d > n:  # no room for a run; nor for longer lags
                        break
                    if d >= SEED and not gram[i] == gram[i + d] == gram[i + 2 * d]:
                        continue
                    if any(d % q == 0 and start <= j for q, start in active.items()):
                        continue
                    active[d] = j
            same.setdefault(before, []).append(i)
        if i == n:
            if not active and next_spot == len(spots):
                break
        else:
            i += 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that repeat a run's first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def sharpest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period; on ties the first, then the shortest period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(documents: DataFrame, texts: bool = True,
                  rewrite: Callable[[int, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``SCHEMA`` of every row, collapsed_text only if ``texts``.

    ``rewrite`` (did, words) may change a text's words first.
    """
    def run(batches):
        for batch in batches:
            out = []
            for did, text in zip(batch.column(0).to_pylist(),
                                 batch.column(2).cast(pa.large_binary())):
                words = text.as_py().split()
                if rewrite is not None:
                    words = rewrite(did, words)
                runs = find_runs(words)
                best = sharpest(runs)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                left = b" ".join(collapse(words, runs))
                out.append((
                    None if did == frames.NO_ID else did, len(words), len(runs),
                    *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                    hashlib.sha256(listed.encode()).hexdigest(),
                    hashlib.sha256(left).hexdigest(), left.decode("utf-8") if texts else None))
            columns = list(zip(*out)) if out else [()] * 10
            types = [pa.int64()] * 7 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=[c.split()[0] for c in SCHEMA.split(", ")])

    return frames.keyed(documents).mapInArrow(run, SCHEMA)


def plant(did: int, words: list[bytes]) -> list[bytes]:
    """Every tenth document (by the crc32 of its id) made periodic from a word on."""
    h = zlib.crc32(b"" if did == frames.NO_ID else str(did).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op13(spark, sf_dir: str) -> DataFrame:
    """Runs of ``documents``, every tenth of which is made periodic first."""
    return periodic_runs(frames.table(spark, sf_dir, "documents"), texts=False, rewrite=plant).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256", "n_words")
