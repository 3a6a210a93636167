"""Whole texts as UTF-8 bytes in numpy: words, span hashes, sliding minima.

The functions run inside tasks on Arrow batches.  They work on runs of whole
documents of about ``CHUNK`` bytes, so their memory follows the chunk or, if
longer, the longest document (some 60 bytes for each byte of text).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd and 5 modulo 8: powers have the longest period
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _random_longs(n: int, seed: str) -> np.ndarray:
    """``n`` fixed odd 64-bit values, the same in every process."""
    raw = b"".join(hashlib.blake2b(f"{seed}:{i}".encode(), digest_size=8).digest()
                   for i in range(n))
    return np.frombuffer(raw, "<u8") | np.uint64(1)


BYTE_VALUE = _random_longs(256, "byte")
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(2 * CHUNK, 1 << n.bit_length()) + 1
        with np.errstate(over="ignore"):
            _powers[:] = [np.concatenate(([np.uint64(1)], np.multiply.accumulate(
                np.full(size - 1, base, np.uint64)))) for base in (_BASE, _BASE_INVERSE)]
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK):
    """Runs of whole rows: (first row, last row + 1, bytes, offsets from 0)."""
    data, offsets = buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, first word of each row and the total) of white-space words."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    fresh = np.ones(n + 1, bool)  # the byte before is white space or of another row
    fresh[1:n] = ~solid[:-1]
    fresh[offsets] = True
    starts = np.flatnonzero(solid & fresh[:-1])
    after = np.ones(n, bool)
    after[:-1] = ~solid[1:]
    inner = offsets[(offsets > 0)]
    after[inner - 1] = True
    ends = np.flatnonzero(solid & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number (zeros past the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of k bytes
_LONG = 1 << 14  # spans from here on are hashed one by one


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each span's bytes; other seeds give independent hashes.

    Eight bytes at a time are mixed into the state, which no sum of parts can
    undo: texts built to agree in a polynomial hash do not agree in this one.
    """
    key = _random_longs(2, f"word-hash {seed}")
    left = ends - starts
    out = mix(left.astype(np.uint64) * key[0] + key[1])
    eights, live, at = _eights(data), None, starts
    while True:
        if live is None:
            live = np.flatnonzero((left > 0) & (left < _LONG))
        else:
            live = live[left[live] > 0]
        if not len(live):
            break
        part = eights[at[live]] & _LOW[np.minimum(left[live], 8)]
        out[live] = mix((out[live] ^ part) * key[0]) + key[1]
        at, left = at + 8, left - 8
    for i in np.flatnonzero(ends - starts >= _LONG).tolist():
        out[i] = np.frombuffer(hashlib.blake2b(
            data[starts[i]:ends[i]].tobytes(), digest_size=8, salt=b"%d" % seed).digest(), "<u8")[0]
    return out


def same_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the spans of these lengths starting at ``a`` and ``b`` hold equal bytes."""
    out = np.ones(len(a), bool)
    eights, live, done = _eights(data), np.flatnonzero((lengths > 0) & (a != b)), 0
    while len(live):
        differ = (eights[a[live] + done] ^ eights[b[live] + done]) & _LOW[
            np.minimum(lengths[live] - done, 8)]
        out[live[differ != 0]] = False
        done += 8
        live = live[(differ == 0) & (lengths[live] > done)]
    return out


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash: any span's hash is one difference away.

    For features and samples only: texts can be built that agree in it."""
    power, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * power[:len(data)], out=out[1:])
    return out


def span_hash(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, from its bytes alone."""
    _, inverse = powers(len(running))
    return mix((running[ends] - running[starts]) * inverse[starts])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[:len(values) - width + 1], out[width - have:])
    return out


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes the index of its smallest, leftmost on ties.

    Equal runs choose the same place in the run, so what is chosen depends on
    content alone: the upper 32 bits of the hashes decide, then the place.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64)
    low = np.uint64(0xFFFFFFFF)
    ranked = (hashes & ~low) | np.arange(n, dtype=np.uint64)
    return (sliding_min(ranked, width) & low).astype(np.int64)
