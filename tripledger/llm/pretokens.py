"""Pre-tokens of the lower-casing word BPE vocabulary, and a per-worker table of them.

The vocabulary's file prescribes: compose (NFC), take white space for blanks,
lower every character, cut into contractions, runs of letters, single digits
and runs of other characters, write each as byte symbols, the last one with an
end-of-word mark, and merge.  Special tokens are found in the raw text first.

Texts of ASCII and Latin-1 letters without apostrophes are cut in numpy; any
other text goes character by character through the same rules as regular
expressions.  Both give the same pre-tokens (tested against the library).
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import regex

from tripledger.llm import textbytes as tb

# Fixed values of the vocabulary file's pre-tokeniser.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CUT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
WORD_END = "</w>"

_LETTER, _DIGIT, _OTHER = 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[tb.SPACE] = 0
_CLASS[48:58] = _DIGIT
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


_SYMBOL = {b: s for b, s in enumerate(byte_symbols())}


def symbols(word: str) -> str:
    """A pre-token as byte symbols."""
    return word.encode("utf-8").decode("latin-1").translate(_SYMBOL)


class Vocabulary:
    """What the vocabulary file says, without any encoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                       for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in {**self.ids, **self.special}.items()}
        self.cut_special = regex.compile(
            "(" + "|".join(regex.escape(t) for t in self.special) + ")")


def plain_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows the numpy cut handles: no byte that needs more than its class."""
    odd = (data == 0x27)
    odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)  # may begin a special token
    after_c3 = np.zeros(len(data), bool)
    after_c3[1:] = data[:-1] == 0xC3
    odd |= (data >= 0x80) & (data != 0xC3) & ~after_c3
    odd |= after_c3 & ((data == 0x97) | (data == 0xB7))  # multiplication, division
    bad = np.concatenate(([0], np.cumsum(odd)))
    return bad[offsets[1:]] == bad[offsets[:-1]]


def cut_plain(data: np.ndarray, offsets: np.ndarray):
    """(lowered bytes, starts, ends, first pre-token of each row and the total)."""
    low = tb.LOWER[data]
    after_c3 = np.zeros(len(data), bool)
    after_c3[1:] = data[:-1] == 0xC3
    low[after_c3 & (data <= 0x9E) & (data != 0x97)] += 0x20
    kind = _CLASS[low]
    first = np.ones(len(data) + 1, bool)
    first[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    first[offsets] = True
    at = np.flatnonzero(first)
    starts, ends = at[:-1], at[1:]
    solid = kind[starts] != 0
    starts, ends = starts[solid], ends[solid]
    return low, starts, ends, np.searchsorted(starts, offsets)


def cut_any(text: str, vocabulary: Vocabulary):
    """Pre-tokens of any text, special tokens as their ids."""
    for piece in vocabulary.cut_special.split(text):
        if piece in vocabulary.special:
            yield vocabulary.special[piece]
        elif piece:
            piece = unicodedata.normalize("NFC", piece)
            low = piece.lower() if "Σ" not in piece else "".join(c.lower() for c in piece)
            yield from CUT.findall(low)


class PretokenTable:
    """What each distinct pre-token stands for, worked out once per worker.

    ``work(word)`` gives a tuple of facets.  Pre-tokens cut in numpy are known
    by a 64-bit hash and their bytes, which are compared on every hit, others
    by their text; either part starts anew when it holds ``limit`` entries,
    which bounds the memory (some 400 bytes an entry).
    """

    def __init__(self, vocabulary: Vocabulary, work, limit: int = 800_000):
        self.vocabulary, self.work, self.limit = vocabulary, work, limit
        self.by_hash: dict[int, tuple[bytes, tuple]] = {}
        self.by_word: dict[object, tuple] = {}

    def word(self, word) -> tuple:
        found = self.by_word.get(word)
        if found is None:
            found = self.by_word[word] = self.work(word)
        return found

    def rows(self, column):
        """Per row of an Arrow string column: the list of its pre-tokens' facets."""
        for _, _, data, offsets in tb.chunks(column):
            for part in (self.by_hash, self.by_word):
                if len(part) > self.limit:
                    part.clear()
            plain = plain_rows(data, offsets)
            low, starts, ends, first = cut_plain(data, offsets)
            hashes = tb.word_hash(low, starts, ends)
            distinct, sample, place = np.unique(hashes, return_index=True, return_inverse=True)
            size, twin = ends - starts, sample[place]
            equal = size == size[twin]
            equal[equal] = tb.same_spans(low, starts[equal], starts[twin[equal]], size[equal])
            strays = np.flatnonzero(~equal)  # of equal hash, but other bytes than the sample
            used = np.zeros(len(distinct), bool)
            for row in np.flatnonzero(plain):
                used[place[first[row]:first[row + 1]]] = True
            facets = np.empty(len(distinct), object)
            raw, known = low.tobytes(), self.by_hash
            keys, begins, stops = (x.tolist() for x in (distinct, starts[sample], ends[sample]))
            for i in np.flatnonzero(used).tolist():
                key, own = keys[i], raw[begins[i]:stops[i]]
                found = known.get(key)
                if found is None:
                    found = known[key] = own, self.work(own.decode("utf-8"))
                facets[i] = found[1] if found[0] == own else self.word(own.decode("utf-8"))
            for row in range(len(offsets) - 1):
                if plain[row]:
                    a, b = first[row], first[row + 1]
                    out = facets[place[a:b]].tolist()
                    for i in strays[np.searchsorted(strays, a):np.searchsorted(strays, b)]:
                        out[i - a] = self.word(raw[starts[i]:ends[i]].decode("utf-8"))
                    yield out
                else:
                    text = bytes(data[offsets[row]:offsets[row + 1]]).decode("utf-8")
                    yield [self.word(w) for w in cut_any(text, self.vocabulary)]
