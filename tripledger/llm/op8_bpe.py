"""BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a pre-token, the last token of that prefix's encoding is
unique.  It is found among the vocabulary entries that are suffixes of the
prefix (an automaton over all entries lists them, longest first): the one
whose pair with the last token of what precedes it is compatible, that is,
merging the two tokens' text again gives these two tokens.  Following the
stored tokens back from the end emits the ids, equal to the merge procedure's,
in time linear in the text whatever its length.

A scan without shuffle.  Distinct pre-tokens are worked out once per worker
(see ``pretokens``), so the cost of a text is that of cutting it.

Defined results: NULL text is empty: no ids, empty decoded text; NULL doc_id is
carried through; repeated rows are encoded each; an empty table gives none;
other input columns are not read.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tripledger.llm import frames
from tripledger.llm.pretokens import WORD_END, PretokenTable, Vocabulary, symbols

_END = "\0"  # stands for the end-of-word mark: one symbol, in no byte alphabet
_NEVER = 1 << 60


class PrefixEncoder:
    """Encodes one pre-token at a time."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        ids = vocabulary.ids
        self.rank = dict.fromkeys(ids.values(), -1)  # of the merge that makes a token
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}  # pair -> rank
        for rank, (left, right) in enumerate(vocabulary.merges):
            pair, token = (ids[left], ids[right]), ids[left + right]
            self.merged.setdefault(pair, rank)
            if token not in self.parts:
                self.parts[token], self.rank[token] = pair, rank
        self.alone: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.length: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            if not self.whole(i):  # no text encodes to it
                continue
            closed = token.endswith(WORD_END) and token != WORD_END
            text = token[:-len(WORD_END)] + _END if closed else token
            self.length[i] = len(text) - closed
            self.automaton.add_word(text, (i, len(text) - closed, closed))
        self.automaton.make_automaton()

    def _meets(self, a: int, b: int, limit: int) -> bool:
        """Whether tokens a and b stay apart at their border before merge ``limit``.

        Undoes the later of the two tokens' merges, again and again: the pair
        that faced each other at the border then must not merge any earlier.
        """
        rank, parts, merged = self.rank, self.parts, self.merged
        while True:
            if merged.get((a, b), _NEVER) < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], parts[a][1]
            elif rank[b] < 0:
                return True
            else:  # of equal merges the left one goes first
                limit, b = rank[b] + 1, parts[b][0]

    def compatible(self, a: int, b: int) -> bool:
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            found = self.pairs[a, b] = self._meets(a, b, _NEVER)
        return found

    def whole(self, token: int) -> bool:
        """Whether a token's own text encodes to that token alone."""
        found = self.alone.get(token)
        if found is None:
            pair = self.parts.get(token)
            found = self.alone[token] = pair is None or (
                self.whole(pair[0]) and self.whole(pair[1])
                and self._meets(*pair, self.rank[token]))
        return found

    def encode(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        text = symbols(word)
        n = len(text)
        last = [-1] * (n + 1)
        known = self.pairs.get
        for end, (token, length, closed) in self.automaton.iter(text + _END):
            at = n if closed else end + 1
            if last[at] >= 0 or (at == n) != closed:
                continue
            if at > length:
                previous = last[at - length]
                if previous < 0:
                    continue
                meets = known((previous, token))
                if not (self.compatible(previous, token) if meets is None else meets):
                    continue
            last[at] = token
        out = []
        while n:
            out.append(last[n])
            n -= self.length[last[n]]
        return out[::-1]


_encoders: dict[str, tuple[Vocabulary, PretokenTable]] = {}


def _facets(encoder: PrefixEncoder):
    tokens = encoder.vocabulary.tokens

    def work(word):
        ids = [word] if isinstance(word, int) else encoder.encode(word)
        return (len(ids), " ".join(map(str, ids)).encode(),
                " ".join(tokens[i] for i in ids).encode("utf-8"))

    return work


def _table(path: str) -> PretokenTable:
    """This worker's table, kept between tasks."""
    if path not in _encoders:
        vocabulary = Vocabulary(path)
        _encoders[path] = vocabulary, PretokenTable(vocabulary, _facets(PrefixEncoder(vocabulary)))
    return _encoders[path][1]


def encode(rows: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (as decimal text, joined by one space), decoded text, n_tokens."""
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        table = _table(path)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for facets in table.rows(batch.column(1)):
                counts.append(sum([f[0] for f in facets]))
                ids.append(b" ".join([f[1] for f in facets]))
                decoded.append(b" ".join([f[2] for f in facets]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()),
                 pa.array(ids, pa.binary()).cast(pa.string()),
                 pa.array(decoded, pa.binary()).cast(pa.string())],
                names=[id_col, "n_tokens", "ids", "decoded"])

    return rows.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, n_tokens long, ids string, decoded string")


def digests(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document.

    The digests are taken in the tasks that encode, so the id lists, several
    times the text, never leave them.
    """
    def run(batches):
        table = _table(path)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for facets in table.rows(batch.column(1)):
                counts.append(sum([f[0] for f in facets]))
                ids.append(hashlib.sha256(b" ".join([f[1] for f in facets])).hexdigest())
                decoded.append(hashlib.sha256(b" ".join([f[2] for f in facets])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select(documents["doc_id"].cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary_path() -> str:
    """The vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text of ``documents``."""
    return digests(frames.table(spark, sf_dir, "documents"), vocabulary_path())
