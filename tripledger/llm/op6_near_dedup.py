"""MinHash near-duplicate groups, exact by confirmation on full shingle sets.

1. ``signatures``: a document's set of word-shingle hashes, the minima of
   ``BANDS * ROWS`` universal hash functions over it, one key per band, and a
   128-bit digest of the whole set.
2. Documents of equal sets form one class, whose smallest doc_id stands for it
   from here on: thousands of copies cost one row.
3. Documents that share a band key are candidates.  A key's documents are tied
   to the smallest of them (never paired with each other), and the ties'
   connected components are the candidate groups; each document is in one.
4. Inside a group, pairs are compared first by signature (share of equal
   minima), then exactly on the full sets; pairs already joined through others
   are skipped, and only links that join something are emitted.  A large group
   is first compared with a few central documents (those with most candidate
   partners), which is linear in its size; if parts of it stay unjoined, it is
   dealt over blocks and every pair of blocks with different parts compared.
5. Connected components of the confirmed links, by alternating large-star and
   small-star, are the classes.

Band sizes: bands of 6 minima, as many as miss a pair at the threshold s with
odds (1 - s^6)^bands of at most 1e-6: 30 at 0.85, 46 at 0.80; 30 tie a pair of
0.3 with odds of 0.02.  The signature test drops pairs with under ``threshold -
0.2`` equal minima: 6 standard deviations away.  A shingle is a 64-bit hash of
its words' bytes.

Defined results: NULL or empty text, or text without words, has an empty set
and is linked with nothing; with fewer words than the shingle size, the whole
sequence is the one shingle; NULL doc_id takes part as the smallest id; rows
sharing a doc_id are one node, each row's set counting; an empty table gives no
rows; other input columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm import frames
from tripledger.llm import textbytes as tb
from tripledger.llm.components import components
from tripledger.llm.frames import release, stage

SHINGLE = 5
ROWS = 6  # minima of a band
MISS = 1e-6  # odds at most of tying no band of a pair at the threshold
BLOCK = 512  # documents of a group that one task compares at once
MARGIN = 0.2
SALTS = 64  # parts that a class of equal sets is dealt over
CENTRES = 3  # rounds of comparing a large group with a central document
FEW = 1 << 20  # candidate rows (three longs each) that may be broadcast

_FACTOR = tb._random_longs(SHINGLE + 64, "shingle")
_A = (tb._random_longs(200 * ROWS, "minhash-a") >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (tb._random_longs(200 * ROWS, "minhash-b") >> np.uint64(32)).astype(np.uint32)
_DIGEST = ["n_shingles", "one", "two"]
_NONE = np.zeros(0, np.uint64)


def bands_for(percent: int) -> int:
    """Bands that a similarity of ``percent`` needs."""
    tied = (percent / 100) ** ROWS
    return 1 if tied >= 1 else min(200, math.ceil(math.log(MISS) / math.log(1 - tied)))


def shingle_sets(column, size: int = SHINGLE):
    """Per row of an Arrow string column: the sorted distinct shingle hashes."""
    for _, _, data, offsets in tb.chunks(column):
        low = tb.LOWER[data]
        starts, ends, first = tb.words(low, offsets)
        word = tb.word_hash(low, starts, ends)
        n = len(word) - size + 1
        if n > 0:
            window = np.zeros(n, np.uint64)
            for j in range(size):
                window += word[j:j + n] * _FACTOR[j]
            window = tb.mix(window)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= size:
                yield np.unique(window[a:b - size + 1])
            elif b > a:  # marked by its word count, so it equals no full shingle
                short = (word[a:b] * _FACTOR[:b - a]).sum(dtype=np.uint64, keepdims=True)
                yield tb.mix(short + _FACTOR[SHINGLE + b - a])
            else:
                yield _NONE


def minhash(members: np.ndarray, bands: int) -> np.ndarray:
    """The minima of the universal hash functions a * x + b over a set."""
    x = (members >> np.uint64(32)).astype(np.uint32)
    n = bands * ROWS
    out = np.full(n, np.uint32(0xFFFFFFFF))
    for i in range(0, len(x), 2048):
        block = _A[:n, None] * x[None, i:i + 2048] + _B[:n, None]
        np.minimum(out, block.min(axis=1), out=out)
    return out


def _band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(-1, ROWS).astype(np.uint64)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(ROWS):
        key = tb.mix(key ^ rows[:, j])
    return key.view(np.int64)


def signatures(docs: DataFrame, n_bands: int) -> DataFrame:
    """did, rid, n_shingles, set digest (two longs), band keys of each row."""
    def run(batches):
        for batch in batches:
            sizes, ones, twos, bands = [], [], [], []
            for s in shingle_sets(batch.column(2)):
                sizes.append(len(s))
                ones.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                twos.append(int(tb.mix(s ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64)
                                .view(np.int64)))
                bands.append(_band_keys(minhash(s, n_bands)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(ones, pa.int64()), pa.array(twos, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["did", "rid", "n_shingles", "one", "two", "bands"])

    return docs.mapInArrow(
        run, "did long, rid long, n_shingles long, one long, two long, bands array<long>")


def _full_sets(docs: DataFrame, n_bands: int) -> DataFrame:
    """did, rid, grp, signature and set of candidate rows, as bytes."""
    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3),
                 pa.array([minhash(s, n_bands).tobytes() for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["did", "rid", "grp", "sig", "members"])

    return docs.select("did", "rid", "text", "grp").mapInArrow(
        run, "did long, rid long, grp long, sig binary, members binary")


class _Parts:
    """Union-find over the few documents of one task."""

    def __init__(self, labels):
        seen: dict[int, int] = {}
        self.up = [seen.setdefault(x, i) for i, x in enumerate(labels)]

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    both = int((b[place] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(rows: pa.Table, percent: int) -> pa.Table:
    """Links that join documents of one group (or of two blocks of it).

    ``part`` labels what is joined already; ``side`` 0 and 1 are the two blocks
    (2: a block with itself); only pairs across the two need comparing.
    """
    dids = rows["did"].to_pylist()
    side = np.asarray(rows["side"])
    sets = [np.frombuffer(x, np.uint64) for x in rows["members"].to_pylist()]
    sigs = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint32).reshape(len(dids), -1)
    parts = _Parts(rows["part"].to_pylist())
    least = (percent / 100 - MARGIN) * sigs.shape[1]
    a, b = [], []
    for i in range(len(dids)):
        roots = np.array([parts.root(j) for j in range(len(dids))]) if i % 64 == 0 else roots
        mine = parts.root(i)
        rest = np.flatnonzero((roots[i + 1:] != mine) & ((side[i + 1:] != side[i])
                                                        | (side[i] == 2))) + i + 1
        if not len(rest):
            continue
        near = rest[(sigs[rest] == sigs[i]).sum(axis=1) >= least]
        for j in near.tolist():
            if parts.root(j) != parts.root(i) and similar(sets[i], sets[j], percent):
                parts.join(i, j)
                a.append(dids[i])
                b.append(dids[j])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _joined(large: DataFrame, hits: DataFrame) -> DataFrame:
    """``large`` after the parts in ``hits`` (grp, part) became one per group.

    All links of a round share the group's centre, so the parts they touch
    form one part, whatever was joined before: no search for components."""
    one = hits.groupBy("grp").agg(F.min("part").alias("joined"))
    touched = hits.distinct().join(one, "grp")
    return large.join(touched, ["grp", "part"], "left").withColumn(
        "part", F.coalesce("joined", "part")).drop("joined")


def _open(members: DataFrame, limit: int) -> DataFrame:
    """Groups of more than ``limit`` rows in more than one part."""
    return members.groupBy("grp").agg(
        F.count(F.lit(1)).alias("size"), F.min("part").alias("lo"), F.max("part").alias("hi"),
    ).where((F.col("size") > limit) & (F.col("lo") != F.col("hi")))


def confirm_links(members: DataFrame, degrees: DataFrame, percent: int,
                  block: int = BLOCK) -> DataFrame:
    """Confirmed links (a, b) inside candidate groups; a stored stage.

    ``members`` (stored) has did, rid, grp, sig, members; ``degrees`` did, degree.
    """
    pair_schema = "a long, b long"
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    sized = members.join(sizes, "grp")

    def one_group(rows: pa.Table) -> pa.Table:
        return _confirm(rows, percent)

    small = sized.where(F.col("size") <= block).withColumns(
        {"side": F.lit(2), "part": F.col("did")}).select(
        "grp", "did", "side", "part", "sig", "members")
    links = stage(small.groupBy("grp").applyInArrow(one_group, pair_schema), "links-small")

    large = sized.where(F.col("size") > block)
    if large.isEmpty():
        return links
    large = stage(large.join(degrees, "did", "left").withColumn("part", F.col("did")),
                  "large-groups")
    tried = None
    for _ in range(CENTRES):
        # A centre per group: most candidate partners, not tried before.
        rest = large.join(_open(large, block).select("grp", "lo"), "grp")
        if tried is not None:
            rest = rest.join(tried, ["grp", "rid"], "left_anti")
        order = F.struct(F.coalesce("degree", F.lit(0)), F.bitwise_not("did"), "rid")
        centre = rest.groupBy("grp").agg(F.max_by(
            F.struct("rid", "did", "part", "sig", "members"), order).alias("centre"))
        centre = stage(centre, "centres")
        if centre.isEmpty():
            break
        found = large.join(centre, "grp").where("part != centre.part").select(
            "did", "sig", "members", F.col("centre.did").alias("c_did"),
            F.col("centre.sig").alias("c_sig"), F.col("centre.members").alias("c_members"),
            "grp", "part", F.col("centre.part").alias("c_part"))

        def against(batches):
            least = (percent / 100 - MARGIN) * bands_for(percent) * ROWS
            for batch in batches:
                linked = []
                cols = [batch.column(i) for i in range(6)]
                for i in range(batch.num_rows):
                    did, sig, own, c_did, c_sig, c_own = (c[i].as_py() for c in cols)
                    linked.append(did != c_did and (np.frombuffer(sig, np.uint32) == np.frombuffer(
                        c_sig, np.uint32)).sum() >= least and similar(
                        np.frombuffer(own, np.uint64), np.frombuffer(c_own, np.uint64), percent))
                hit = batch.filter(pa.array(linked, pa.bool_()))
                yield pa.RecordBatch.from_arrays(
                    [hit.column(i) for i in (0, 3, 6, 7, 8)],
                    names=["a", "b", "grp", "part", "c_part"])

        more = stage(found.mapInArrow(
            against, f"{pair_schema}, grp long, part long, c_part long"), "links-centre")
        links = links.union(more.select("a", "b"))
        done = centre.select("grp", "centre.rid")
        tried = done if tried is None else tried.union(done)
        hits = more.select("grp", F.explode(F.array("part", "c_part")).alias("part"))
        large = stage(_joined(large, hits), "large-groups")

    still = large.join(_open(large, block).select("grp"), "grp")
    # Blocks hold documents of one part where a part fills them, so that pairs
    # of blocks of the same part need no comparison.
    of_part = still.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"))
    mixed_rows = of_part.groupBy("grp").agg(
        F.sum(F.when(F.col("n") <= block, F.col("n")).otherwise(0)).alias("n_mixed"))
    blocks = still.join(of_part.join(mixed_rows, "grp"), ["grp", "part"]).withColumn(
        "blk", F.when(F.col("n") > block, F.struct(
            F.col("part").alias("label"),
            F.pmod(F.xxhash64("rid"), F.ceil(F.col("n") / block)).alias("no")))
        .otherwise(F.struct(
            F.lit(frames.NO_ID).alias("label"),
            F.pmod(F.xxhash64("rid"), F.ceil(F.col("n_mixed") / block)).alias("no"))))
    blocks = stage(blocks.select("grp", "did", "part", "sig", "members", "blk"), "blocks")
    names = blocks.select("grp", "blk").distinct()
    mixed = F.col("p.label") == frames.NO_ID
    pairs = names.withColumnRenamed("blk", "p").join(
        names.withColumnRenamed("blk", "q"), "grp").where(
        (F.col("p") < F.col("q")) & (F.col("p.label") != F.col("q.label"))
        | (F.col("p") < F.col("q")) & mixed | (F.col("p") == F.col("q")) & mixed)
    ends = pairs.select("grp", "p", "q", F.explode(F.when(
        F.col("p") == F.col("q"), F.array(F.struct(F.col("p").alias("blk"), F.lit(2).alias("side")))
    ).otherwise(F.array(F.struct(F.col("p").alias("blk"), F.lit(0).alias("side")),
                        F.struct(F.col("q").alias("blk"), F.lit(1).alias("side"))))).alias("e"))
    rows = ends.select("grp", "p", "q", "e.blk", "e.side").join(blocks, ["grp", "blk"]).select(
        "grp", "p", "q", "did", "side", "part", "sig", "members")
    rest = stage(rows.groupBy("grp", "p", "q").applyInArrow(one_group, pair_schema),
                 "links-blocks")
    return links.union(rest)


def _equal_sets(filled: DataFrame) -> DataFrame:
    """One row per class of equal sets: its first document, rows and salts.

    The rows of a class are dealt over its salts, so that thousands of copies
    meet their first document in many tasks."""
    shares = filled.groupBy(*_DIGEST, "salt").agg(
        F.min(F.struct("did", "rid")).alias("first"), F.count(F.lit(1)).alias("n"))
    return shares.groupBy(*_DIGEST).agg(
        F.min("first").alias("first"), F.sum("n").alias("n"),
        F.collect_list("salt").alias("salts"))


def near_duplicates(documents: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, n_links_found of every row."""
    docs = frames.keyed(documents)
    n_bands = bands_for(percent)
    rows = stage(signatures(docs, n_bands), "signatures")

    filled = rows.where("n_shingles > 0").withColumn(
        "salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)))
    classes = stage(_equal_sets(filled), "equal-sets")
    copies = filled.join(
        classes.where("n > 1").select(*_DIGEST, "first", F.explode("salts").alias("salt")),
        [*_DIGEST, "salt"]).select(
        F.col("did").alias("a"), F.col("first.did").alias("b")).where("a != b").distinct()

    # (band, key) of one row per class; the key holds the band's number already.
    head = classes.select("first.did", "first.rid")
    keys = stage(filled.join(head, ["did", "rid"], "left_semi").dropDuplicates(["did", "rid"])
                 .select("did", F.explode("bands").alias("band_key")), "band-keys")
    shared = keys.groupBy("band_key").agg(
        F.min("did").alias("first"), F.max("did").alias("last"), F.count(F.lit(1)).alias("n")
    ).where("first != last")
    tied = stage(keys.join(shared, "band_key").groupBy("did", "first").agg(
        F.sum("n").alias("n")), "ties")
    release(keys)
    degrees = tied.groupBy("did").agg(F.sum("n").alias("degree"))
    groups = stage(components(tied, "did", "first").withColumnsRenamed(
        {"node": "did", "component": "grp"}), "groups")

    # Ids first: texts meet the few candidates at hand, not every class's first row.
    wanted = stage(head.join(groups, "did"), "candidates")
    few = wanted.count() <= FEW
    members = stage(_full_sets(docs.join(F.broadcast(wanted) if few else wanted, ["did", "rid"]),
                               n_bands), "members")
    links = confirm_links(members, degrees, percent).union(copies)
    found = stage(components(links).withColumnsRenamed(
        {"node": "did", "component": "component"}), "classes")
    release(members, wanted, tied, groups, classes)
    component = F.coalesce("component", "did")
    return rows.select("did", "n_shingles").join(found, "did", "left").select(
        frames.public_id().alias("doc_id"), "n_shingles",
        F.when(component != frames.NO_ID, component).alias("component_id"),
        (F.col("did") == component).alias("kept"))


def op6(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of ``documents`` at similarity 0.85."""
    return near_duplicates(frames.table(spark, sf_dir, "documents"), 85)
