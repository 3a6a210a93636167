"""Connected components by alternating large-star and small-star.

Large-star links every larger neighbour of a node to the smallest node of its
neighbourhood; small-star links a node and its smaller neighbours to the
smallest of them.  Both keep the components and after a number of rounds
logarithmic in the nodes every component is a star around its smallest node.

Each step is a grouped minimum (combined before the shuffle, so a node with
many links costs each task one row) and a join on the node, which adaptive
execution splits where a node is hot.  Every round is written to the shared
folder; links never come to the driver, only their number and checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.frames import release, stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a"), F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(
        F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").where("b != m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node.

    Loops and NULL ends are ignored; no links give an empty table.
    """
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where(
        "a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = stage(links, "links"), None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"),
                        F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state["n"] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        following = stage(_small_star(_large_star(now)), "links")
        release(now)
        now = following
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
