"""Connected components of a large edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from postlake.llm.tables import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect the larger neighbours of every node to the smallest of its neighbourhood."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect the smaller neighbours of every node, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written and read back, and what identifies them: how many, and sums of their hashes, all whole numbers
    so that no order of adding changes them."""
    seen = Observation()
    hashed = F.xxhash64("a", "b")
    marks = (F.count(F.lit(1)).alias("n"), F.bit_xor(hashed).alias("x"), F.sum(F.pmod(hashed, F.lit(1 << 31))).alias("s"))
    out = staged(edges.observe(seen, *marks), "edges")
    found = seen.get
    return out, (found["n"], found["x"], found["s"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node that has an edge in ``edges`` (a, b), but for roots; the root is the smallest id.

    Each round is written to the shared folder. The rounds end when every edge points to its root, which takes about
    the logarithm of the longest chain; aggregates are partial before they are shuffled, so a hub costs no more.
    """
    edges, now = _written(edges.filter("a <> b").select("a", "b").distinct())
    before = None
    while now[0] and now != before:
        before = now
        edges, now = _written(_small_star(_large_star(edges)))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
