"""Connected components of a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghaven.lake import stored


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("sum")).first()
    return row["n"], row["sum"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the least node among itself and them."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """node, root: the least node of the component, for all nodes with an edge but the roots.

    ``edges`` has two long columns a and b. Loops and repeated edges change nothing; nulls are
    dropped; no edges give no rows. The number of rounds grows with the logarithm of the
    longest path. Minima are combined before they are shuffled, each round is written to the
    shared folder, and the driver sees two numbers a round.
    """
    now = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before, digest = None, _digest(now)
    while digest[0] and digest != before:
        now = stored(_small_star(_large_star(now)), "edges")
        before, digest = digest, _digest(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


class Union:
    """Union-find over small dense numbers, for one task's block."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether the two were apart."""
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True
