"""Connected components of a large graph, by repeated minimum labels over Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.state import cut


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) for every node of ``edges`` (a, b).

    Large-star and small-star steps in turn, until only stars are left: every step hangs a node's
    neighbours on the smallest of them, so chains halve and a star stays a star.  A step is one
    aggregation and one join on the node; a hub's rows are split by adaptive execution.  Each
    round is written to the shared folder, so a lost executor costs one round at most.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    files = 1 + now.count() // 250_000  # steps never add edges beyond twice their number
    for _ in range(most_rounds):
        if _settled(now):
            break
        now = cut(_small_star(_large_star(now)).coalesce(files))
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads from a node with no other edge to the smallest node of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)")
    return odd.limit(1).count() == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
    # edges are stored larger end first: the node is b, its larger neighbour a
    moved = edges.join(least, "b").select("a", F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
