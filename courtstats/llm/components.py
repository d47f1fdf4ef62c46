"""Connected components of a link table by alternating star contraction.

Each round hangs the larger neighbours of every node below its smallest neighbour (large star),
then the smaller ones (small star). Links never grow in number, a chain shrinks
by a constant factor a round, and every step is an aggregate and a join on the node, so a node with most
of the links is pre-aggregated in the aggregate and split in the join. Only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(low, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every link points from the larger node ``a`` to the smaller ``b``."""
    low = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(low.select("a", F.col("m").alias("b"))).distinct()


def _unfinished(links: DataFrame) -> bool:
    """Whether a node has two parents, or a parent has one itself."""
    ends = links.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        links.select(F.col("b").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    per_node = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return bool(per_node.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).take(1))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another; root is the smallest node reachable.

    Links are undirected; loops, repeated links and links with a null end change nothing. No
    links: no rows.
    """
    x, y = F.col(a), F.col(b)
    now = materialize(
        links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    )
    while _unfinished(now):
        now = materialize(_small_star(_large_star(now)))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
