"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.llm.shared import checkpointed


def _stars(links: DataFrame) -> DataFrame:
    """Every node with a neighbour, tied to the smallest node it sees (itself included)."""
    ends = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = ends.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # large star: neighbours above a node go to the least node that it sees
    large = (
        ends.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        .union(least.where("a <> m").select("a", F.col("m").alias("b")))
    )
    # small star: neighbours below a node, and the node itself, go to the least of them
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    return (
        large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        .union(low.select("a", F.col("m").alias("b"))).distinct()
    )


def _settled(links: DataFrame) -> bool:
    """Whether every node hangs on one other node that hangs on none."""
    ends = links.select(F.col("a").alias("n"), F.lit(1).alias("below"), F.lit(0).alias("top")).union(
        links.select(F.col("b").alias("n"), F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("n").agg(F.sum("below").alias("below"), F.max("top").alias("top"))
    return seen.where("below + top > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """`links` has long columns a and b. Returns (node, component): the smallest node reachable, for linked nodes.

    Alternates large and small stars until every node hangs on its component's smallest one, which takes about the
    logarithm of the longest path in rounds. Rows per round are at most twice the links; each round is checkpointed.
    """
    links = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not _settled(links):
        links = checkpointed(_stars(links))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
