"""Connected components of an edge table, by Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.storage import stored


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star."""
    # large star: of each node's neighbours, the larger ones move to the smallest one
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    large = both.where("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.least("a", "least").alias("b")
    ).distinct()
    # small star: a node and its smaller neighbours move to the smallest of these
    least = large.groupBy("a").agg(F.min("b").alias("least"))
    return large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")) \
        .where("a <> b").unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _done(edges: DataFrame) -> bool:
    """Whether every node has one edge to the smallest node of its component."""
    ends = edges.select("a", F.lit(1).alias("n")).unionByName(
        edges.select(F.col("b").alias("a"), F.lit(None).cast("int").alias("n")))
    return ends.groupBy("a").agg(F.count("n").alias("up"), F.count("*").alias("ends")) \
        .where("up > 1 or up = 1 and ends > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` for every node of `edges` (a, b); the component is its smallest node.

    Rounds of large and small stars: each node's neighbours are linked to the smallest of them.
    The number of rounds follows the logarithm of the longest path.  A hub is one sum per task
    in the aggregate and a side that adaptive execution splits in the join.
    """
    rows = edges.count()
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "edges", rows,
    )
    while not _done(edges):
        edges = stored(_round(edges), "edges", rows)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
