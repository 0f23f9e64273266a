"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pondlens.llm import textops as T


def _is_forest(pairs: DataFrame) -> bool:
    """Whether every child has one parent and no parent is a child: the components are done."""
    ends = (pairs.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent"))
            .unionAll(pairs.select("b", F.lit(0), F.lit(1))))
    bad = (ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
           .where("child > 1 OR (child = 1 AND parent = 1)"))
    return bad.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b): the smallest node it reaches.

    Each round replaces a node's edges by edges to its smallest neighbour, so
    paths shorten by half; minima are partial aggregates and neighbour lists
    are never gathered, so a hub is no hot spot. Nothing but whether it is
    done comes to the driver. Self loops and repeated edges are harmless.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = T.materialize(pairs, "edges")
    while not _is_forest(pairs):
        # large star: larger neighbours move to the smallest one of the neighbourhood
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = T.materialize(large, "edges")
        # small star: smaller neighbours, and the node itself, move to the smallest
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = large.join(low, F.col("a") == F.col("u")).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = low.select(F.col("u").alias("a"), F.col("m").alias("b"))
        pairs = T.materialize(moved.unionByName(own).distinct(), "edges")
    roots = pairs.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
