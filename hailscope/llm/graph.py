"""Connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailscope.llm.common import stage


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; the root is the smallest node reachable.

    Alternating large and small stars: in each round every node hands the smallest
    neighbour it knows to its other neighbours, first to the larger, then to the
    smaller ones, until all edges point at roots. Hubs are met by joins with a
    one-row-per-node side and by minima with partial aggregation, never by
    gathering neighbours. Each round is staged, so lineage stays short.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(edges.distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stage(large.filter("a <> b").distinct(), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(low.withColumnRenamed("low", "b")).filter("a <> b")
        edges = stage(small.distinct(), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
