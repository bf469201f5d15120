"""Polygons as rows, as vertex tables, and compared by shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailscope.functions.geometry import boundary_ends, canonical, geometry_digest


def assemble_polygons(vertices: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Vertex rows ``(*ids, part, ring, i, x, y)`` to one polygon value per id.

    One exchange on ``ids``; the three levels then group in place.
    """
    placed = vertices.repartition(*ids)
    rings = placed.groupBy(*ids, "part", "ring").agg(
        F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("vs")
    )
    bare = F.transform("vs", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    parts = (
        rings.select(*ids, "part", F.struct("ring", bare.alias("vs")).alias("r"))
        .groupBy(*ids, "part")
        .agg(F.array_sort(F.collect_list("r")).alias("rs"))
        .select(*ids, F.struct("part", F.transform("rs", lambda r: r["vs"]).alias("rs")).alias("p"))
    )
    return (
        parts.groupBy(*ids)
        .agg(F.array_sort(F.collect_list("p")).alias("ps"))
        .select(*ids, F.transform("ps", lambda p: p["rs"]).alias("geometry"))
    )


def polygon_vertices(df: DataFrame, ids: Sequence[str], geometry: str = "geometry") -> DataFrame:
    """The inverse: one row per vertex, numbered from 0."""
    return (
        df.select(*ids, F.posexplode(geometry).alias("part", "__rings"))
        .select(*ids, "part", F.posexplode("__rings").alias("ring", "__vs"))
        .select(*ids, "part", "ring", F.posexplode("__vs").alias("i", "__v"))
        .select(*ids, "part", "ring", "i", "__v.x", "__v.y")
    )


def with_shape_key(df: DataFrame, geometry: str) -> DataFrame:
    """``df`` with its canonical shape and a hash of it, to join or group on both.

    The hash goes first, so that most comparisons look at eight bytes.
    """
    # A generator in between keeps a later NULL check from repeating the work.
    shaped = df.select("*", F.explode(F.array(canonical(geometry))).alias("__shape"))
    return shaped.withColumn("__hash", F.xxhash64("__shape"))


SHAPE_KEY = ["__hash", "__shape"]


def outlines(df: DataFrame, geometry: str) -> DataFrame:
    """``(__digest, __hash, __outline)`` of the different polygons of ``df``.

    The outline is what is left of the boundary when inner cuts have vanished: the ends
    of :func:`boundary_ends` added up by place and slope. Ends are added up over all
    tasks, so that one polygon with very many vertices is not one task's work. Polygons
    without area have no outline.
    """
    once = df.select(geometry_digest(geometry).alias("__digest"), geometry).dropDuplicates(["__digest"])
    ends = once.select("__digest", F.explode(boundary_ends(geometry)).alias("e")).select("__digest", "e.*")
    left = ends.groupBy("__digest", "x", "y", "slope").agg(F.sum("weight").alias("weight")).filter("weight <> 0")
    whole = left.groupBy("__digest").agg(
        F.array_sort(F.collect_list(F.struct("x", "y", "slope", "weight"))).alias("__outline")
    )
    return whole.select("__digest", F.xxhash64("__outline").alias("__hash"), "__outline")


def match_equal_areas(
    left: DataFrame, right: DataFrame, *, left_geometry: str, right_geometry: str
) -> DataFrame:
    """Pairs of rows whose polygons cover the same ground, however they are drawn or cut.

    Start vertices, directions, extra vertices on straight lines, the order of holes and
    parts, and cuts into parts do not matter. Different polygons are compared once, by
    :func:`outlines`, and their rows are paired after. Places and slopes are compared
    exactly: a cut across a slanted edge matches if its new vertex is exact. Polygons with
    overlapping parts are not recognised; those without area match nothing. Column names of
    the two sides must differ. Neither side is ever broadcast.
    """
    shapes = outlines(left, left_geometry).withColumnRenamed("__digest", "__left")
    others = outlines(right, right_geometry).withColumnRenamed("__digest", "__right")
    # Polygons are far larger than Spark guesses from the files they come from, so all joins are told to shuffle.
    same = shapes.join(others.hint("merge"), ["__hash", "__outline"]).select("__left", "__right")
    pairs = left.withColumn("__left", geometry_digest(left_geometry)).join(same.hint("merge"), "__left")
    drawn = right.withColumn("__right", geometry_digest(right_geometry))
    return pairs.join(drawn.hint("merge"), "__right").drop("__left", "__right")
