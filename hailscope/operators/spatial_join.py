"""Points in polygons as an equi-join on grid tiles.

The plane is cut in square tiles. Every polygon becomes one index row for each
tile it can contain points of. The row holds the edges that touch the tile and
one parity; a tile no edge touches lies wholly inside and its points need no
test. Points find their tile by arithmetic and join on it, without a shuffle
after the join.

The test in a tile follows a bent path: from far below straight up the line
through the tile's right side to the point's latitude, then left to the point.
An odd number of crossings means inside. Edges that do not touch the tile meet
this path equally often for all its points, which is the stored parity; so each
point looks at the tile's own edges only. Along the upright leg an edge is
crossed once for each of its ends that lies to the right of the line and not
above the point: two edges share every vertex, so counting ends in this way
cancels out over a closed ring, and no new coordinate is ever computed. The
result equals the edge-by-edge test, also on vertices, for holes and for
multipolygons.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailscope.functions.geometry import crosses, edges, geometry_digest, touches
from hailscope.operators.sizing import BROADCAST_BYTES, broadcast_within, stage_measured
from hailscope.sources.staging import stage

TILE = ["__band", "__column"]
CELL = 0.0625
POINTS_PER_TASK = 4_000_000


def _check_cell(cell: float) -> None:
    if not (cell > 0 and math.frexp(cell)[0] == 0.5):
        raise ValueError(f"cell must be a power of two so that tile bounds are exact, not {cell!r}")


def _tile(c: Column, cell: float) -> Column:
    return F.floor(c / F.lit(cell))


def _odd(edge_list: Column, x: Column, y: Column, start: Column) -> Column:
    """Parity of the bent path's crossings; ``up1``/``up2`` are the latitudes of
    edge ends right of the tile, infinite for other ends."""
    return F.aggregate(
        edge_list,
        start,
        lambda odd, e: (odd != crosses(e, x, y)) != ((y >= e["up1"]) != (y >= e["up2"])),
    )


def area_index(
    areas: DataFrame, keep: Sequence[str], *, geometry: str = "geometry", cell: float = CELL
) -> DataFrame:
    """Index rows ``(*keep, __band, __column, __odd, __edges)``.

    Rows of ``areas`` that agree in ``keep`` and in geometry are indexed once
    and repeated at the end, so a join still returns one pair for each. No list
    is longer than the edges of one polygon in one tile, or those that cross
    one horizontal line.
    """
    _check_cell(cell)
    pad = cell * 1e-6  # far more than rounding, so that no touching edge is missed
    whole = (
        areas.groupBy(*keep, geometry)
        .agg(F.count(F.lit(1)).cast("int").alias("__copies"))
        .withColumn("__shape", geometry_digest(geometry))
    )
    ids = [*keep, "__copies", "__shape"]
    edge = whole.select(*ids, F.explode(edges(geometry)).alias("e")).select(
        *ids, F.col("e.x1"), F.col("e.y1"), F.col("e.x2"), F.col("e.y2")
    )
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    left, right = F.least(x1, x2), F.greatest(x1, x2)
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    band, column = F.col("__band"), F.col("__column")
    slices = edge.withColumn(
        "__band", F.explode(F.sequence(_tile(low - pad, cell), _tile(high + pad, cell)))
    )

    def x_at(y: Column) -> Column:
        return (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1

    # Columns between the points where the edge enters and leaves the band; the
    # whole width of a level edge.
    enter = x_at(F.greatest(low, band * cell - pad))
    leave = x_at(F.least(high, (band + 1) * cell + pad))
    start = F.greatest(left, F.coalesce(F.least(enter, leave), left))
    stop = F.least(right, F.coalesce(F.greatest(enter, leave), right))
    limit = (column + 1) * cell
    never = F.lit(float("inf"))
    touching = slices.withColumn(
        "__column", F.explode(F.sequence(_tile(start - pad, cell), _tile(stop + pad, cell)))
    ).select(
        *ids,
        *TILE,
        F.struct(
            x1.alias("x1"),
            y1.alias("y1"),
            x2.alias("x2"),
            y2.alias("y2"),
            F.when(x1 >= limit, y1).otherwise(never).alias("up1"),
            F.when(x2 >= limit, y2).otherwise(never).alias("up2"),
        ).alias("e"),
        F.lit(False).alias("middle"),
    )

    # Tiles whose middle is inside: runs between every other crossing of the
    # band's middle line, each crossing given as the last column left of it.
    line = (band + 0.5) * cell
    runs = (
        slices.filter((y1 > line) != (y2 > line))
        .select(*ids, "__band", (F.ceil(x_at(line) / cell - 0.5) - 1).alias("at"))
        .groupBy(*ids, "__band")
        .agg(F.sort_array(F.collect_list("at")).alias("ats"))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ats") - 1, F.lit(2))))
        .select(
            *ids, "__band", (F.get("ats", F.col("k") - 1) + 1).alias("a"), F.get("ats", "k").alias("b")
        )
        .filter("a <= b")
        .select(*ids, "__band", F.explode(F.sequence("a", "b")).alias("__column"))
    )
    filled = runs.select(
        *ids, *TILE, F.lit(None).cast(touching.schema["e"].dataType).alias("e"),
        F.lit(True).alias("middle"),
    )
    tiles = touching.unionByName(filled).groupBy(*ids, *TILE).agg(
        F.collect_list("e").alias("__edges"), F.max("middle").alias("middle")
    )
    centre = ((column + 0.5) * cell, (band + 0.5) * cell)
    return tiles.select(
        *keep,
        *TILE,
        _odd(F.col("__edges"), *centre, F.col("middle")).alias("__odd"),
        "__edges",
        F.explode(F.sequence(F.lit(1), F.col("__copies"))),
    ).drop("col")


def points_in_areas(
    points: DataFrame,
    areas: DataFrame,
    keep: Sequence[str],
    *,
    lon: str = "LON",
    lat: str = "LAT",
    geometry: str = "geometry",
    cell: float = CELL,
    broadcast_bytes: int = BROADCAST_BYTES,
    points_per_task: int = POINTS_PER_TASK,
    how: str = "inner",
) -> DataFrame:
    """Every (point, area) pair where the point is strictly inside.

    Returns the point's columns and the area's ``keep`` columns. The index is
    staged and measured first *(action on areas)*: up to ``broadcast_bytes`` it
    is sent to every executor and points are not shuffled. Above that both sides
    shuffle on the tile, and tiles with more than ``points_per_task`` points are
    split over several tasks; the points are then read twice, so stage them if they
    are costly to compute.

    ``how="left"`` also returns every point that lies in no area, once, with NULL in
    ``keep``; points without a place are among them. A point meets all index rows of its
    tile in one task on either way, so the test is the join's own condition and no
    second pass looks for points left over.

    ``cell`` (degrees, a power of two) trades index rows against edges per tile:
    smaller suits outlines with many vertices, larger suits very wide polygons.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    index, size = stage_measured(
        area_index(areas, keep, geometry=geometry, cell=cell), "area-index"
    )
    x, y, near = F.col(lon), F.col(lat), F.col("__edges")
    known = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    if how == "inner":
        points, known = points.filter(known), F.lit(True)
    tile = {"__band": _tile(y, cell), "__column": _tile(x, cell)}
    placed = points.withColumns({c: F.when(known, t) for c, t in tile.items()})
    on = TILE
    if size > broadcast_bytes:
        placed, index = _split_tiles(placed, index, points_per_task)
        on = [*TILE, "__share"]
    else:
        index = F.broadcast(index)

    index = index.withColumnsRenamed({c: f"{c}_of" for c in on})
    same = reduce(and_, [F.col(c) == F.col(f"{c}_of") for c in on])
    # A tile without edges is in the index only because it lies inside.
    tested = _odd(near, x, y, F.col("__odd")) & ~F.exists(near, lambda e: touches(e, x, y))
    return placed.join(index, same & ((F.size(near) == 0) | tested), how).select(*points.columns, *keep)


def _split_tiles(
    placed: DataFrame, index: DataFrame, points_per_task: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__share``, crowded tiles cut in shares.

    A crowded tile's index rows are repeated once per share; its points take a
    share by the task that read them, which spreads even identical points and
    stays the same when a task is run again. Points without a place are spread
    likewise. The table of crowded tiles has at most (points / points_per_task)
    rows; it is broadcast if it measures little enough.
    """
    crowded = (
        placed.groupBy(*TILE)
        .count()
        .filter((F.col("count") > points_per_task) & F.col("__band").isNotNull())
        .select(*TILE, F.ceil(F.col("count") / points_per_task).cast("int").alias("__shares"))
    )
    crowded = broadcast_within(stage(crowded, "crowded-tiles"))
    shares = F.coalesce("__shares", F.lit(1))
    task = F.spark_partition_id()
    share = F.when(F.col("__band").isNull(), task).otherwise(F.pmod(task, shares))
    spread_points = placed.join(crowded, TILE, "left").withColumn("__share", share).drop("__shares")
    spread_index = (
        index.join(crowded, TILE, "left")
        .withColumn("__share", F.explode(F.sequence(F.lit(0), shares - 1)))
        .drop("__shares")
    )
    return spread_points, spread_index.hint("merge")
