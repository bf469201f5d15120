"""Geometry as column expressions over nested vertex arrays.

Everything here is evaluated inside the JVM row by row; no shuffle, no UDF.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sphere radius of EPSG:3857 and mean radius of the earth in metres, square metres per square mile.
WEB_MERCATOR_RADIUS = 6378137.0
SPHERE_RADIUS = 6371008.8
SQUARE_METRES_PER_SQMI = 2589988


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _vertex(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def point(lon: Column | str, lat: Column | str) -> Column:
    """Point value from any castable pair; NULL if a coordinate is not a number."""
    x = _col(lon).try_cast("double")
    y = _col(lat).try_cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), _vertex(x, y))


def map_vertices(geometry: Column | str, fn: Callable[[Column], Column]) -> Column:
    """The geometry with ``fn`` applied to every vertex."""
    return F.transform(
        _col(geometry), lambda part: F.transform(part, lambda ring: F.transform(ring, fn))
    )


def mercator_x(x: Column | str) -> Column:
    return WEB_MERCATOR_RADIUS * F.radians(_col(x))


def mercator_y(y: Column | str) -> Column:
    return WEB_MERCATOR_RADIUS * F.ln(F.tan(F.pi() / 4 + F.radians(_col(y)) / 2))


def to_web_mercator(geometry: Column | str) -> Column:
    """EPSG:4326 degrees to EPSG:3857 metres."""
    return map_vertices(geometry, lambda v: _vertex(mercator_x(v["x"]), mercator_y(v["y"])))


def extent(geometry: Column | str) -> tuple[Column, Column, Column, Column]:
    """West, south, east and north of a geometry; NULL without vertices."""
    vertices = F.flatten(F.flatten(_col(geometry)))
    x, y = F.transform(vertices, lambda v: v["x"]), F.transform(vertices, lambda v: v["y"])
    return F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of a closed ring as ``(x1, y1, x2, y2)``."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, F.lit(1), n),
        F.slice(ring, F.lit(2), n),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def edges(geometry: Column | str) -> Column:
    """All edges of all rings of all parts, as one array."""
    return F.flatten(F.flatten(F.transform(_col(geometry), lambda p: F.transform(p, ring_edges))))


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once.

    A column used twice in an expression is computed twice; a lambda variable
    is not.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _moments(ring: Column, origin: Column) -> Column:
    """Twice the signed area and six times the first moments, about ``origin``."""

    def step(acc: Column, e: Column) -> Column:
        ax, ay = e["x1"] - origin["x"], e["y1"] - origin["y"]
        bx, by = e["x2"] - origin["x"], e["y2"] - origin["y"]
        return let(
            ax * by - bx * ay,
            lambda cross: _sums(
                acc["a"] + cross, acc["mx"] + (ax + bx) * cross, acc["my"] + (ay + by) * cross
            ),
        )

    return F.aggregate(ring_edges(ring), _sums(F.lit(0.0), F.lit(0.0), F.lit(0.0)), step)


def _sums(a: Column, mx: Column, my: Column) -> Column:
    return F.struct(a.alias("a"), mx.alias("mx"), my.alias("my"))


def area(geometry: Column | str) -> Column:
    """Planar area: shells minus holes, summed over the parts."""

    def ring_area(ring: Column, i: Column) -> Column:
        origin = F.get(ring, F.lit(0))
        twice = F.aggregate(
            ring_edges(ring),
            F.lit(0.0),
            lambda acc, e: acc
            + (e["x1"] - origin["x"]) * (e["y2"] - origin["y"])
            - (e["x2"] - origin["x"]) * (e["y1"] - origin["y"]),
        )
        return F.when(i == 0, F.abs(twice) / 2).otherwise(-F.abs(twice) / 2)

    rings = F.flatten(F.transform(_col(geometry), lambda part: F.transform(part, ring_area)))
    return F.aggregate(rings, F.lit(0.0), lambda acc, a: acc + a)


def sphere_area(geometry: Column | str) -> Column:
    """Area in square metres of a polygon in degrees whose edges are great circles on a sphere.

    Each edge spans a four-sided figure with the equator, whose spherical excess follows from
    the two ends; over a closed ring the excesses add up to the ring's own. Edges go
    the shorter way round, so rings across the 180th meridian are right; rings
    around a pole are not.
    """

    def excess(acc: Column, e: Column) -> Column:
        turn = F.radians(e["x2"] - e["x1"])
        short = turn - 2 * F.pi() * F.round(turn / (2 * F.pi()))
        mean, half = F.radians(e["y1"] + e["y2"]) / 2, F.radians(e["y1"] - e["y2"]) / 2
        return acc + 2 * F.atan(F.tan(short / 2) * F.sin(mean) / F.cos(half))

    def ring_area(ring: Column, i: Column) -> Column:
        whole = F.abs(F.aggregate(ring_edges(ring), F.lit(0.0), excess))
        return F.when(i == 0, whole).otherwise(-whole)

    rings = F.flatten(F.transform(_col(geometry), lambda part: F.transform(part, ring_area)))
    return F.aggregate(rings, F.lit(0.0), lambda acc, a: acc + a) * SPHERE_RADIUS**2


def area_sqmi(geometry: Column | str, method: str = "mercator") -> Column:
    """Area in square miles.

    ``mercator`` inflates area by 1/cos²(latitude), about 1.5 times at 35°N. All
    published densities rest on this figure, so it is the default. ``sphere``
    gives the true area on a sphere, see :func:`sphere_area`.
    """
    if method == "sphere":
        return sphere_area(geometry) / SQUARE_METRES_PER_SQMI
    if method != "mercator":
        raise ValueError(f"method must be mercator or sphere, not {method!r}")
    return area(to_web_mercator(geometry)) / SQUARE_METRES_PER_SQMI


def centroid(geometry: Column | str) -> Column:
    """Area-weighted centre as ``(x, y)``; NULL for a geometry without area."""
    g = _col(geometry)

    def about(origin: Column) -> Column:
        rings = F.flatten(
            F.transform(
                g,
                lambda part: F.transform(
                    F.transform(part, lambda ring: _moments(ring, origin)), oriented
                ),
            )
        )
        total = F.aggregate(
            rings,
            _sums(F.lit(0.0), F.lit(0.0), F.lit(0.0)),
            lambda acc, m: _sums(acc["a"] + m["a"], acc["mx"] + m["mx"], acc["my"] + m["my"]),
        )
        return let(
            total,
            lambda t: F.when(
                t["a"] != 0,
                _vertex(
                    origin["x"] + t["mx"] / F.nullif(3 * t["a"], F.lit(0.0)),
                    origin["y"] + t["my"] / F.nullif(3 * t["a"], F.lit(0.0)),
                ),
            ),
        )

    def oriented(m: Column, i: Column) -> Column:
        # Shells count up and holes down, whichever way they are drawn.
        keeps = (m["a"] >= 0) == (i == 0)
        return F.when(keeps, m).otherwise(_sums(-m["a"], -m["mx"], -m["my"]))

    return let(F.get(F.get(F.get(g, F.lit(0)), F.lit(0)), F.lit(0)), about)


def crosses(e: Column, x: Column, y: Column) -> Column:
    """Does the ray from ``(x, y)`` towards +x cross the edge?"""
    at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
    return ((e["y1"] > y) != (e["y2"] > y)) & (x < at)


def touches(e: Column, x: Column, y: Column) -> Column:
    """Does the point lie on the closed edge? Exact in doubles, no tolerance."""
    return (
        x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        & ((e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"]))
    )


def contains(geometry: Column | str, lon: Column | str, lat: Column | str) -> Column:
    """Is the point strictly inside? Boundaries and holes do not count.

    One polygon against one point, edge by edge. For a join between many of
    both use :func:`hailscope.operators.spatial_join.points_in_areas`.
    """
    x, y = _col(lon), _col(lat)

    def inside(e: Column) -> Column:
        odd = F.aggregate(e, F.lit(False), lambda odd, s: odd != crosses(s, x, y))
        return odd & ~F.exists(e, lambda s: touches(s, x, y))

    return let(edges(geometry), inside)


# -- shape equality ---------------------------------------------------------


def _canonical_ring(ring: Column) -> Column:
    """Open ring without repeated or collinear vertices, counter-clockwise from
    its smallest vertex."""
    # Adding 0.0 turns -0.0 into 0.0.
    clean = F.transform(ring, lambda v: _vertex(v["x"] + F.lit(0.0), v["y"] + F.lit(0.0)))
    opened = let(let(clean, _drop_repeats), _open)
    return let(let(let(opened, _drop_collinear), _counter_clockwise), _start_at_smallest)


def _drop_repeats(ring: Column) -> Column:
    return F.filter(ring, lambda v, i: (i == 0) | (v != F.get(ring, i - 1)))


def _open(ring: Column) -> Column:
    return F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))


def _drop_collinear(ring: Column) -> Column:
    n = F.size(ring)

    def bends(v: Column, before: Column, after: Column) -> Column:
        return (v["x"] - before["x"]) * (after["y"] - v["y"]) != (v["y"] - before["y"]) * (
            after["x"] - v["x"]
        )

    return F.filter(ring, lambda v, i: bends(v, F.get(ring, (i - 1 + n) % n), F.get(ring, (i + 1) % n)))


def _counter_clockwise(opened: Column) -> Column:
    n = F.size(opened)
    cross = F.transform(
        opened,
        lambda v, i: let(F.get(opened, (i + 1) % n), lambda w: v["x"] * w["y"] - w["x"] * v["y"]),
    )
    twice_area = F.aggregate(cross, F.lit(0.0), lambda acc, c: acc + c)
    return F.when(twice_area >= 0, opened).otherwise(F.reverse(opened))


def _start_at_smallest(ring: Column) -> Column:
    at = F.array_position(ring, F.array_min(ring)).cast("int")

    def turned(at: Column) -> Column:
        return F.concat(
            F.slice(ring, at, F.size(ring) - at + 1), F.slice(ring, F.lit(1), at - 1)
        )

    return let(at, lambda at: F.when(at > 1, turned(at)).otherwise(ring))


def canonical(geometry: Column | str) -> Column:
    """One value per shape: start vertex, direction, extra collinear vertices
    and the order of holes and parts do not matter."""

    def sort_holes(rings: Column) -> Column:
        holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
        return F.concat(F.slice(rings, F.lit(1), F.lit(1)), F.sort_array(holes))

    parts = F.transform(
        _col(geometry), lambda part: let(F.transform(part, _canonical_ring), sort_holes)
    )
    return F.sort_array(parts)


def boundary_ends(geometry: Column | str) -> Column:
    """The boundary as an array of edge ends ``(x, y, slope, weight)``, which may be added up.

    Shells run anticlockwise, holes clockwise. An edge weighs 1 where it starts and -1
    where it ends. Summed per place and slope, what two edges have in common in
    opposite directions vanishes, whether they share their ends or only overlap, and so
    does a vertex within a straight line. What is left depends on the ground covered alone,
    as long as parts do not overlap.
    """

    def ends(e: Column, way: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        slope = F.when(dx == 0, F.lit(float("inf"))).otherwise(dy / dx + 0.0).alias("slope")

        def end(n: int, weight: Column) -> Column:
            return F.struct((e[f"x{n}"] + 0.0).alias("x"), (e[f"y{n}"] + 0.0).alias("y"), slope, weight.alias("weight"))

        return F.array(end(1, way), end(2, -way))

    def ring(vertices: Column, i: Column) -> Column:
        real = F.filter(ring_edges(vertices), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
        turn = F.signum(_moments(vertices, F.get(vertices, F.lit(0)))["a"]).cast("int")
        way = F.when(i == 0, turn).otherwise(-turn)
        return let(way, lambda w: F.flatten(F.transform(real, lambda e: ends(e, w))))

    return F.flatten(F.flatten(F.transform(_col(geometry), lambda part: F.transform(part, ring))))


def geometry_digest(geometry: Column | str) -> Column:
    """256-bit digest of the vertices as stored; a short stand-in for the value."""
    return F.sha2(_col(geometry).cast("string"), 256)
