"""Well-known text in and out, for POINT, POLYGON and MULTIPOLYGON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailscope.functions.geometry import let
from hailscope.operators.shapes import polygon_vertices


def _number(c: Column) -> Column:
    """Plain decimal text: no exponent, no trailing zeros."""
    size = F.abs(c)
    small = c.cast("decimal(38,28)").cast("string")
    large = c.cast("decimal(38,10)").cast("string")
    text = F.when((size >= 1e-3) & (size < 1e7), c.cast("string")).otherwise(
        F.when(size < 1, small).otherwise(large)
    )
    return F.regexp_replace(text, r"\.?0+$", "")


def _pair(v: Column) -> Column:
    return F.concat(_ordinate(v["x"]), F.lit(" "), _ordinate(v["y"]))


def _ordinate(c: Column) -> Column:
    return F.when(c == 0, F.lit("0")).when(c == F.floor(c), c.cast("long").cast("string")).otherwise(
        _number(c)
    )


def point_text(lon: Column | str, lat: Column | str) -> Column:
    """``POINT (x y)``."""
    x = F.col(lon) if isinstance(lon, str) else lon
    y = F.col(lat) if isinstance(lat, str) else lat
    return F.concat(F.lit("POINT ("), _ordinate(x), F.lit(" "), _ordinate(y), F.lit(")"))


def polygon_text(geometry: Column | str) -> Column:
    """``POLYGON (…)``, or ``MULTIPOLYGON (…)`` for several parts."""
    g = F.col(geometry) if isinstance(geometry, str) else geometry

    def ring(r: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(r, _pair), ", "), F.lit(")"))

    def part(p: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")"))

    parts = F.transform(g, part)
    return F.when(F.size(parts) == 1, F.concat(F.lit("POLYGON "), F.get(parts, F.lit(0)))).when(
        F.size(parts) > 1, F.concat(F.lit("MULTIPOLYGON ("), F.array_join(parts, ", "), F.lit(")"))
    )


def _tight(wkt: Column | str) -> Column:
    """No blanks around brackets and commas."""
    c = F.col(wkt) if isinstance(wkt, str) else wkt
    return F.regexp_replace(F.trim(c), r"\s*([(),])\s*", "$1")


def _vertex(text: Column) -> Column:
    def read(xy: Column) -> Column:
        x = F.get(xy, F.lit(0)).try_cast("double")
        y = F.get(xy, F.lit(1)).try_cast("double")
        good = (F.size(xy) == 2) & x.isNotNull() & y.isNotNull()
        return F.when(good, F.struct(x.alias("x"), y.alias("y")))

    return let(F.split(text, r"\s+"), read)


def parse_point(wkt: Column | str) -> Column:
    """The point of a POINT text, else NULL."""
    return _vertex(F.regexp_extract(_tight(wkt), r"(?i)^POINT\(([^()]*)\)$", 1))


def _parts_text(tight: Column) -> Column:
    """The text between ``(((`` and ``)))`` of a multipolygon, a polygon being
    one of one part; empty or NULL for any other text."""
    head = F.upper(F.substring_index(tight, "(", 1))
    one = F.regexp_extract(tight, r"(?s)^[^(]*\(\((.*)\)\)$", 1)
    many = F.regexp_extract(tight, r"(?s)^[^(]*\(\(\((.*)\)\)\)$", 1)
    return F.when(head == "POLYGON", one).when(head == "MULTIPOLYGON", many)


def _sound(ring: Column) -> Column:
    return (
        (F.size(ring) >= 4)
        & ~F.exists(ring, lambda v: v.isNull())
        & (F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1))
    )


def parse_polygon(wkt: Column | str) -> Column:
    """The geometry of a POLYGON or MULTIPOLYGON text, else NULL.

    Every ring must be closed and have four vertices or more.
    """
    geometry = F.transform(
        F.split(let(_tight(wkt), _parts_text), r"\)\),\(\("),
        lambda part: F.transform(
            F.split(part, r"\),\("), lambda ring: F.transform(F.split(ring, ","), _vertex)
        ),
    )
    return let(geometry, lambda g: F.when(F.forall(F.flatten(g), _sound), g))


def ingest_wkt(df: DataFrame, id: str, wkt: str) -> tuple[DataFrame, DataFrame]:
    """Vertex rows of all readable texts, and the rows that cannot be read.

    A POINT becomes one vertex.
    """
    single = let(
        parse_point(wkt), lambda p: F.when(p.isNotNull(), F.array(F.array(F.array(p))))
    )
    # A generator in between keeps the filters below from parsing again.
    shape = F.coalesce(parse_polygon(wkt), single)
    shaped = df.select("*", F.explode(F.array(shape)).alias("__shape"))
    rejects = shaped.filter("__shape IS NULL").select(*df.columns)
    return polygon_vertices(shaped, [id], "__shape"), rejects


def export_wkt(df: DataFrame, geometry: str = "geometry", name: str = "wkt") -> DataFrame:
    """``df`` with its geometry column as text."""
    return df.withColumn(name, polygon_text(geometry)).drop(*([geometry] if name != geometry else []))
