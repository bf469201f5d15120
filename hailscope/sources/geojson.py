"""Map layers as GeoJSON."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailscope.functions.geometry import extent


def prepare_layer(df: DataFrame) -> DataFrame:
    """Numeric LON, LAT and MAXSIZE and a textual timestamp, where present."""
    casts = {c: "double" for c in ("LON", "LAT", "MAXSIZE")} | {"timestamp": "string"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})


def _polygon(geometry: Column) -> Column:
    coordinates = F.transform(
        geometry,
        lambda part: F.transform(
            part, lambda ring: F.transform(ring, lambda v: F.array(v["x"], v["y"]))
        ),
    )
    return F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates"))


def _point(lon: str, lat: str) -> Column:
    xy = F.array(F.col(lon).cast("double"), F.col(lat).cast("double"))
    return F.struct(F.lit("Point").alias("type"), xy.alias("coordinates"))


def _shape(df: DataFrame) -> tuple[Column, list[str]]:
    """The GeoJSON shape of a row, NULL if it has none, and the columns it is made of."""
    if "geometry" in df.columns:
        return F.when(F.size("geometry") > 0, _polygon(F.col("geometry"))), ["geometry"]
    used = ["LON", "LAT"] if "LON" in df.columns else ["lon", "lat"]
    known = F.col(used[0]).isNotNull() & F.col(used[1]).isNotNull()
    return F.when(known, _point(*used)), used


def features(df: DataFrame) -> DataFrame:
    """One GeoJSON feature per row in column ``value``.

    The shape comes from ``geometry``, else from LON/LAT or lon/lat, and is null in a row
    without; the other columns become properties.
    """
    df = prepare_layer(df)
    return df.select(_feature(df))


def _feature(df: DataFrame) -> Column:
    shape, used = _shape(df)
    rest = [c for c in df.columns if c not in used]
    properties = F.struct(*rest) if rest else F.create_map().cast("map<string,string>")
    feature = F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), properties.alias("properties"))
    return F.to_json(feature, {"ignoreNullFields": "false"}).alias("value")


#: Finest zoom of the tiles that features are stored by; at zoom z the world has 2**z columns and rows.
MAX_ZOOM = 8
#: Zoom of the curve that features follow within a file.
SORT_ZOOM = 16
#: Layer that features without a shape go to, with their own layer's name.
REJECTS = "rejects"
_TILE = ["layer", "zoom", "tile"]


def _cell(degrees: Column, low: float, span: float, zoom: int) -> Column:
    """Column or row of a place at a zoom; places beyond the world are in its outer cells."""
    last = (1 << zoom) - 1
    cell = F.floor((degrees - low) / span * (1 << zoom))
    return F.least(F.greatest(cell, F.lit(0)), F.lit(last)).cast("long")


def _x_cell(lon: Column, zoom: int) -> Column:
    return _cell(lon, -180.0, 360.0, zoom)


def _y_cell(lat: Column, zoom: int) -> Column:
    return _cell(lat, -90.0, 180.0, zoom)


def _interleave(column: Column, row: Column, bits: int) -> Column:
    """Number of a cell along the Z-shaped curve: bits of column and row in turn."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        out = out + F.shiftleft(F.shiftright(column, b).bitwiseAND(F.lit(1)), 2 * b)
        out = out + F.shiftleft(F.shiftright(row, b).bitwiseAND(F.lit(1)), 2 * b + 1)
    return out


def _separate(tile: Column, odd: int) -> Column:
    """The column (0) or row (1) of a tile's number."""
    out = F.lit(0).cast("long")
    for b in range(MAX_ZOOM):
        out = out + F.shiftleft(F.shiftright(tile, 2 * b + odd).bitwiseAND(F.lit(1)), b)
    return out


def _extent(df: DataFrame) -> tuple[Column, Column, Column, Column]:
    """West, south, east and north of a row's shape."""
    if "geometry" not in df.columns:
        x, y = (F.col(c).cast("double") for c in _shape(df)[1])
        return x, y, x, y
    return extent("geometry")


def _placed(df: DataFrame, name: str) -> DataFrame:
    """``value, layer, zoom, tile, place`` of every row.

    The tile is the smallest one that holds the whole shape, so a shape is stored once,
    however many small tiles it crosses. ``place`` numbers its middle along a curve.
    """
    df = prepare_layer(df)
    west, south, east, north = _extent(df)
    shape, _ = _shape(df)
    boxed = df.select(
        _feature(df), shape.isNotNull().alias("shaped"), west.alias("w"), south.alias("s"), east.alias("e"), north.alias("n")
    )
    cells = {
        "c1": _x_cell(F.col("w"), MAX_ZOOM), "c2": _x_cell(F.col("e"), MAX_ZOOM),
        "r1": _y_cell(F.col("s"), MAX_ZOOM), "r2": _y_cell(F.col("n"), MAX_ZOOM),
    }
    differ = F.col("c1").bitwiseXOR(F.col("c2")).bitwiseOR(F.col("r1").bitwiseXOR(F.col("r2")))
    up = F.when(differ > 0, F.length(F.bin(differ))).otherwise(0)
    scale = F.pow(F.lit(2), F.col("up"))
    tile = _interleave(F.floor(F.col("c1") / scale), F.floor(F.col("r1") / scale), MAX_ZOOM)
    middle = [(F.col(a) + F.col(b)) / 2 for a, b in (("w", "e"), ("s", "n"))]
    place = _interleave(_x_cell(middle[0], SORT_ZOOM), _y_cell(middle[1], SORT_ZOOM), SORT_ZOOM)
    found = boxed.withColumns(cells).withColumn("up", up)
    # A row without a shape tells its layer, in front.
    rejected = F.concat(F.lit(f'{{"layer":{json.dumps(name)},'), F.substring("value", 2, 1 << 30))
    return found.select(
        F.when(F.col("shaped"), F.col("value")).otherwise(rejected).alias("value"),
        F.when(F.col("shaped"), F.lit(name)).otherwise(F.lit(REJECTS)).alias("layer"),
        F.when(F.col("shaped"), MAX_ZOOM - F.col("up")).otherwise(0).cast("int").alias("zoom"),
        F.when(F.col("shaped"), tile).otherwise(0).cast("long").alias("tile"),
        place.alias("place"),
    )


def write_layers(layers: Mapping[str, DataFrame], path: str) -> None:
    """Layers as files of GeoJSON features, one per line, in folders by layer, zoom and tile *(action)*.

    Features are clustered by tile and lie along a space-filling curve within a file;
    a crowded tile is split over tasks and files. Rows without a shape go to the layer
    ``rejects``, with the name of their own. Executors write; an earlier export is
    replaced. :func:`read_layer` reads only the tiles that a map shows.
    """
    if REJECTS in layers:
        raise ValueError(f"{REJECTS!r} is the layer of rows without a shape")
    tagged = reduce(DataFrame.unionByName, [_placed(df, name) for name, df in layers.items()])
    clustered = tagged.hint("rebalance", *_TILE).sortWithinPartitions(*_TILE, "place").drop("place")
    clustered.write.mode("overwrite").partitionBy(*_TILE).text(path)


Box = tuple[float, float, float, float]


def read_layer(spark: SparkSession, path: str, layer: str, box: Box | None = None) -> DataFrame:
    """``(layer, geometry, LON, LAT, properties)`` of a stored layer.

    Polygons are in ``geometry``, points in ``LON`` and ``LAT``; properties are texts. With
    ``box`` (west, south, east, north) only features whose extent meets it, and only
    files of tiles that meet it are read.
    """
    stored = spark.read.schema("value string, layer string, zoom int, tile long").text(path)
    rows = stored.filter(F.col("layer") == layer)
    if box is not None:
        rows = rows.filter(_tile_meets(box))
    typed = F.from_json("value", "geometry struct<type string, coordinates string>, properties map<string,string>")
    coordinates = F.col("f.geometry.coordinates")
    polygon = F.from_json(coordinates, "array<array<array<array<double>>>>")
    geometry = F.transform(
        polygon,
        lambda part: F.transform(
            part, lambda ring: F.transform(ring, lambda v: F.struct(v[0].alias("x"), v[1].alias("y")))
        ),
    )
    xy = F.from_json(coordinates, "array<double>")
    is_point = F.col("f.geometry.type") == "Point"
    out = rows.select("layer", typed.alias("f")).select(
        "layer",
        F.when(~is_point, geometry).alias("geometry"),
        F.when(is_point, xy[0]).alias("LON"),
        F.when(is_point, xy[1]).alias("LAT"),
        F.col("f.properties").alias("properties"),
    )
    return out if box is None else out.filter(_shape_meets(box))


def _tile_meets(box: Box) -> Column:
    """Whether a stored tile meets the box; about partition columns alone, so that files are pruned."""
    west, south, east, north = (F.lit(float(v)) for v in box)
    wanted = F.lit(False)
    column, row = _separate(F.col("tile"), 0), _separate(F.col("tile"), 1)
    for z in range(MAX_ZOOM + 1):
        across = column.between(_x_cell(west, z), _x_cell(east, z))
        wanted = wanted | ((F.col("zoom") == z) & across & row.between(_y_cell(south, z), _y_cell(north, z)))
    return wanted


def _shape_meets(box: Box) -> Column:
    west, south, east, north = box
    left, low, right, high = extent("geometry")
    inside = F.col("LON").between(west, east) & F.col("LAT").between(south, north)
    return F.coalesce(inside, (left <= east) & (right >= west) & (low <= north) & (high >= south))
