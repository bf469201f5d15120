"""Postcodes to counties and states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailscope.functions.geometry import area_sqmi
from hailscope.operators.spatial_join import points_in_areas


def point_centroid(
    points: DataFrame, by: Sequence[str], lon: str = "LON", lat: str = "LAT"
) -> DataFrame:
    """Centre of each group's set of points: equal points count once."""
    once = points.select(*by, lon, lat).dropna(subset=[lon, lat]).distinct()
    return once.groupBy(*by).agg(F.avg(lon).alias(lon), F.avg(lat).alias(lat))


def address_count(addresses: DataFrame) -> DataFrame:
    """Addresses per postcode and country."""
    return addresses.groupBy("postcode", "country").agg(F.count(F.lit(1)).alias("cnt"))


def _in_country(df: DataFrame, country: str | None) -> DataFrame:
    return df if country is None else df.filter(F.col("country") == country)


def locate_postcodes(
    addresses: DataFrame, division_areas: DataFrame, country: str | None = None
) -> DataFrame:
    """``(postcode, country, county_id, state_code)`` of the county that holds
    each postcode's centre; the smallest id where counties overlap. Postcodes
    whose centre lies in no county yield no row."""
    centres = point_centroid(
        _in_country(addresses, country).filter("postcode IS NOT NULL"), ["postcode", "country"]
    )
    counties = (
        _in_country(division_areas, country)
        .filter(F.col("subtype") == "county")
        .select("id", "region", F.col("country").alias("__country"), "geometry")
    )
    held = points_in_areas(centres, counties, ["id", "region", "__country"])
    best = (
        held.filter(F.col("country") == F.col("__country"))
        .groupBy("postcode", "country")
        .agg(F.min(F.struct("id", "region")).alias("c"))
    )
    return best.select(
        "postcode", "country", F.col("c.id").alias("county_id"), F.col("c.region").alias("state_code")
    )


def build_postcode_areas(
    addresses: DataFrame,
    division_areas: DataFrame,
    country: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Rows for ``postcode_areas``: the county polygon of every postcode."""
    located = locate_postcodes(addresses, division_areas, country)
    polygons = division_areas.filter(F.col("subtype") == "county").select(
        F.col("id").alias("county_id"), F.col("country"), F.col("geometry").alias("area")
    )
    return located.join(polygons, ["county_id", "country"]).select(
        "postcode",
        "country",
        "state_code",
        "area",
        (F.current_timestamp() if now is None else now).alias("created_at"),
    )


def build_state_boundaries(
    divisions: DataFrame,
    division_areas: DataFrame,
    addresses: DataFrame,
    country: str | None = None,
) -> DataFrame:
    """Rows for ``state_boundary``: the polygon of every state that the
    postcodes' first address level names, the smallest id per state."""
    levels = (
        _in_country(addresses, country)
        .filter("postcode IS NOT NULL")
        .select("postcode", "country", F.get("address_levels", F.lit(0))["value"].alias("level"))
        .groupBy("postcode", "country")
        .agg(F.min("level").alias("level"))
    )
    wanted = levels.select(
        "country", F.concat("country", F.lit("-"), "level").alias("region")
    ).distinct()
    states = (
        divisions.filter(F.col("subtype") == "region")
        .join(wanted, ["country", "region"], "left_semi")
        .select(
            F.col("id").alias("division_id"),
            "country",
            F.col("region").alias("state_code"),
            F.col("names.primary").alias("state_name"),
        )
    )
    shapes = division_areas.select("id", "division_id", "geometry")
    first = (
        states.join(shapes.select("id", "division_id"), "division_id")
        .groupBy("country", "state_code")
        .agg(F.min(F.struct("id", "division_id", "state_name")).alias("s"))
        .select("s.id", "s.division_id", "s.state_name", "state_code")
    )
    return first.join(shapes, ["id", "division_id"]).select(
        "id", "state_name", "state_code", "geometry"
    )


def check_county_area(
    postcode_areas: DataFrame, division_areas: DataFrame | None = None
) -> DataFrame:
    """Square miles of every postcode's area; with ``division_areas`` the name
    of the county of equal shape as well."""
    checked = postcode_areas.select(
        "postcode", "country", area_sqmi("area").alias("area_sqmi"), "created_at"
    )
    if division_areas is None:
        return checked
    from hailscope.plans.layers import county_names

    names = county_names(division_areas, postcode_areas, country=None)
    return checked.join(names, ["postcode", "country"], "left")


def states_loaded(states: DataFrame) -> DataFrame:
    return states.select("state_name", "state_code")
