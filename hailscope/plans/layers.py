"""The worst hail day as map layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailscope.functions.geometry import centroid, geometry_digest
from hailscope.functions.measurements import measured
from hailscope.operators.dedup import first_per_key
from hailscope.operators.shapes import SHAPE_KEY, with_shape_key
from hailscope.operators.spatial_join import points_in_areas
from hailscope.plans.risk import one_per_state, state_of
from hailscope.plans.subset import distinct_areas


POSTCODE = ["postcode", "country"]


def _days(hail: DataFrame, *by: str) -> DataFrame:
    return hail.groupBy(*by, F.to_date("ZTIME").alias("date")).agg(
        F.count(F.lit(1)).alias("event_count"), F.max(measured("MAXSIZE")).alias("max_size")
    )


def _worst(days: DataFrame, *by: str) -> DataFrame:
    order = [F.desc_nulls_last("max_size"), F.desc("event_count"), F.asc("date")]
    return first_per_key(days, by, order)


def worst_day(hail_county: DataFrame) -> DataFrame:
    """Per postcode the day with the largest hail, then most reports, then first."""
    return _worst(_days(hail_county, *POSTCODE), *POSTCODE)


def worst_day_bulk(hail_state: DataFrame, postcode_areas: DataFrame, **join) -> DataFrame:
    """The same days straight from the state reports.

    Days are ranked per different polygon; its one worst day is then handed to the
    postcodes that use it. No row per report and postcode arises.
    """
    polygons, users = distinct_areas(postcode_areas)
    reports = hail_state.select("LON", "LAT", "ZTIME", "MAXSIZE")
    inside = points_in_areas(reports, polygons, ["area_key"], geometry="area", **join)
    worst = _worst(_days(inside, "area_key"), "area_key")
    handed = users.join(worst, "area_key").drop("area_key")
    return _worst(handed, *POSTCODE)


def worst_day_states(worst: DataFrame, postcode_areas: DataFrame, states: DataFrame) -> DataFrame:
    """``(postcode, country, state_code, date)``: which rows of the worst-day layer a postcode shows."""
    held = state_of(postcode_areas, states).select(*POSTCODE, "state_code").distinct()
    return worst.select(*POSTCODE, "date").join(held, POSTCODE).select(*POSTCODE, "state_code", "date")


def worst_day_layer(
    hail_state: DataFrame, worst: DataFrame, postcode_areas: DataFrame, states: DataFrame
) -> DataFrame:
    """All hail of every (state, day) that is some postcode's worst day there, times as text.

    Each report is one row however many postcodes share its state and day;
    :func:`worst_day_states` says which rows belong to a postcode.
    """
    asked = worst_day_states(worst, postcode_areas, states).select("state_code", "date").distinct()
    hail = hail_state.select(
        "state_code", "ZTIME", "LON", "LAT", "MAXSIZE", "SEVPROB", "PROB",
        F.to_date("ZTIME").alias("date"),
    )
    return hail.join(asked, ["state_code", "date"], "left_semi").select(
        "state_code",
        F.col("ZTIME").cast("string").alias("ZTIME"),
        "LON",
        "LAT",
        "MAXSIZE",
        "SEVPROB",
        "PROB",
        F.col("date").cast("string").alias("date"),
    )


def counties_layer(
    division_areas: DataFrame, state_codes: str | Sequence[str] | None = None
) -> DataFrame:
    """Polygons and names of the counties of one state, several, or all."""
    counties = division_areas.filter(F.col("subtype") == "county")
    if state_codes is not None:
        codes = [state_codes] if isinstance(state_codes, str) else list(state_codes)
        counties = counties.filter(F.col("region").isin(codes))
    return counties.select("geometry", F.col("names.primary").alias("county_name"))


def county_names(
    division_areas: DataFrame, postcode_areas: DataFrame, country: str | None = "US"
) -> DataFrame:
    """``(postcode, country, county_name)`` by equal shape; first name on a tie."""
    counties = division_areas.filter(F.col("subtype") == "county")
    if country is not None:
        counties = counties.filter(F.col("country") == country)
    named = counties.select(F.col("names.primary").alias("county_name"), "geometry")
    name_of = with_shape_key(named, "geometry").groupBy(*SHAPE_KEY).agg(
        F.min("county_name").alias("county_name")
    )
    keyed = postcode_areas.select(
        "postcode", "country", geometry_digest("area").alias("area_key"), "area"
    )
    shapes = keyed.select("area_key", "area").dropDuplicates(["area_key"])
    matched = with_shape_key(shapes, "area").join(name_of, SHAPE_KEY)
    return keyed.select("postcode", "country", "area_key").join(
        matched.select("area_key", "county_name"), "area_key"
    ).drop("area_key")


def county_label(
    division_areas: DataFrame, postcode_areas: DataFrame, country: str | None = "US"
) -> DataFrame:
    """A label per postcode: the county's name, else ``County (postcode)``."""
    names = county_names(division_areas, postcode_areas, country)
    return (
        postcode_areas.select("postcode", "country")
        .join(names, ["postcode", "country"], "left")
        .select(
            "postcode",
            "country",
            F.coalesce("county_name", F.format_string("County (%s)", "postcode")).alias("label"),
        )
    )


def selected_county_layer(
    postcode_areas: DataFrame, postcodes: str | Sequence[str] | None = None
) -> DataFrame:
    """The postcodes' own areas, flagged as selected."""
    chosen = postcode_areas
    if postcodes is not None:
        names = [postcodes] if isinstance(postcodes, str) else list(postcodes)
        chosen = chosen.filter(F.col("postcode").isin(names))
    return chosen.select(F.col("area").alias("geometry"), "postcode", F.lit(1).alias("selected"))


def map_center(states: DataFrame) -> DataFrame:
    """``(state_code, lon, lat)``: where to centre the map of a state."""
    return states.select("state_code", centroid("geometry").alias("c")).select(
        "state_code", F.col("c.x").alias("lon"), F.col("c.y").alias("lat")
    )


def map_layers(
    hail_state: DataFrame,
    worst: DataFrame,
    division_areas: DataFrame,
    postcode_areas: DataFrame,
    states: DataFrame,
) -> Mapping[str, DataFrame]:
    """The layers of the worst-day map, ready for ``write_layers``.

    Counties and centres are those of the states of ``postcode_areas`` only.
    """
    states = one_per_state(states)
    shown = state_of(postcode_areas, states).select("state_code").distinct()
    counties = division_areas.join(
        shown.withColumnRenamed("state_code", "region"), "region", "left_semi"
    )
    return {
        "selected_county": selected_county_layer(postcode_areas),
        "hail": worst_day_layer(hail_state, worst, postcode_areas, states),
        "counties": counties_layer(counties),
        "map_center": map_center(states.join(shown, "state_code", "left_semi")),
    }
