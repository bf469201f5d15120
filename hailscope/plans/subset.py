"""Hail reports by state and by postcode area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailscope.functions.geometry import geometry_digest
from hailscope.operators.sizing import broadcast_within
from hailscope.operators.spatial_join import points_in_areas


def subset_state(hail: DataFrame, states: DataFrame, **join) -> DataFrame:
    """Reports inside a state, with its ``state_code``."""
    return points_in_areas(hail, states, ["state_code"], **join)


def distinct_areas(postcode_areas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The different polygons ``(area_key, area)``, and ``(postcode, country, area_key)``.

    Postcodes of one county share its polygon; points are tested against each
    polygon once however many postcodes use it.
    """
    digest = geometry_digest("area").alias("area_key")
    keyed = postcode_areas.select("postcode", "country", digest, "area")
    return (
        keyed.select("area_key", "area").dropDuplicates(["area_key"]),
        keyed.select("postcode", "country", "area_key"),
    )


def subset_county(hail_state: DataFrame, postcode_areas: DataFrame, **join) -> DataFrame:
    """State reports inside a postcode's area, with that ``postcode`` and ``country``.

    One row per report and postcode. For figures only, see
    :func:`hailscope.plans.risk.risk_comparison_bulk`, which does not build these rows.
    """
    polygons, users = distinct_areas(postcode_areas)
    bare = hail_state.drop("postcode", "state_code")
    inside = points_in_areas(bare, polygons, ["area_key"], geometry="area", **join)
    return inside.join(broadcast_within(users), "area_key").select(*bare.columns, "postcode", "country")


def hail_counts_by_state(hail_state: DataFrame) -> DataFrame:
    return hail_state.groupBy("state_code").agg(F.count(F.lit(1)).alias("state_hail_count"))


def hail_count_by_postcode(hail_county: DataFrame, postcodes: DataFrame) -> DataFrame:
    """Reports per postcode and country; 0 for a postcode without any."""
    counts = hail_county.groupBy("postcode", "country").agg(F.count(F.lit(1)).alias("n"))
    return _counted(postcodes.select("postcode", "country").distinct(), counts, ["postcode", "country"])


def hail_count_bulk(hail_state: DataFrame, postcode_areas: DataFrame, **join) -> DataFrame:
    """The same counts straight from the state reports, per polygon first."""
    polygons, users = distinct_areas(postcode_areas)
    inside = points_in_areas(hail_state.select("LON", "LAT"), polygons, ["area_key"], geometry="area", **join)
    return _counted(users.distinct(), inside.groupBy("area_key").agg(F.count(F.lit(1)).alias("n")), ["area_key"])


def _counted(known: DataFrame, counts: DataFrame, on: list[str]) -> DataFrame:
    filled = F.coalesce("n", F.lit(0)).alias("hail_count")
    return known.join(counts, on, "left").select("postcode", "country", filled)
