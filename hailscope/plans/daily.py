"""Risk figures from stored sums per day and area, brought up to date by month."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailscope.functions.dates import month_number
from hailscope.operators.spatial_join import points_in_areas
from hailscope.plans.risk import WINDOW_DAYS, add_up, compare_areas, figures, one_per_state, partials
from hailscope.plans.subset import distinct_areas
from hailscope.schemas import HAIL_DAILY, MONTH_COLUMN
from hailscope.sources.generations import replace_partitions
from hailscope.sources.staging import stage

POLYGON, STATE = "polygon", "state"
REPORT = ["LON", "LAT", "ZTIME", "MAXSIZE", "SEVPROB", "PROB"]


def daily_partials(hail_state: DataFrame, postcode_areas: DataFrame, **join) -> DataFrame:
    """Sums and counts per area and day, in the layout of ``hail_daily`` with its month.

    An area is a state (``area`` its code) or one of the different polygons of
    ``postcode_areas`` (``area`` its digest). A day has one row per area with hail,
    however many reports there are, and these rows add up to any window of days.
    """
    polygons, _ = distinct_areas(postcode_areas)
    inside = points_in_areas(hail_state.select(*REPORT), polygons, ["area_key"], geometry="area", **join)
    day = F.to_date("ZTIME").alias("day")

    def rows(reports: DataFrame, kind: str, area: str) -> DataFrame:
        return partials(reports.withColumn("area", F.col(area)), "area", day).withColumn("kind", F.lit(kind))

    both = rows(inside, POLYGON, "area_key").unionByName(rows(hail_state, STATE, "state_code"))
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in HAIL_DAILY.fields]
    return both.select(*typed, month_number(F.col("day").cast("timestamp")).alias(MONTH_COLUMN))


def replace_months(daily: DataFrame, fresh: DataFrame, months: Iterable[int]) -> DataFrame:
    """``daily`` with ``months`` taken from ``fresh``, which may have no rows of them."""
    return daily.filter(~F.col(MONTH_COLUMN).isin(list(months))).unionByName(fresh)


def refresh_daily(spark: SparkSession, db: str, months: Iterable[int] | None = None) -> list[int]:
    """Bring ``hail_daily`` up to date in the months whose reports have changed *(action)*.

    Only these months of ``hail_state`` are read, and only these partitions written;
    each is switched when it is complete. Without ``months`` all are done, which is
    needed when areas have changed. Returns the months done.
    """
    hail = spark.table(f"{db}.hail_state")
    if months is None:
        stored = [spark.table(f"{db}.{t}").select(MONTH_COLUMN) for t in ("hail_state", "hail_daily")]
        found = stored[0].unionByName(stored[1]).distinct().collect()  # a row per month
        months = [r[0] for r in found if r[0] is not None]
    months = sorted(set(months))
    if months:
        reports = hail.filter(F.col(MONTH_COLUMN).isin(months))
        rows = daily_partials(reports, spark.table(f"{db}.postcode_areas"))
        replace_partitions(spark, f"{db}.hail_daily", MONTH_COLUMN, months, rows)
    return months


def risk_comparison_daily(
    daily: DataFrame,
    postcode_areas: DataFrame,
    states: DataFrame,
    as_of: str | date | None = None,
    now: Column | None = None,
) -> DataFrame:
    """The rows of :func:`hailscope.plans.risk.risk_comparison_bulk` from daily sums alone.

    The window starts at a midnight, so whole days make it up. No report is read and
    nothing is placed in a polygon.
    """
    first = F.date_sub(F.current_date() if as_of is None else F.lit(str(as_of)).cast("date"), WINDOW_DAYS)
    window = daily.filter((F.col("day") >= first) & (F.col(MONTH_COLUMN) >= month_number(first.cast("timestamp"))))
    summed = stage(add_up(window, "kind", "area"), "daily-window")  # a row per area
    _, users = distinct_areas(postcode_areas)
    polygons = summed.filter(F.col("kind") == POLYGON).withColumnRenamed("area", "area_key")
    per_postcode = add_up(users.join(polygons, "area_key"), "postcode", "country")
    of_states = summed.filter(F.col("kind") == STATE).withColumnRenamed("area", "state_code")
    return compare_areas(
        figures(per_postcode, "postcode", "country"), figures(of_states, "state_code"), postcode_areas, one_per_state(states), now
    )
