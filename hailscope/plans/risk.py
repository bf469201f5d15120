"""County against state: statistics, ratios, premium."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailscope.functions.dates import within_months
from hailscope.functions.geometry import area_sqmi
from hailscope.functions.measurements import (
    DAMAGING_SIZE,
    HIGH_RISK_PROB,
    density,
    floored,
    measured,
)
from hailscope.operators.dedup import first_per_key
from hailscope.operators.spatial_join import points_in_areas
from hailscope.plans.subset import distinct_areas
from hailscope.schemas import RISK_COMPARISON

WINDOW_DAYS = 180

METRICS = [c for c in RISK_COMPARISON.names if c not in ("area_type", "area_id", "country", "updated_at")]

# Equal weights of the four ratios.
WEIGHTS = {"frequency": 0.25, "size": 0.25, "severity": 0.25, "damaging": 0.25}
RATIO_METRICS = {
    "frequency": "events_per_sqmi",
    "size": "avg_hail_size",
    "severity": "avg_severe_prob",
    "damaging": "damaging_per_sqmi",
}


def recent(hail: DataFrame, as_of: str | date | None = None, days: int = WINDOW_DAYS) -> DataFrame:
    """Reports of the last ``days`` days before ``as_of`` (default today) and later."""
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    first = F.date_sub(day, days)
    return within_months(hail, first).filter(F.col("ZTIME") >= first.cast("timestamp"))


def partials(hail: DataFrame, *by: str | Column) -> DataFrame:
    """Sums and counts that can be added up again."""
    size, severe, prob = measured("MAXSIZE"), measured("SEVPROB"), measured("PROB")
    return hail.groupBy(*by).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(size).alias("size_sum"),
        F.count(size).alias("size_n"),
        F.max(size).alias("size_max"),
        F.sum(severe).alias("severe_sum"),
        F.count(severe).alias("severe_n"),
        F.sum(prob).alias("prob_sum"),
        F.count(prob).alias("prob_n"),
        F.count_if(size >= DAMAGING_SIZE).alias("damaging"),
        F.count_if(severe >= HIGH_RISK_PROB).alias("high_risk"),
    )


def add_up(rows: DataFrame, *by: str) -> DataFrame:
    """Such sums and counts added up further."""
    parts = [c for c in rows.columns if c.endswith(("_sum", "_n"))]
    return rows.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("events", "damaging", "high_risk", *parts)],
        F.max("size_max").alias("size_max"),
    )


def figures(rows: DataFrame, *by: str) -> DataFrame:
    """Counts, means and maxima from sums and counts."""

    def mean(c: str) -> Column:
        return F.col(f"{c}_sum") / F.nullif(F.col(f"{c}_n"), F.lit(0))

    return rows.select(
        *by,
        F.col("events").alias("event_count"),
        mean("size").alias("avg_hail_size"),
        F.col("size_max").alias("max_hail_size"),
        mean("severe").alias("avg_severe_prob"),
        mean("prob").alias("avg_hail_prob"),
        F.col("damaging").alias("damaging_events"),
        F.col("high_risk").alias("high_risk_events"),
    )


def event_stats(hail: DataFrame, *by: str) -> DataFrame:
    """Counts, means and maxima per ``by``, missing measurements left out."""
    return figures(partials(hail, *by), *by)


def country_of(state_code: str) -> Column:
    """A state's code begins with its country."""
    return F.substring_index(state_code, "-", 1)


def _risk_rows(stats: DataFrame, area_type: str, area_id: str, now: Column) -> DataFrame:
    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    values = {
        "area_type": F.lit(area_type),
        "area_id": F.col(area_id),
        "country": F.col("country"),
        "event_count": zero("event_count"),
        "events_per_sqmi": density(zero("event_count"), "sqmi"),
        "avg_hail_size": F.round("avg_hail_size", 4),
        "max_hail_size": F.col("max_hail_size"),
        "avg_severe_prob": F.round("avg_severe_prob", 4),
        "avg_hail_prob": F.round("avg_hail_prob", 4),
        "damaging_events": zero("damaging_events"),
        "damaging_per_sqmi": density(zero("damaging_events"), "sqmi"),
        "high_risk_events": zero("high_risk_events"),
        "high_risk_per_sqmi": density(zero("high_risk_events"), "sqmi"),
        "area_sqmi": F.round("sqmi", 4),
        "updated_at": now,
    }
    return stats.select(*[values[c].alias(c) for c in RISK_COMPARISON.names])


def compare_areas(
    county_stats: DataFrame,
    state_stats: DataFrame,
    postcode_areas: DataFrame,
    states: DataFrame,
    now: Column | None,
) -> DataFrame:
    """Risk rows of postcodes and states from their statistics."""
    now = F.current_timestamp() if now is None else now
    states = one_per_state(states)
    state_sqmi = states.select(
        "state_code", country_of("state_code").alias("country"), area_sqmi("geometry").alias("sqmi")
    )
    in_state = postcode_areas.select("postcode", "country", "state_code", area_sqmi("area").alias("sqmi"))
    # A postcode without a stored state has no rows; one without hail has a county row.
    counties = in_state.join(states.select("state_code"), "state_code").join(
        county_stats, ["postcode", "country"], "left"
    )
    with_postcode = state_sqmi.join(postcode_areas.select("state_code"), "state_code", "left_semi")
    return _risk_rows(counties, "county", "postcode", now).unionByName(
        _risk_rows(with_postcode.join(state_stats, "state_code"), "state", "state_code", now)
    )


def risk_comparison(
    hail_county: DataFrame,
    hail_state: DataFrame,
    postcode_areas: DataFrame,
    states: DataFrame,
    as_of: str | date | None = None,
    now: Column | None = None,
) -> DataFrame:
    """A county row per postcode and a state row per state, from stored subsets."""
    return compare_areas(
        event_stats(recent(hail_county, as_of), "postcode", "country"),
        event_stats(recent(hail_state, as_of), "state_code"),
        postcode_areas,
        states,
        now,
    )


def risk_comparison_bulk(
    hail_state: DataFrame,
    postcode_areas: DataFrame,
    states: DataFrame,
    as_of: str | date | None = None,
    now: Column | None = None,
    **join,
) -> DataFrame:
    """The same rows straight from the state reports.

    Reports are counted per different polygon, and the few sums are then handed to
    every postcode that uses the polygon. No row per report and postcode arises.
    """
    polygons, users = distinct_areas(postcode_areas)
    window = recent(hail_state, as_of).select("LON", "LAT", "MAXSIZE", "SEVPROB", "PROB")
    inside = points_in_areas(window, polygons, ["area_key"], geometry="area", **join)
    handed = users.join(partials(inside, "area_key"), "area_key")
    per_postcode = add_up(handed, "postcode", "country")
    return compare_areas(
        figures(per_postcode, "postcode", "country"),
        event_stats(recent(hail_state, as_of), "state_code"),
        postcode_areas,
        states,
        now,
    )


def one_per_state(states: DataFrame) -> DataFrame:
    """One polygon per state code, that of the smallest id, where a new release gave a state another id."""
    if "id" not in states.columns:
        return states
    return first_per_key(states, ["state_code"], [F.col("id").asc_nulls_last()])


def state_of(postcode_areas: DataFrame, states: DataFrame) -> DataFrame:
    """``(postcode, country, state_code)``; the smallest stored state where a
    postcode has none of its own."""
    fallback = states.select(F.min("state_code")).scalar()
    return postcode_areas.select(
        "postcode", "country", F.coalesce("state_code", fallback).alias("state_code")
    )


def fetch_comparison(
    risk: DataFrame,
    postcode_areas: DataFrame,
    states: DataFrame,
    postcodes: list[str] | None = None,
) -> DataFrame:
    """The county row and the state row of each postcode (all if none named)."""
    wanted = postcode_areas.select("postcode", "country", "state_code")
    if postcodes is not None:
        wanted = wanted.filter(F.col("postcode").isin(postcodes))
    keys = state_of(wanted, states).distinct()
    county = F.struct(
        F.lit("county").alias("area_type"), F.col("postcode").alias("area_id"), F.col("country").alias("of")
    )
    state = F.struct(
        F.lit("state").alias("area_type"), F.col("state_code").alias("area_id"), country_of("state_code").alias("of")
    )
    lookups = keys.select("postcode", "country", F.inline(F.array(county, state)))
    rows = risk.withColumnRenamed("country", "of")
    return lookups.join(rows, ["area_type", "area_id", "of"]).select(
        "postcode", "country", *[c for c in risk.columns if c != "country"]
    )


def _side_by_side(comparison: DataFrame) -> DataFrame:
    """One row per postcode and country: ``county_<metric>`` and ``state_<metric>``.

    Two rows of one kind for a postcode fail the query: their figures cannot be told apart.
    """

    def of(area_type: str, c: str) -> Column:
        return F.max(F.when(F.col("area_type") == area_type, F.col(c)))

    sides = comparison.groupBy("postcode", "country").agg(
        of("state", "area_id").alias("state_id"),
        F.count_if(F.col("area_type") == "county").alias("county_rows"),
        F.count_if(F.col("area_type") == "state").alias("state_rows"),
        *[of(t, c).alias(f"{t}_{c}") for t in ("county", "state") for c in METRICS],
    )
    double = F.raise_error(
        F.format_string("several rows of one kind for postcode %s in %s", "postcode", "country")
    ).cast("boolean")
    return sides.filter(((F.col("county_rows") <= 1) & (F.col("state_rows") <= 1)) | double)


def premium_adjustment(
    comparison: DataFrame, weights: Mapping[str, float] | None = None
) -> DataFrame:
    """Risk ratios, weighted score and premium change in percent per postcode.

    Needs both rows of a postcode; :func:`missing_rows` lists the others. A
    missing figure leaves ratio, score, change and recommendation NULL.
    """
    weights = WEIGHTS if weights is None else weights
    sides = _side_by_side(comparison).filter("county_rows > 0 AND state_rows > 0")
    ratios = sides.select(
        F.col("postcode").alias("county_id"),
        "country",
        "state_id",
        *[
            (F.col(f"county_{m}") / floored(F.col(f"state_{m}"))).alias(f"{name}_ratio")
            for name, m in RATIO_METRICS.items()
        ],
    )
    terms = [F.lit(float(weights[name])) * F.col(f"{name}_ratio") for name in RATIO_METRICS]
    score = terms[0] + terms[1] + terms[2] + terms[3]
    pct = F.col("premium_modifier_pct")
    return (
        ratios.withColumn("risk_score", score)
        .withColumn("premium_modifier_pct", (F.col("risk_score") - 1.0) * 20)
        .withColumn(
            "recommendation",
            F.when(pct > 0, "premium increase recommended").when(pct <= 0, "discount eligible"),
        )
    )


def missing_rows(comparison: DataFrame, postcode_areas: DataFrame) -> DataFrame:
    """Postcodes that lack their county row or their state row."""
    sides = _side_by_side(comparison).select("postcode", "country", "county_rows", "state_rows")
    known = postcode_areas.select("postcode", "country").distinct()
    return (
        known.join(sides, ["postcode", "country"], "left")
        .select(
            "postcode",
            "country",
            (F.coalesce("county_rows", F.lit(0)) == 0).alias("county_missing"),
            (F.coalesce("state_rows", F.lit(0)) == 0).alias("state_missing"),
        )
        .filter("county_missing OR state_missing")
    )


def comparison_report(comparison: DataFrame) -> DataFrame:
    """Long form: ``(postcode, country, metric, county, state)``."""
    sides = _side_by_side(comparison).filter("county_rows > 0 AND state_rows > 0")
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"county_{m}").cast("double").alias("county"),
            F.col(f"state_{m}").cast("double").alias("state"),
        )
        for m in METRICS
    ]
    return sides.select("postcode", "country", F.inline(F.array(*rows)))


# The choices of a reviewer, the default, the reason if none is given.
DECISIONS = ("Confirm", "Reject")
DEFAULT_DECISION = "Confirm"
DEFAULT_REASON = "..."


def apply_decisions(adjustments: DataFrame, decisions: DataFrame) -> DataFrame:
    """Adjustments with the reviewer's ``decision`` and ``reason``.

    No answer, or one that is no valid choice, counts as the default. Of several
    answers for one postcode of a country a rejection wins. Answers without a
    ``country`` column hold for the postcode in every country.
    """
    by = ["county_id", *(["country"] if "country" in decisions.columns else [])]
    valid = decisions.filter(F.col("decision").isin(*DECISIONS)).withColumnRenamed("postcode", "county_id")
    answers = first_per_key(
        valid.select(*by, "decision", "reason"), by, [F.desc("decision"), F.asc_nulls_last("reason")]
    )
    return adjustments.join(answers, by, "left").select(
        *adjustments.columns,
        F.coalesce("decision", F.lit(DEFAULT_DECISION)).alias("decision"),
        F.coalesce("reason", F.lit(DEFAULT_REASON)).alias("reason"),
    )
