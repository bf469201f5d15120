"""All steps wired together."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession

from hailscope.operators.upsert import merge_table
from hailscope.plans import areas, daily, layers, load, risk, subset
from hailscope.sources.staging import stage
from hailscope.sources.tables import ensure_tables


def assess(
    csv: DataFrame,
    divisions: DataFrame,
    division_areas: DataFrame,
    addresses: DataFrame,
    *,
    start: load.Instant,
    end: load.Instant,
    as_of: str | date | None = None,
    now: Column | None = None,
    country: str | None = "US",
    decisions: DataFrame | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = stage,
) -> dict[str, DataFrame]:
    """From raw files to premiums and layers for every postcode.

    ``keep`` is applied to results that several later steps read; it writes them
    to the shared folder unless replaced (``lambda df, name: df`` for none).
    """
    rows, rejects = load.load_hail(csv, start, end)
    states = keep(
        areas.build_state_boundaries(divisions, division_areas, addresses, country),
        "state_boundary",
    )
    postcodes = keep(
        areas.build_postcode_areas(addresses, division_areas, country, now), "postcode_areas"
    )
    hail_state = keep(subset.subset_state(rows, states), "hail_state")
    hail_county = subset.subset_county(hail_state, postcodes)
    compared = keep(
        risk.risk_comparison_bulk(hail_state, postcodes, states, as_of, now), "risk_comparison"
    )
    fetched = risk.fetch_comparison(compared, postcodes, states)
    premiums = risk.premium_adjustment(fetched)
    worst = keep(layers.worst_day_bulk(hail_state, postcodes), "worst_day")
    results = {
        "hail_raw": rows,
        "rejects": rejects,
        "state_boundary": states,
        "postcode_areas": postcodes,
        "hail_state": hail_state,
        "hail_county": hail_county,
        "risk_comparison": compared,
        "comparison_report": risk.comparison_report(fetched),
        "premium_adjustment": premiums,
        "missing": risk.missing_rows(fetched, postcodes),
        "worst_day": worst,
        "worst_day_states": layers.worst_day_states(worst, postcodes, states),
        "county_label": layers.county_label(division_areas, postcodes, country),
        **{
            f"layer_{name}": df
            for name, df in layers.map_layers(
                hail_state, worst, division_areas, postcodes, states
            ).items()
        },
    }
    if decisions is not None:
        results["decisions"] = risk.apply_decisions(premiums, decisions)
    return results


def refresh_tables(
    spark: SparkSession,
    db: str,
    csv: DataFrame,
    divisions: DataFrame,
    division_areas: DataFrame,
    addresses: DataFrame,
    *,
    start: load.Instant,
    end: load.Instant,
    as_of: str | date | None = None,
    now: Column | None = None,
    country: str | None = "US",
    only_window: bool = False,
) -> DataFrame:
    """The same chain over catalog tables: each step merges into its table and
    the next reads it *(action)*. Returns the rejected raw rows.

    By default all stored reports are placed again, as new areas may hold old
    reports. ``only_window`` places those of the load window alone; that is
    enough as long as the areas have not changed.
    """
    ensure_tables(spark, db)
    rows, rejects = load.load_hail(csv, start, end)
    merge_table(spark, f"{db}.hail_raw", rows)
    merge_areas(spark, db, divisions, division_areas, addresses, now=now, country=country)
    merge_subsets(spark, db, window=(start, end) if only_window else None)
    merge_comparison(spark, db, as_of, now)
    return rejects


def merge_areas(
    spark: SparkSession,
    db: str,
    divisions: DataFrame,
    division_areas: DataFrame,
    addresses: DataFrame,
    *,
    now: Column | None = None,
    country: str | None = "US",
) -> None:
    """Bring ``state_boundary`` and ``postcode_areas`` up to date *(action)*."""
    merge_table(
        spark,
        f"{db}.state_boundary",
        areas.build_state_boundaries(divisions, division_areas, addresses, country),
    )
    merge_table(
        spark,
        f"{db}.postcode_areas",
        areas.build_postcode_areas(addresses, division_areas, country, now),
    )


def merge_subsets(
    spark: SparkSession, db: str, window: tuple[load.Instant, load.Instant] | None = None
) -> None:
    """Bring ``hail_state`` and ``hail_county`` up to date *(action)*."""

    def reports(table: str) -> DataFrame:
        hail = spark.table(f"{db}.{table}")
        return hail if window is None else load.filter_window(hail, *window)

    states = risk.one_per_state(spark.table(f"{db}.state_boundary"))
    merge_table(spark, f"{db}.hail_state", subset.subset_state(reports("hail_raw"), states))
    postcodes = spark.table(f"{db}.postcode_areas")
    merge_table(spark, f"{db}.hail_county", subset.subset_county(reports("hail_state"), postcodes))


def merge_comparison(
    spark: SparkSession, db: str, as_of: str | date | None = None, now: Column | None = None
) -> None:
    """Bring ``risk_comparison`` up to date, from the state reports *(action)*."""
    hail, postcodes, states = (spark.table(f"{db}.{t}") for t in ("hail_state", "postcode_areas", "state_boundary"))
    merge_table(spark, f"{db}.risk_comparison", risk.risk_comparison_bulk(hail, postcodes, states, as_of, now))


def merge_daily_comparison(
    spark: SparkSession,
    db: str,
    months: Iterable[int] | None = None,
    as_of: str | date | None = None,
    now: Column | None = None,
) -> None:
    """Bring ``hail_daily`` up to date in ``months`` (all if none are named), and from it ``risk_comparison`` *(action)*."""
    daily.refresh_daily(spark, db, months)
    sums, postcodes, states = (spark.table(f"{db}.{t}") for t in ("hail_daily", "postcode_areas", "state_boundary"))
    merge_table(spark, f"{db}.risk_comparison", daily.risk_comparison_daily(sums, postcodes, states, as_of, now))
