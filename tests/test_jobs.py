from __future__ import annotations

from pathlib import Path

import pytest
from helpers import plan
from pyspark.sql import functions as F
from test_risk import open_data

from hailscope.__main__ import main
from hailscope.plans import load, risk
from hailscope.sources.staging import run_folder


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("jobs")
    (home / "hail-202405.csv").write_text(
        "20240501010000,0.5,0.5,K,A,1,2,60,70,1.5\n20240501010000,3.5,3.5,K,B,1,2,40,70,0.5\n"
    )
    (home / "hail-202406.csv").write_text("20240601000000,0.5,0.5,K,A,1,2,60,70,x\n20240601000001,1,1,K,A,1,2,6,7,1\n")
    for name, df in zip(("divisions", "division_areas", "addresses"), open_data(spark)):
        df.write.parquet(str(home / name))
    spark.sql("DROP DATABASE IF EXISTS jobs_db CASCADE")

    def run(job, *options):
        main([job, "--database", "jobs_db", *[o.format(home=home) for o in options]])
        return home

    run("setup")
    run("load", "--files", "{home}", "--end-date", "2024-07-10", "--lookback-months", "1", "--rejects", "{home}/rejects")
    run("areas", "--divisions", "{home}/divisions", "--division-areas", "{home}/division_areas", "--addresses", "{home}/addresses")
    run("subset")
    run("compare", "--as-of", "2024-07-15")
    yield run
    spark.sql("DROP DATABASE jobs_db CASCADE")


def test_jobs(run, spark):
    home = run("premium", "--output", "{home}/premium", "--postcode", "1")
    assert [r.county_id for r in spark.read.parquet(str(home / "premium")).collect()] == ["1"]
    run("layers", "--division-areas", "{home}/division_areas", "--output", "{home}/layers")
    layers = {r.layer for r in spark.read.text(str(home / "layers")).collect()}
    assert layers == {"selected_county", "hail", "counties", "map_center"}
    assert spark.read.parquet(str(home / "rejects")).count() == 1
    assert spark.table("jobs_db.hail_raw").count() == 2
    assert {r.state_code for r in spark.read.parquet(str(home / "layers-days")).collect()} == {"US-A"}


def test_a_window_of_subsets_and_no_folder_left(run, spark):
    before = spark.table("jobs_db.hail_state").count()
    run("subset", "--end-date", "2024-07-10", "--lookback-months", "1")
    assert spark.table("jobs_db.hail_state").count() == before
    assert not Path(run_folder(spark)).exists()


def test_time_filters_prune_months(run, spark):
    stored = spark.table("jobs_db.hail_state")
    for df in (
        risk.recent(stored, "2024-07-15"),
        load.filter_window(stored, "2024-05-01 00:00:00", "2024-06-01 00:00:00"),
        load.filter_date(stored, "2024-05-01"),
    ):
        text = plan(df)
        pruned = text[text.index("PartitionFilters"):]
        assert "event_month" in pruned[: pruned.index("PushedFilters")]
        assert df.count() == stored.count() > 0
    assert risk.recent(stored, "2025-07-15").count() == 0


def test_an_empty_database_after_cleanup(run, spark):
    run("cleanup", "--empty")
    assert spark.table("jobs_db.hail_state").count() == 0 and spark.table("jobs_db.hail_raw").count() == 2
