"""Figures from daily sums against figures from the reports, and layers read back by tile."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from helpers import box, plan
from pyspark.sql import functions as F

from hailscope.operators.batches import assign_batches
from hailscope.operators.upsert import merge_table
from hailscope.plans import daily, risk
from hailscope.schemas import GEOMETRY, HAIL_STATE, POSTCODE_AREAS, STATE_BOUNDARY
from hailscope.sources import geojson
from hailscope.sources.tables import ensure_tables

DB, AS_OF = "daily_db", "2024-07-15"


def reports(spark, rng, n, months, sevprob=None):
    rows = []
    for i in range(n):
        t = datetime(2024, rng.choice(months), rng.randint(1, 28), rng.randint(0, 23))
        x, size = rng.uniform(0, 4), rng.choice([-999.0, 0.5, 1.0, 2.25])
        rows.append((t, x, rng.uniform(0, 2), "K", str(i), 1, 2, sevprob or rng.choice([-999, 10, 60]), rng.choice([-999, 5, 95]), size, None, "US-A" if x < 2 else "US-B"))
    return spark.createDataFrame(rows, HAIL_STATE)


@pytest.fixture
def db(spark):
    spark.sql(f"DROP DATABASE IF EXISTS {DB} CASCADE")
    ensure_tables(spark, DB)
    now = datetime(2024, 1, 1)
    shapes = {"1": box(0, 0, 1, 1), "2": box(0, 0, 1, 1), "3": box(1, 0, 1, 2), "4": box(2, 0, 2, 2), "5": box(8, 8, 1, 1)}
    areas = [(p, "US", "US-A" if int(p) < 4 else "US-B", [[s]], now) for p, s in shapes.items()]
    states = [("sa", "A", "US-A", [[box(0, 0, 2, 2)]]), ("sb", "B", "US-B", [[box(2, 0, 2, 2)]])]
    merge_table(spark, f"{DB}.postcode_areas", spark.createDataFrame(areas, POSTCODE_AREAS))
    merge_table(spark, f"{DB}.state_boundary", spark.createDataFrame(states, STATE_BOUNDARY))
    yield DB
    spark.sql(f"DROP DATABASE IF EXISTS {DB} CASCADE")


def both(spark, db):
    hail, areas, states, sums = (spark.table(f"{db}.{t}") for t in ("hail_state", "postcode_areas", "state_boundary", "hail_daily"))
    now = F.lit("2024-07-15").cast("timestamp")

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    return rows(daily.risk_comparison_daily(sums, areas, states, AS_OF, now)), rows(risk.risk_comparison_bulk(hail, areas, states, AS_OF, now))


def test_daily_sums_follow_late_corrections(spark, db):
    rng = random.Random(6)
    merge_table(spark, f"{db}.hail_state", reports(spark, rng, 600, [1, 2, 3, 5, 7]))
    assert daily.refresh_daily(spark, db) == [202401, 202402, 202403, 202405, 202407]
    got, want = both(spark, db)
    assert got == want and len(got) == 7

    late = spark.table(f"{db}.hail_state").filter("event_month = 202403").drop("event_month").limit(40)
    late = late.withColumn("MAXSIZE", F.lit(3.0)).unionByName(reports(spark, rng, 20, [3, 4], sevprob=99))
    merge_table(spark, f"{db}.hail_state", late)
    stale, want = both(spark, db)
    assert stale != want
    files = {m: sorted(spark.table(f"{db}.hail_daily").filter(f"event_month = {m}").inputFiles()) for m in (202402, 202403)}
    assert daily.refresh_daily(spark, db, [202403, 202404]) == [202403, 202404]
    got, want = both(spark, db)
    assert got == want
    after = {m: sorted(spark.table(f"{db}.hail_daily").filter(f"event_month = {m}").inputFiles()) for m in files}
    assert after[202402] == files[202402] and after[202403] != files[202403]
    assert daily.refresh_daily(spark, db, []) == []


def test_refresh_reads_and_writes_only_touched_months(spark, db, monkeypatch):
    merge_table(spark, f"{db}.hail_state", reports(spark, random.Random(1), 200, [1, 2, 3]))
    seen = []
    run = daily.daily_partials
    monkeypatch.setattr(daily, "daily_partials", lambda hail, areas, **more: seen.append(hail) or run(hail, areas, **more))
    daily.refresh_daily(spark, db, [202402])
    assert {f.split("event_month=")[1][:6] for f in seen[0].inputFiles()} == {"202402"}
    text = plan(seen[0])
    assert "PartitionFilters" in text and "event_month" in text.split("PartitionFilters")[1][:80]
    # A month that has lost all its reports is left without sums.
    spark.sql(f"ALTER TABLE {db}.hail_state DROP PARTITION (event_month = 202402)")
    daily.refresh_daily(spark, db, [202402])
    assert spark.table(f"{db}.hail_daily").filter("event_month = 202402").count() == 0
    # The window reads no month before it.
    late = daily.risk_comparison_daily(spark.table(f"{db}.hail_daily"), *(spark.table(f"{db}.{t}") for t in ("postcode_areas", "state_boundary")), "2024-12-01")
    assert late.agg(F.sum("event_count")).first()[0] == 0


def test_daily_sums_of_nothing(spark, db):
    assert daily.refresh_daily(spark, db) == []
    got, want = both(spark, db)
    assert got == want and {r[3] for r in got} <= {0}


# -- layers by tile --------------------------------------------------------------------


def shapes(rng, n):
    out = []
    for i in range(n):
        w, h = rng.choice([(0.01, 0.01), (1, 2), (30, 10), (200, 90)])
        x, y = rng.uniform(-179, 179 - w), rng.uniform(-89, 89 - h)
        out.append((f"n{i}", [[box(x, y, w, h)]]))
    return out


def test_layers_are_read_back_whole_and_by_box(spark, tmp_path):
    rng = random.Random(8)
    polygons = [*shapes(rng, 120), ("none", None), ("empty", [])]
    points = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(300)] + [(900, None, 1.0), (901, 200.0, 95.0)]
    layers = {
        "areas": spark.createDataFrame(polygons, f"name string, geometry {GEOMETRY.simpleString()}"),
        "hail": spark.createDataFrame(points, "id int, LON double, LAT double"),
        "void": spark.createDataFrame([], "id int, LON double, LAT double"),
    }
    path = str(tmp_path / "map")
    geojson.write_layers(layers, path)
    areas = {r.properties["name"]: r.geometry for r in geojson.read_layer(spark, path, "areas").collect()}
    assert {n: [[[(v.x, v.y) for v in ring] for ring in p] for p in g] for n, g in areas.items()} == {
        n: [[[(v["x"], v["y"]) for v in ring] for ring in p] for p in g] for n, g in polygons if g
    }
    hail = {(int(r.properties["id"]), r.LON, r.LAT) for r in geojson.read_layer(spark, path, "hail").collect()}
    assert hail == {p for p in points if p[1] is not None}
    assert geojson.read_layer(spark, path, "void").count() == 0
    rejects = [json.loads(r.value) for r in spark.read.text(f"{path}/layer=rejects").collect()]
    assert sorted((r["layer"], r["geometry"], *r["properties"].values()) for r in rejects) == [
        ("areas", None, "empty"), ("areas", None, "none"), ("hail", None, 900),
    ]
    for west, south, east, north in [(-10, -10, 15, 20), (100, 40, 100.5, 40.25), (-180, -90, 180, 90), (199, 94, 201, 96)]:
        shown = geojson.read_layer(spark, path, "areas", (west, south, east, north))
        want = {
            n for n, g in polygons
            if g and min(v["x"] for v in g[0][0]) <= east and max(v["x"] for v in g[0][0]) >= west
            and min(v["y"] for v in g[0][0]) <= north and max(v["y"] for v in g[0][0]) >= south
        }
        assert {r.properties["name"] for r in shown.collect()} == want
        got = {int(r.properties["id"]) for r in geojson.read_layer(spark, path, "hail", (west, south, east, north)).collect()}
        assert got == {i for i, x, y in points if x is not None and west <= x <= east and south <= y <= north}


def test_a_box_reads_only_tiles_that_it_meets(spark, tmp_path):
    points = spark.range(0, 2000, 1, 4).select("id", (F.col("id") % 50 * 7.0 - 175).alias("LON"), (F.col("id") % 40 * 4.0 - 80).alias("LAT"))
    path = str(tmp_path / "map")
    geojson.write_layers({"hail": points}, path)
    shown = geojson.read_layer(spark, path, "hail", (0.0, 0.0, 20.0, 20.0))
    text = shown._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "zoom" in text.split("PartitionFilters: [")[1]
    every = len(geojson.read_layer(spark, path, "hail").inputFiles())
    from_tiles = {r[0] for r in shown.select(F.input_file_name()).distinct().collect()}
    assert shown.count() == points.filter("LON between 0 and 20 and LAT between 0 and 20").count() > 0
    assert len(from_tiles) * 10 < every
    with pytest.raises(ValueError, match="rejects"):
        geojson.write_layers({"rejects": points}, path)


# -- batches ------------------------------------------------------------------------------


def test_batch_ranges_follow_the_bytes_seen(spark):
    df = spark.range(0, 5000, 1, 3).select("id", F.repeat(F.lit("x"), 200).alias("t"))
    few = assign_batches(df, ["id"], 700)
    many = assign_batches(df, ["id"], 700, range_bytes=100_000)
    assert len(few.inputFiles()) < 6 < len([f for f in many.inputFiles() if "batches" in f])
    for got in (few, many):
        assert [r.batch_id for r in got.orderBy("id").collect()] == [i // 700 for i in range(5000)]




def test_daily_comparison_is_stored(spark, db):
    from hailscope.plans.workflow import merge_comparison, merge_daily_comparison
    from hailscope.sources.tables import peek

    now = F.lit("2024-07-15").cast("timestamp")
    merge_table(spark, f"{db}.hail_state", reports(spark, random.Random(2), 300, [2, 3, 6]))
    merge_comparison(spark, db, AS_OF, now)
    want = sorted(map(tuple, spark.table(f"{db}.risk_comparison").collect()), key=str)
    spark.sql(f"TRUNCATE TABLE {db}.risk_comparison")
    merge_daily_comparison(spark, db, None, AS_OF, now)
    assert sorted(map(tuple, spark.table(f"{db}.risk_comparison").collect()), key=str) == want and want
    assert peek(spark, f"{db}.risk_comparison", 3).count() == 3
