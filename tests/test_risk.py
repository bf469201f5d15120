from __future__ import annotations

import json
from datetime import datetime

import pytest
from helpers import box, plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailscope.functions.measurements import floored
from hailscope.plans import areas, layers, risk, subset
from hailscope.plans.workflow import assess, refresh_tables
from hailscope.operators.upsert import upsert
from hailscope.schemas import GEOMETRY, HAIL_CSV, MEASUREMENTS, MERGE_KEYS, POSTCODE_AREAS, RISK_COMPARISON, STATE_BOUNDARY
from hailscope.sources.geojson import features, prepare_layer, write_layers

NOW = datetime(2024, 7, 1)
AS_OF = "2024-07-15"


def states(spark, *rows):
    return spark.createDataFrame([(i, n, c, g) for i, n, c, g in rows], STATE_BOUNDARY)


def postcodes(spark, *rows):
    return spark.createDataFrame([(p, "US", s, g, NOW) for p, s, g in rows], POSTCODE_AREAS)


def hail(spark, *rows):
    """(time, lon, lat, sevprob, prob, maxsize)"""
    schema = "ZTIME string, LON double, LAT double, SEVPROB int, PROB int, MAXSIZE double"
    df = spark.createDataFrame(list(rows), schema).withColumn("ZTIME", F.col("ZTIME").cast("timestamp"))
    return df.withColumns({"WSR_ID": F.lit("K"), "CELL_ID": F.lit("A"), "RANGE": F.lit(1), "AZIMUTH": F.lit(2), "postcode": F.lit(None).cast("string")})


@pytest.fixture(scope="module")
def world(spark):
    """State A with three postcodes (two in one county, one without hail), state B without hail."""
    st = states(
        spark,
        ("s1", "A", "US-A", [[box(0, 0, 4, 4)]]),
        ("s2", "B", "US-B", [[box(10, 0, 4, 4)]]),
    )
    county, dry = [[box(0, 0, 2, 2)]], [[box(2, 2, 2, 2)]]
    pa = postcodes(
        spark,
        ("1", "US-A", county), ("2", "US-A", county), ("3", "US-A", dry),
        ("4", "US-B", [[box(10, 0, 1, 1)]]), ("5", "US-C", [[box(20, 0, 1, 1)]]),
    )
    h = hail(
        spark,
        ("2024-06-01 01:00:00", 0.5, 0.5, 50, 10, 1.0),
        ("2024-06-01 02:00:00", 0.6, 0.6, -999, 20, -999.0),
        ("2024-06-02 02:00:00", 1.5, 1.5, 49, -999, 0.75),
        ("2024-06-03 02:00:00", 3.5, 0.5, 90, 90, 3.0),
        ("2023-06-03 02:00:00", 0.5, 0.5, 90, 90, 4.0),
        ("2024-06-03 02:00:00", 30.0, 0.5, 90, 90, 3.0),
    )
    hs = subset.subset_state(h, st).cache()
    hc = subset.subset_county(hs, pa).cache()
    return st, pa, hs, hc


def by_id(df):
    return {(r.area_type, r.area_id): r for r in df.collect()}


@pytest.mark.parametrize("bulk", [False, True])
def test_comparison(world, bulk):
    st, pa, hs, hc = world
    got = by_id(
        risk.risk_comparison_bulk(hs, pa, st, AS_OF) if bulk else risk.risk_comparison(hc, hs, pa, st, AS_OF)
    )
    # A county row for every postcode with a stored state; a state row only with hail.
    assert set(got) == {("county", "1"), ("county", "2"), ("county", "3"), ("county", "4"), ("state", "US-A")}
    c = got["county", "1"]
    assert (c.event_count, c.damaging_events, c.high_risk_events) == (3, 1, 1)
    assert (c.avg_hail_size, c.max_hail_size, c.avg_severe_prob, c.avg_hail_prob) == (0.875, 1.0, 49.5, 15.0)
    assert c.events_per_sqmi == round(3 / c.area_sqmi, 4)
    assert got["county", "2"][2:-1] == c[2:-1]
    dry = got["county", "3"]
    assert (dry.event_count, dry.events_per_sqmi, dry.avg_hail_size) == (0, 0.0, None)
    assert got["state", "US-A"].event_count == 4


def test_comparison_has_the_table_layout(world):
    st, pa, hs, hc = world
    schema = risk.risk_comparison(hc, hs, pa, st, AS_OF).schema
    assert [(f.name, f.dataType) for f in schema] == [(f.name, f.dataType) for f in RISK_COMPARISON]


def test_all_missing_measurements(spark):
    got = risk.event_stats(hail(spark, ("2024-06-01 01:00:00", 0.5, 0.5, -999, -999, -999.0)), "WSR_ID").first()
    assert (got.event_count, got.avg_hail_size, got.max_hail_size, got.damaging_events) == (1, None, None, 0)


def test_area_of_zero_gives_no_density(spark):
    flat = [[[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 0.0, "y": 0.0}]]]
    st = states(spark, ("s1", "A", "US-A", flat))
    pa = postcodes(spark, ("1", "US-A", flat))
    h = hail(spark, ("2024-06-01 01:00:00", 0.5, 0.5, 1, 1, 1.0)).withColumn("state_code", F.lit("US-A"))
    for r in risk.risk_comparison(h.withColumns({"postcode": F.lit("1"), "country": F.lit("US")}), h, pa, st, AS_OF).collect():
        assert (r.event_count, r.events_per_sqmi, r.area_sqmi) == (1, None, 0.0)


def test_premium(world):
    st, pa, hs, hc = world
    compared = risk.risk_comparison(hc, hs, pa, st, AS_OF)
    fetched = risk.fetch_comparison(compared, pa, st)
    got = {r.county_id: r for r in risk.premium_adjustment(fetched).collect()}
    assert set(got) == {"1", "2", "3"}
    rows = by_id(compared)
    c, s = rows["county", "1"], rows["state", "US-A"]
    score = 0.25 * (
        c.events_per_sqmi / s.events_per_sqmi + c.avg_hail_size / s.avg_hail_size
        + c.avg_severe_prob / s.avg_severe_prob + c.damaging_per_sqmi / max(s.damaging_per_sqmi, 1e-10)
    )
    assert got["1"].risk_score == pytest.approx(score)
    assert got["1"].premium_modifier_pct == pytest.approx((score - 1) * 20)
    assert got["1"].recommendation == (
        "premium increase recommended" if score > 1 else "discount eligible"
    )
    assert got["1"].state_id == "US-A"
    # No hail in the county: no sizes to compare, so no score.
    assert (got["3"].frequency_ratio, got["3"].risk_score, got["3"].recommendation) == (0.0, None, None)
    missing = {r.postcode: (r.county_missing, r.state_missing) for r in risk.missing_rows(fetched, pa).collect()}
    assert missing == {"4": (False, True), "5": (True, True)}
    heavy = risk.premium_adjustment(fetched, {"frequency": 1, "size": 0, "severity": 0, "damaging": 0})
    assert {r.county_id: r.risk_score for r in heavy.collect()}["1"] == got["1"].frequency_ratio


def test_one_postcode_in_two_countries(spark):
    """Figures, worst days and decisions of a postcode stay with its country."""
    st = states(spark, ("s1", "A", "US-A", [[box(0, 0, 4, 4)]]), ("s2", "B", "CA-B", [[box(10, 0, 4, 4)]]))
    pa = postcodes(spark, ("1", "US-A", [[box(0, 0, 2, 2)]]))
    pa = pa.unionByName(
        postcodes(spark, ("1", "CA-B", [[box(10, 0, 2, 2)]])).withColumn("country", F.lit("CA"))
    )
    rows = [("2024-06-01 01:00:00", 0.5, 0.5, 50, 10, 2.0)]
    rows += [(f"2024-06-0{d} 01:00:00", 10.5, 0.5, 50, 10, 0.5) for d in (2, 3, 4, 5, 6)]
    hs = subset.subset_state(hail(spark, *rows), st).cache()
    hc = subset.subset_county(hs, pa)
    stored = risk.risk_comparison(hc, hs, pa, st, AS_OF, F.lit(NOW))
    bulk = risk.risk_comparison_bulk(hs, pa, st, AS_OF, F.lit(NOW))
    assert sorted(map(str, stored.collect())) == sorted(map(str, bulk.collect()))
    got = {(r.area_type, r.country): (r.event_count, r.max_hail_size) for r in stored.collect()}
    assert got == {
        ("county", "US"): (1, 2.0), ("county", "CA"): (5, 0.5), ("state", "US"): (1, 2.0), ("state", "CA"): (5, 0.5),
    }
    again = upsert(stored, stored, MERGE_KEYS["risk_comparison"])
    assert again.count() == 4
    fetched = risk.fetch_comparison(stored, pa, st)
    premiums = risk.premium_adjustment(fetched)
    assert {(r.county_id, r.country, r.state_id) for r in premiums.collect()} == {("1", "US", "US-A"), ("1", "CA", "CA-B")}
    said = spark.createDataFrame([("1", "CA", "Reject", "x")], "postcode string, country string, decision string, reason string")
    assert {r.country: r.decision for r in risk.apply_decisions(premiums, said).collect()} == {"US": "Confirm", "CA": "Reject"}
    for worst in (layers.worst_day(hc), layers.worst_day_bulk(hs, pa)):
        assert {(r.country, str(r.date)) for r in worst.collect()} == {("US", "2024-06-01"), ("CA", "2024-06-02")}
    for counts in (subset.hail_count_by_postcode(hc, pa), subset.hail_count_bulk(hs, pa)):
        assert {(r.country, r.hail_count) for r in counts.collect()} == {("US", 1), ("CA", 5)}
    with pytest.raises(Exception, match="several rows of one kind"):
        risk.premium_adjustment(fetched.unionByName(fetched)).collect()


def test_a_second_run_with_new_ids_and_two_radars(spark):
    """A new release gives the state another id; two radars report one place; states overlap."""
    st = states(spark, ("s1", "A", "US-A", [[box(0, 0, 4, 4)]]), ("s9", "A", "US-A", [[box(0, 0, 4, 4)]]), ("s2", "B", "US-B", [[box(0, 0, 1, 1)]]))
    pa = postcodes(spark, ("1", "US-A", [[box(0, 0, 2, 2)]]))
    h = hail(spark, ("2024-06-01 01:00:00", 0.5, 0.5, 50, 10, 2.0))
    h = h.unionByName(h.withColumn("WSR_ID", F.lit("K2")))
    hs = subset.subset_state(h, risk.one_per_state(st)).cache()
    assert hs.count() == 4
    assert upsert(hs, hs, MERGE_KEYS["hail_state"], update=MEASUREMENTS).count() == 4
    hc = subset.subset_county(hs.filter("state_code = 'US-A'"), pa).cache()
    assert upsert(hc, hc, MERGE_KEYS["hail_county"], update=MEASUREMENTS).count() == 2


def test_fetch_named_postcodes_and_fallback_state(world, spark):
    st, pa, hs, hc = world
    compared = risk.risk_comparison(hc, hs, pa, st, AS_OF)
    stateless = pa.withColumn("state_code", F.lit(None).cast("string"))
    got = risk.fetch_comparison(compared, stateless, st, ["2"]).collect()
    assert {(r.postcode, r.area_type, r.area_id) for r in got} == {("2", "county", "2"), ("2", "state", "US-A")}


def test_report(world):
    st, pa, hs, hc = world
    fetched = risk.fetch_comparison(risk.risk_comparison(hc, hs, pa, st, AS_OF), pa, st, ["1"])
    got = {r.metric: (r.county, r.state) for r in risk.comparison_report(fetched).collect()}
    assert list(sorted(got)) == sorted(risk.METRICS)
    assert got["event_count"] == (3.0, 4.0)


def test_floor_keeps_null(spark):
    df = spark.createDataFrame([(0.0,), (None,), (2.0,)], "x double")
    assert [r[0] for r in df.select(floored(F.col("x"))).collect()] == [1e-10, None, 2.0]


def test_decisions(spark):
    adjustments = spark.createDataFrame([("1", 3.0), ("2", 4.0), ("3", 5.0), ("4", 5.0)], "county_id string, premium_modifier_pct double")
    decisions = spark.createDataFrame(
        [("1", "Reject", "roof"), ("1", "Confirm", "a"), ("2", "Maybe", "b"), ("3", "Confirm", None)],
        "postcode string, decision string, reason string",
    )
    got = {r.county_id: (r.decision, r.reason) for r in risk.apply_decisions(adjustments, decisions).collect()}
    assert got == {"1": ("Reject", "roof"), "2": ("Confirm", "..."), "3": ("Confirm", "..."), "4": ("Confirm", "...")}


def test_counts(world):
    st, pa, hs, hc = world
    assert {tuple(r) for r in subset.hail_counts_by_state(hs).collect()} == {("US-A", 5)}
    got = {r.postcode: r.hail_count for r in subset.hail_count_by_postcode(hc, pa).collect()}
    assert got == {"1": 4, "2": 4, "3": 0, "4": 0, "5": 0}


def test_statistics_aggregate_before_the_shuffle(world):
    text = plan(risk.event_stats(world[2], "state_code"))
    assert "partial_count" in text and "Window" not in text


# -- postcodes ---------------------------------------------------------------------


def test_centre_counts_equal_points_once(spark):
    pts = spark.createDataFrame(
        [("1", "US", 0.0, 0.0)] * 3 + [("1", "US", 3.0, 3.0), ("2", "US", None, 1.0)],
        "postcode string, country string, LON double, LAT double",
    )
    assert [tuple(r) for r in areas.point_centroid(pts, ["postcode", "country"]).collect()] == [("1", "US", 1.5, 1.5)]


DIVISION_AREA = f"id string, division_id string, subtype string, country string, region string, names struct<primary:string>, geometry {GEOMETRY.simpleString()}"


def open_data(spark):
    division_areas = spark.createDataFrame(
        [
            ("c2", "d-c2", "county", "US", "US-A", ("Second",), [[box(0, 0, 2, 2)]]),
            ("c1", "d-c1", "county", "US", "US-A", ("First",), [[box(0, 0, 2, 2)]]),
            ("c3", "d-c3", "county", "CA", "CA-A", ("Abroad",), [[box(0, 0, 2, 2)]]),
            ("s2", "d-s", "region", "US", "US-A", ("A sea",), [[box(-1, -1, 6, 6)]]),
            ("s1", "d-s", "region", "US", "US-A", ("A land",), [[box(0, 0, 4, 4)]]),
            ("s9", "d-z", "region", "US", "US-Z", ("Z",), [[box(50, 0, 4, 4)]]),
        ],
        DIVISION_AREA,
    )
    divisions = spark.createDataFrame(
        [("d-s", "region", "US", "US-A", ("State A",)), ("d-z", "region", "US", "US-Z", ("State Z",))],
        "id string, subtype string, country string, region string, names struct<primary:string>",
    )
    addresses = spark.createDataFrame(
        [
            ("1", "US", [("A",)], 0.5, 0.5), ("1", "US", [("A",)], 1.5, 0.5),
            ("2", "US", [], 40.0, 40.0), ("1", "CA", [("A",)], 0.5, 0.5), (None, "US", [("Z",)], 51.0, 1.0),
        ],
        "postcode string, country string, address_levels array<struct<value:string>>, LON double, LAT double",
    )
    return divisions, division_areas, addresses


def test_postcode_areas(spark):
    divisions, division_areas, addresses = open_data(spark)
    located = areas.locate_postcodes(addresses, division_areas)
    assert {tuple(r) for r in located.collect()} == {("1", "US", "c1", "US-A"), ("1", "CA", "c3", "CA-A")}
    built = areas.build_postcode_areas(addresses, division_areas, "US", F.lit(NOW))
    assert [(f.name, f.dataType) for f in built.schema] == [(f.name, f.dataType) for f in POSTCODE_AREAS]
    assert [(r.postcode, r.country, r.state_code) for r in built.collect()] == [("1", "US", "US-A")]
    checked = areas.check_county_area(built, division_areas).first()
    assert checked.county_name == "Abroad" and checked.area_sqmi > 0
    labels = layers.county_label(division_areas, built.unionByName(built.withColumn("postcode", F.lit("9")).withColumn("area", F.array().cast(GEOMETRY))))
    assert {(r.postcode, r.label) for r in labels.collect()} == {("1", "First"), ("9", "County (9)")}


def test_state_boundaries(spark):
    divisions, division_areas, addresses = open_data(spark)
    built = areas.build_state_boundaries(divisions, division_areas, addresses, "US")
    assert [(r.id, r.state_name, r.state_code) for r in built.collect()] == [("s1", "State A", "US-A")]


# -- layers ------------------------------------------------------------------------


def test_worst_day_breaks_ties_by_count_then_date(spark):
    rows = [
        ("1", "2024-01-03", 2.0), ("1", "2024-01-02", 2.0), ("1", "2024-01-01", 1.0), ("1", "2024-01-01", 1.0),
        ("2", "2024-01-01", -999.0), ("2", "2024-01-02", 0.5),
        ("3", "2024-01-01", 1.0), ("3", "2024-01-02", 1.0), ("3", "2024-01-02", -999.0),
        ("4", "2024-01-02", -999.0),
    ]
    df = spark.createDataFrame(rows, "postcode string, ZTIME string, MAXSIZE double").withColumns({"ZTIME": F.col("ZTIME").cast("timestamp"), "country": F.lit("US")})
    got = {r.postcode: (str(r.date), r.event_count, r.max_size) for r in layers.worst_day(df).collect()}
    assert got == {
        "1": ("2024-01-02", 1, 2.0), "2": ("2024-01-02", 1, 0.5), "3": ("2024-01-02", 2, 1.0), "4": ("2024-01-02", 1, None),
    }
    assert layers.worst_day(df.filter("false")).count() == 0


def test_layers_are_geojson(world, spark, tmp_path):
    st, pa, hs, hc = world
    found = open_data(spark)[1]
    shown = layers.map_layers(hs, layers.worst_day(hc), found, pa, st)
    counties = found.filter("subtype = 'county' AND region IN ('US-A', 'US-B', 'US-C')").count()
    out = str(tmp_path / "layers")
    write_layers(shown, out)
    write_layers(shown, out)
    lines = spark.read.text(out).collect()
    parsed = [(r.layer, json.loads(r.value)) for r in lines]
    count = {n: sum(layer == n for layer, _ in parsed) for n in shown}
    assert count == {"selected_county": 5, "hail": 1, "counties": counties, "map_center": 2}
    assert {f["geometry"]["type"] for n, f in parsed if n == "counties"} == {"MultiPolygon"}
    hail_row = next(f for n, f in parsed if n == "hail")
    assert hail_row["properties"]["ZTIME"] == "2024-06-01 01:00:00" or hail_row["properties"]["date"]


def test_prepare_layer(spark):
    df = prepare_layer(spark.createDataFrame([("1", "2")], "LON string, other string"))
    assert [f.dataType for f in df.schema] == [T.DoubleType(), T.StringType()]
    assert json.loads(features(spark.createDataFrame([("1", "2")], "LON string, LAT string")).first()[0])["geometry"]["coordinates"] == [1.0, 2.0]


# -- all steps -----------------------------------------------------------------------


def csv(spark):
    def line(t, x, y, size):
        return (t, str(x), str(y), "K", "A", "1", "2", "60", "70", size)

    return spark.createDataFrame(
        [
            line("20240601010000", 0.5, 0.5, "1.5"), line("20240601010000", 0.5, 0.5, "1.5"),
            line("20240602010000", 3.5, 3.5, "0.5"), line("20240602010000", 90, 3.5, "0.5"),
            line("20240602010000", "west", 3.5, "0.5"),
        ],
        HAIL_CSV,
    )


def test_assess(spark):
    divisions, division_areas, addresses = open_data(spark)
    decisions = spark.createDataFrame([("1", "Reject", "x")], "postcode string, decision string, reason string")
    got = assess(
        csv(spark), divisions, division_areas, addresses, start="2024-05-01 00:00:00", end="2024-07-01 00:00:00",
        as_of=AS_OF, now=F.lit(NOW), decisions=decisions,
    )
    assert {n: got[n].count() for n in ("hail_raw", "rejects", "hail_state", "hail_county", "risk_comparison", "missing")} == {
        "hail_raw": 3, "rejects": 1, "hail_state": 2, "hail_county": 1, "risk_comparison": 2, "missing": 0,
    }
    assert got["decisions"].first().decision == "Reject"
    assert got["layer_hail"].count() == 1


def test_refresh_tables_twice(spark):
    divisions, division_areas, addresses = open_data(spark)
    spark.sql("DROP DATABASE IF EXISTS hail_all CASCADE")
    for _ in range(2):
        refresh_tables(
            spark, "hail_all", csv(spark), divisions, division_areas, addresses,
            start="2024-05-01 00:00:00", end="2024-07-01 00:00:00", as_of=AS_OF, now=F.lit(NOW), country="US",
        )
        counts = {t: spark.table(f"hail_all.{t}").count() for t in ("hail_raw", "hail_state", "hail_county", "postcode_areas", "state_boundary", "risk_comparison")}
        assert counts == {"hail_raw": 3, "hail_state": 2, "hail_county": 1, "postcode_areas": 1, "state_boundary": 1, "risk_comparison": 2}
    spark.sql("DROP DATABASE hail_all CASCADE")
