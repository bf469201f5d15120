from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import plan
from pyspark.sql import functions as F

from hailscope.functions.dates import daily_dates, hail_files, hail_window, window_bounds
from hailscope.operators.batches import assign_batches
from hailscope.operators.dedup import first_per_key
from hailscope.plans import load
from hailscope.schemas import BROKEN_LINE, HAIL_CSV, HAIL_CSV_COLUMNS, MERGE_KEYS
from hailscope.sources.hail_csv import read_hail_csv

GOOD = "20240105120000,-97.5,35.5,KTLX,A1,10,20,30,40,1.25"


def test_csv_lines(spark, tmp_path):
    (tmp_path / "hail-202401.csv").write_text(
        "\n".join(
            [
                "#ZTIME,LON,LAT",
                GOOD,
                "",
                "20240105120001,-97.5,35.5,KTLX,A1,10",
                GOOD.replace("120000", "120002") + ",extra",
                GOOD.replace("35.5", "north"),
                GOOD.replace("20240105120000", "20241305120000"),
                GOOD.replace("20240105120000", ""),
            ]
        )
    )
    (tmp_path / "hail-202402.csv").write_text(GOOD.replace("20240105", "20240201") + "\n")
    csv = read_hail_csv(spark, hail_files(str(tmp_path), "2024-03-15", 1))
    assert csv.columns == [*HAIL_CSV_COLUMNS, BROKEN_LINE]
    rows, rejects = load.load_hail(csv, "2024-01-01 00:00:00", "2024-03-01 00:00:00")
    got = {r.ZTIME: r for r in rows.collect()}
    assert set(got) == {datetime(2024, 1, 5, 12), datetime(2024, 2, 1, 12)}
    assert got[datetime(2024, 2, 1, 12)].RANGE == 10
    short, long = "20240105120001,-97.5,35.5,KTLX,A1,10", GOOD.replace("120000", "120002") + ",extra"
    assert {(r.ZTIME, r.LAT, r.broken_line) for r in rejects.collect()} == {
        ("20240105120000", "north", None), ("20241305120000", "35.5", None), (None, "35.5", None),
        ("20240105120001", "35.5", short), ("20240105120002", "35.5", long),
    }
    # Fields are counted whichever columns are asked for.
    assert rejects.select("LON").count() == 5 and rows.select("LON").count() == 2


def test_values_are_parsed_once(spark):
    text = plan(load.parse_hail(spark.createDataFrame([], HAIL_CSV))[0])
    assert text.count("gettimestamp") == 1


def test_files_and_window():
    assert hail_window("2026-02-10") == (datetime(2025, 10, 1), datetime(2026, 1, 1))
    assert hail_files("s3a://b", "2026-02-10") == [
        f"s3a://b/hail-{m}.csv" for m in ("202510", "202511", "202512", "202601")
    ]
    assert hail_files("b/", "2026-02-10", granularity="year") == ["b/hail-2025.csv", "b/hail-2026.csv"]
    with pytest.raises(ValueError):
        hail_files("b", "2026-02-10", granularity="day")


def test_window_columns_equal_window(spark):
    days = [date(2026, 2, 10), date(2024, 1, 1), date(2024, 12, 31), date(2024, 3, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for r in df.select("d", *window_bounds("d", 5)).collect():
        start, end = hail_window(r[0], 5)
        assert (r[1], r[2]) == (start.date(), end.date())


def test_window_is_closed_at_an_instant(spark):
    rows = [("2024-01-01 00:00:00",), ("2024-01-31 00:00:00",), ("2024-01-31 00:00:01",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp").alias("ZTIME"))
    assert load.filter_window(df, "2024-01-01 00:00:00", datetime(2024, 1, 31)).count() == 2
    ntz = df.select(F.col("ZTIME").cast("timestamp_ntz").alias("ZTIME"))
    assert load.filter_window(ntz, "2024-01-01 00:00:00", datetime(2024, 1, 31)).count() == 2


def test_filter_day_and_date(spark):
    stamps = ["20240109235959", "20240110000000", "20240110235959", "20240111000000"]
    df = spark.createDataFrame([(s,) for s in stamps], "ZTIME string")
    assert [r[0] for r in load.filter_day(df, "20240110").collect()] == stamps[1:3]
    ts = df.select(F.to_timestamp("ZTIME", "yyyyMMddHHmmss").alias("ZTIME"))
    assert load.filter_date(ts, "2024-01-10").count() == 2


def test_date_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).select(F.current_timestamp().alias("ZTIME"), "id").write.parquet(str(tmp_path / "t"))
    text = plan(load.filter_date(spark.read.parquet(str(tmp_path / "t")), "2024-01-10"))
    assert "GreaterThanOrEqual(ZTIME" in text and "LessThan(ZTIME" in text


def test_daily_dates(spark):
    assert [r[0] for r in daily_dates(spark, "2024-02-28", "2024-03-01").collect()] == [
        "20240228", "20240229", "20240301",
    ]
    assert daily_dates(spark, "2024-03-02", "2024-03-01").count() == 0


def test_dedup_keeps_measurements(spark):
    rows = [
        ("20240105120000", "-97.5", "35.5", "K", "A", "1", "2", s, "4", m)
        for s, m in (("-999", "-999"), ("60", "1.5"), ("70", "-999"))
    ]
    typed, _ = load.load_hail(spark.createDataFrame(rows, HAIL_CSV), "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    assert [(r.SEVPROB, r.MAXSIZE) for r in typed.collect()] == [(60, 1.5)]


def test_dedup_keeps_one_whatever_the_input_order(spark):
    rows = [("20240105120000", "-97.5", "35.5", "K", "A", "1", "2", s, "4", "1") for s in ("9", "5", None, "7")]
    for order in (rows, rows[::-1]):
        typed, _ = load.load_hail(
            spark.createDataFrame(order, HAIL_CSV), "2024-01-01 00:00:00", "2024-02-01 00:00:00"
        )
        assert [r.SEVPROB for r in typed.collect()] == [9]


def test_dedup_drops_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([("20240105120000",) * 10], HAIL_CSV).union(
        spark.createDataFrame([("x",) * 10], HAIL_CSV)
    )
    text = plan(first_per_key(df, MERGE_KEYS["hail_raw"]))
    partial = text.index("WindowGroupLimit", text.index("WindowGroupLimit") + 1)
    assert "Partial" in text[partial:] and text.index("Exchange hashpartitioning") < partial


def _hail(spark, rows):
    return spark.createDataFrame(
        rows, "ZTIME string, WSR_ID string, SEVPROB int, PROB int, MAXSIZE double"
    ).withColumn("ZTIME", F.col("ZTIME").cast("timestamp"))


def test_verify(spark):
    got = load.verify_hail(
        _hail(
            spark,
            [
                ("2024-01-01 01:00:00", "A", -999, 1, 1.0),
                ("2024-01-01 02:00:00", "B", 1, -999, -999.0),
                ("2024-01-02 02:00:00", "A", 1, 1, 0.25),
            ],
        )
    ).first()
    assert got.asDict() == {
        "total_records": 3, "earliest_date": datetime(2024, 1, 1, 1), "latest_date": datetime(2024, 1, 2, 2),
        "unique_days": 2, "unique_stations": 2, "missing_sevprob": 1, "missing_prob": 1,
        "missing_maxsize": 1, "avg_hail_size": 0.625, "max_hail_size": 1.0,
    }


def test_verify_of_nothing_is_one_row(spark):
    got = load.verify_hail(_hail(spark, [])).collect()
    assert len(got) == 1 and got[0].total_records == 0 and got[0].avg_hail_size is None


def test_transpose(spark):
    df = load.transpose_summary(spark.createDataFrame([(1, "x", None)], "a int, b string, c double"))
    assert [tuple(r) for r in df.collect()] == [("a", "1"), ("b", "x"), ("c", None)]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_batches(spark, partitions):
    df = spark.range(0, 1000, 1, 5).select("id", (F.col("id") * 7919 % 100).alias("t"))
    got = assign_batches(df, ["t", "id"], 30, partitions).orderBy("t", "id").collect()
    assert [r.batch_id for r in got] == [i // 30 for i in range(1000)]


def test_batches_of_equal_keys(spark):
    df = spark.range(0, 1000, 1, 5).select(F.lit(1).alias("t"))
    sizes = sorted(r["count"] for r in assign_batches(df, ["t"], 300).groupBy("batch_id").count().collect())
    assert sizes == [100, 300, 300, 300]


def test_distinct_sketches_merge_over_months(spark, sf_dir):
    from workload import fixtures as fx

    hail = fx.hail(spark, sf_dir).withColumn("ZTIME", F.expr("ZTIME + make_interval(0, int(event_id % 4))")).cache()
    sketches = load.distinct_sketches(hail)
    months = {r.event_month: r for r in load.distinct_estimates(sketches, "event_month").collect()}
    exact = {r.m: r for r in hail.groupBy(F.date_format("ZTIME", "yyyyMM").cast("int").alias("m")).agg(
        *[F.count_distinct(v()).alias(n) for n, v in load.DISTINCT.items()]).collect()}
    assert set(months) == set(exact) and len(months) > 3
    for m, row in months.items():
        for name in load.DISTINCT:
            assert abs(row[f"unique_{name}"] - exact[m][name]) <= load.SKETCH_ERROR * exact[m][name]
    # A month replaced counts once, and months add up to the whole.
    total = hail.agg(*[F.count_distinct(v()).alias(n) for n, v in load.DISTINCT.items()]).first()
    for parts in (sketches, load.merge_sketches(sketches, sketches.filter("event_month % 2 = 0"))):
        whole = load.distinct_estimates(parts).first()
        assert whole.total_records == hail.count()
        for name in load.DISTINCT:
            assert abs(whole[f"unique_{name}"] - total[name]) <= load.SKETCH_ERROR * total[name]


def test_verify_with_sketches(spark, sf_dir):
    from workload import fixtures as fx

    hail = fx.hail(spark, sf_dir)
    assert load.verify_hail(hail, approx=True).first() == load.verify_hail(hail).first()
    text = plan(load.verify_hail(hail, approx=True))
    assert "Expand" not in text and text.count("Exchange") <= 2
    empty = load.verify_hail(hail.limit(0), approx=True).first()
    assert (empty.total_records, empty.unique_days, empty.unique_stations) == (0, 0, 0)
