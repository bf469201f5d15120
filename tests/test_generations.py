"""Tables and months are whole at any time while they are rewritten."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hailscope.operators.upsert import merge_table
from hailscope.sources import generations
from hailscope.sources.tables import drop_tables, empty_tables, ensure_tables

NAME = "months_db.hail_raw"


@pytest.fixture
def table(spark):
    spark.sql("DROP DATABASE IF EXISTS months_db CASCADE")
    ensure_tables(spark, "months_db")
    yield NAME
    spark.sql("DROP DATABASE IF EXISTS months_db CASCADE")


def hail(spark, *data):
    rows = [(datetime.fromisoformat(t) if t else None, x, 35.0, "K", "A", 1, 2, s, 50, 1.0) for t, x, s in data]
    schema = "ZTIME timestamp, LON double, LAT double, WSR_ID string, CELL_ID string, RANGE int, AZIMUTH int, SEVPROB int, PROB int, MAXSIZE double"
    return spark.createDataFrame(rows, schema)


def content(spark):
    return {(r.event_month, r.LON, r.SEVPROB) for r in spark.table(NAME).collect()}


JAN, FEB, MAR = "2024-01-05 00:00:00", "2024-02-05 00:00:00", "2024-03-05 00:00:00"


def where(spark, month):
    return generations.table_location(spark, NAME, f"PARTITION (event_month = {month})").removeprefix("file:")


def test_months_are_switched_and_the_rest_stays(spark, table):
    merge_table(spark, table, hail(spark, (JAN, 1.0, 10), (FEB, 2.0, 20), (None, 9.0, 90)))
    january, february = where(spark, 202401), where(spark, 202402)
    before = spark.table(table).filter("event_month = 202402")
    planned = before.inputFiles()
    merge_table(spark, table, hail(spark, (FEB, 2.0, 21), (MAR, 3.0, 30), (None, 9.0, 91)))
    # A NULL key matches nothing, so both rows without a time are there.
    assert content(spark) == {(202401, 1.0, 10), (202402, 2.0, 21), (202403, 3.0, 30), (None, 9.0, 90), (None, 9.0, 91)}
    assert where(spark, 202401) == january and where(spark, 202402) != february
    assert all(Path(f.removeprefix("file://")).exists() for f in planned)  # earlier readers still find their files
    merge_table(spark, table, hail(spark, (MAR, 3.0, 31)))
    assert not Path(february).exists() and Path(january).exists()
    assert content(spark) >= {(202401, 1.0, 10), (202402, 2.0, 21), (202403, 3.0, 31)}


def test_a_failing_write_leaves_every_month_whole(spark, table):
    merge_table(spark, table, hail(spark, (JAN, 1.0, 10), (FEB, 2.0, 20)))
    before = content(spark)
    places = where(spark, 202401), where(spark, 202402)
    twice = hail(spark, (JAN, 1.0, 11), (FEB, 2.0, 21), (FEB, 2.0, 22))
    with pytest.raises(Exception, match="several source rows"):
        merge_table(spark, table, twice)
    assert content(spark) == before
    assert (where(spark, 202401), where(spark, 202402)) == places


def test_an_interrupted_switch_leaves_every_month_whole_and_can_be_repeated(spark, table, monkeypatch):
    merge_table(spark, table, hail(spark, (JAN, 1.0, 10), (FEB, 2.0, 20)))
    source = hail(spark, (JAN, 1.0, 11), (FEB, 2.0, 21), (MAR, 3.0, 31))
    run, left = type(spark).sql, ["ADD", "SET LOCATION"]

    def sql(self, text, *args, **more):
        if "PARTITION (event_month" in text and "LOCATION '" in text:
            if not left:
                raise RuntimeError("the catalog is gone")
            left.pop(0)
        return run(self, text, *args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", sql)
        with pytest.raises(RuntimeError, match="Every partition is whole"):
            merge_table(spark, table, source)
    mixed = content(spark)
    assert (202403, 3.0, 31) in mixed and len(mixed) == 3
    assert {(m, x) for m, x, _ in mixed} == {(202401, 1.0), (202402, 2.0), (202403, 3.0)}
    merge_table(spark, table, source)
    assert content(spark) == {(202401, 1.0, 11), (202402, 2.0, 21), (202403, 3.0, 31)}


def test_a_catalog_without_partitions_is_refused_before_anything_is_written(spark, table, monkeypatch):
    merge_table(spark, table, hail(spark, (JAN, 1.0, 10)))
    run = type(spark).sql

    def sql(self, text, *args, **more):
        if text.startswith("SHOW PARTITIONS"):
            raise RuntimeError("not kept")
        return run(self, text, *args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", sql)
        with pytest.raises(RuntimeError, match="nothing is changed"):
            merge_table(spark, table, hail(spark, (JAN, 1.0, 11)))
    assert content(spark) == {(202401, 1.0, 10)}


def test_plain_tables_keep_one_generation(spark, table):
    name, folders = "months_db.risk_comparison", []
    for size in (1, 2, 3):
        rows = spark.table(name).schema
        source = spark.createDataFrame([("county", "1", "US", size, *[None] * 10, None)], rows)
        merge_table(spark, name, source)
        folders.append(Path(generations.table_location(spark, name).removeprefix("file:")))
    assert [f.exists() for f in folders] == [False, True, True]
    assert [r.event_count for r in spark.table(name).collect()] == [3]
    drop_tables(spark, "months_db", ["risk_comparison", "hail_events", "no_such_table"])
    assert [f.exists() for f in folders] == [False, False, False]


def test_emptied_and_dropped_months_leave_no_files(spark, table):
    merge_table(spark, table, hail(spark, (JAN, 1.0, 10)))
    merge_table(spark, table, hail(spark, (JAN, 1.0, 11)))
    home = Path(generations.table_location(spark, table).removeprefix("file:"))
    empty_tables(spark, "months_db", ["hail_raw"])
    assert content(spark) == set()
    merge_table(spark, table, hail(spark, (JAN, 1.0, 12)))
    assert content(spark) == {(202401, 1.0, 12)}
    assert spark.table(table).filter(F.col("event_month") == 202401).count() == 1
    drop_tables(spark, "months_db", ["hail_raw"])
    assert not home.exists()
