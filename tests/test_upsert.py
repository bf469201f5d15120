from __future__ import annotations

from datetime import datetime

import pytest
from helpers import box, plan
from pyspark.sql import functions as F

from hailscope.operators.upsert import merge_into, merge_table, upsert
from hailscope.plans.load import table_counts
from hailscope.schemas import HAIL_RAW, MEASUREMENTS, MERGE_KEYS, POSTCODE_AREAS, TABLES
from hailscope.sources.tables import (
    cleanup,
    empty_tables,
    ensure_tables,
    list_tables,
    load_table,
    stored_schema,
)

SCHEMA = "k1 int, k2 string, v int, w string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def test_update_insert_keep(spark):
    target = frame(spark, (1, "a", 10, "x"), (2, "b", 20, "y"))
    source = frame(spark, (1, "a", 11, None), (3, "c", 30, "z"))
    assert rows(upsert(target, source, ["k1", "k2"])) == [
        (1, "a", 11, None), (2, "b", 20, "y"), (3, "c", 30, "z"),
    ]
    assert rows(upsert(target, source, ["k1", "k2"], update=["v"], insert=["k1", "k2", "v"])) == [
        (1, "a", 11, "x"), (2, "b", 20, "y"), (3, "c", 30, None),
    ]


def test_null_keys_never_match(spark):
    target = frame(spark, (None, "a", 1, "t"))
    source = frame(spark, (None, "a", 2, "s"), (None, "a", 2, "s"))
    assert rows(upsert(target, source, ["k1", "k2"])) == [
        (None, "a", 1, "t"), (None, "a", 2, "s"), (None, "a", 2, "s"),
    ]


def test_two_source_rows_for_one_target_row_fail(spark):
    target = frame(spark, (1, "a", 1, "t"))
    source = frame(spark, (1, "a", 2, "s"), (1, "a", 3, "s"))
    merged = upsert(target, source, ["k1", "k2"])
    with pytest.raises(Exception, match=r"several source rows for key \(1, a\)"):
        merged.collect()
    with pytest.raises(Exception, match="several source rows"):
        merged.count()


def test_two_source_rows_without_a_target_row_are_inserted(spark):
    target = frame(spark, (1, "a", 1, "t"))
    source = frame(spark, (2, "a", 2, "s"), (2, "a", 3, "s"))
    assert upsert(target, source, ["k1", "k2"]).count() == 3


def test_one_source_row_updates_all_target_copies(spark):
    target = frame(spark, (1, "a", 1, "t"), (1, "a", 2, "u"))
    source = frame(spark, (1, "a", 9, "s"))
    assert rows(upsert(target, source, ["k1", "k2"], update=["v"])) == [(1, "a", 9, "t"), (1, "a", 9, "u")]


def test_twice_is_once(spark):
    target = frame(spark, (1, "a", 10, "x"))
    source = frame(spark, (1, "a", 11, "y"), (3, "c", 30, "z"))
    once = upsert(target, source, ["k1", "k2"])
    assert rows(upsert(once, source, ["k1", "k2"])) == rows(once)


def test_small_source_does_not_move_the_target(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = spark.createDataFrame([(5, 2)], "k long, v int")
    merged = upsert(target, source, ["k"])
    merged.collect()
    final = plan(merged)
    final = final[: final.index("Initial Plan")] if "Initial Plan" in final else final
    assert "SortMergeJoin" not in final and "NestedLoop" not in final


def test_null_and_hot_keys_are_spread(spark):
    third = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id"))
    target = spark.range(0, 3000, 1, 8).select(third.cast("long").alias("k"), F.col("id").alias("v"))
    source = target.filter("k IS NULL OR k <> 7").withColumn("v", F.col("v") + 1)
    source = source.unionByName(spark.createDataFrame([(7, 0)], "k long, v long"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        execution = upsert(target, source, ["k"])._jdf.queryExecution()
        assert execution.toRdd().count() == 4000
        text = execution.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    joins = [line for line in text.splitlines() if "LeftOuter" in line or "LeftAnti" in line]
    assert joins and all("__spread" in line for line in joins)
    assert "skew=true" in text


@pytest.fixture
def db(spark):
    name = "merge_db"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def hail(spark, *data):
    full = [
        (datetime.fromisoformat(t), x, 35.0, "K", "A", 1, 2, s, 50, 1.0) for t, x, s in data
    ]
    schema = "ZTIME timestamp, LON double, LAT double, WSR_ID string, CELL_ID string, RANGE int, AZIMUTH int, SEVPROB int, PROB int, MAXSIZE double"
    return spark.createDataFrame(full, schema)


def test_tables(spark, db):
    ensure_tables(spark, db)
    ensure_tables(spark, db)
    assert {r.tableName for r in list_tables(spark, db).collect()} == set(TABLES)
    for t in TABLES:
        stored = spark.table(f"{db}.{t}").schema
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in stored_schema(t)]


def test_merge_rewrites_only_touched_months(spark, db):
    ensure_tables(spark, db)
    name = f"{db}.hail_raw"
    merge_table(spark, name, hail(spark, ("2024-01-05 00:00:00", 1.0, 10), ("2024-02-05 00:00:00", 2.0, 20)))

    def files(month):
        return {
            r[0] for r in spark.table(name).filter(F.col("event_month") == month)
            .select(F.input_file_name()).distinct().collect()
        }

    january = files(202401)
    merge_table(spark, name, hail(spark, ("2024-02-05 00:00:00", 2.0, 99), ("2024-02-06 00:00:00", 3.0, 30)))
    assert files(202401) == january
    got = {(r.LON, r.SEVPROB, r.postcode) for r in load_table(spark, name).collect()}
    assert got == {(1.0, 10, None), (2.0, 99, None), (3.0, 30, None)}
    merge_table(spark, name, hail(spark))
    assert spark.table(name).count() == 3


def test_merge_of_polygons(spark, db):
    ensure_tables(spark, db)
    name = f"{db}.postcode_areas"
    now = datetime(2024, 1, 1)
    for w in (1, 2):
        source = spark.createDataFrame([("73000", "US", "US-OK", [[box(0, 0, w, 1)]], now)], POSTCODE_AREAS)
        merge_table(spark, name, source)
    got = spark.table(name).collect()
    assert len(got) == 1 and got[0].area[0][0][1].x == 2.0


def test_a_failing_merge_leaves_the_table_whole(spark, db):
    ensure_tables(spark, db)
    name = f"{db}.postcode_areas"
    row = spark.createDataFrame([("1", "US", "US-OK", [[box(0, 0, 1, 1)]], datetime(2024, 1, 1))], POSTCODE_AREAS)
    merge_table(spark, name, row)
    with pytest.raises(Exception, match="several source rows"):
        merge_table(spark, name, row.unionByName(row))
    assert [r.postcode for r in spark.table(name).collect()] == ["1"]


def test_months_are_cut_in_utc(spark, db):
    ensure_tables(spark, db)
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        with pytest.raises(RuntimeError, match="UTC"):
            merge_table(spark, f"{db}.hail_raw", hail(spark, ("2024-01-05 00:00:00", 1.0, 10)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_native_merge_is_refused_by_parquet_tables(spark, db):
    ensure_tables(spark, db)
    with pytest.raises(Exception, match="MERGE"):
        merge_into(f"{db}.hail_raw", hail(spark, ("2024-01-05 00:00:00", 1.0, 10)))


def test_cleanup(spark, db):
    ensure_tables(spark, db)
    source = hail(spark, ("2024-01-05 00:00:00", 1.0, 10))
    merge_table(spark, f"{db}.hail_raw", source)
    merge_table(
        spark, f"{db}.hail_state", source.withColumns({"postcode": F.lit(None).cast("string"), "state_code": F.lit("s")})
    )

    def counts():
        return {r[0]: r[1] for r in table_counts({t: spark.table(f"{db}.{t}") for t in ("hail_raw", "hail_state")}).collect()}

    cleanup(spark, db)
    assert counts() == {"hail_raw": 1, "hail_state": 1}
    cleanup(spark, db, empty=True)
    assert counts() == {"hail_raw": 1, "hail_state": 0}
    cleanup(spark, db, empty_raw=True)
    assert counts() == {"hail_raw": 0, "hail_state": 0}
    cleanup(spark, db, drop=True, empty=True)
    assert list_tables(spark, db).count() == 0
