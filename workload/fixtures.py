"""Hail, area and address data derived from the driver tables.

The SQL text is run by Spark and by DuckDB alike, with ``{table}`` standing for
a driver table. Fractions are multiples of powers of two where exact sums matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailscope.operators.shapes import assemble_polygons
from hailscope.schemas import HAIL_CSV_COLUMNS

AS_OF = "2024-07-15"
START, END = "2024-01-05 00:00:00", "2024-01-21 00:00:00"

# Outlines repeated for every key: name -> (columns, rows).
OUTLINES = {
    "county_outline": (
        "ring i ux uy",
        [
            (0, 0, 0.0, 0.0), (0, 1, 2.0, 0.0), (0, 2, 2.0, 0.8), (0, 3, 1.0, 0.8),
            (0, 4, 1.0, 1.6), (0, 5, 0.0, 1.6), (0, 6, 0.0, 0.0),
            (1, 0, 0.2, 0.2), (1, 1, 0.2, 0.6), (1, 2, 0.6, 0.6), (1, 3, 0.6, 0.2),
            (1, 4, 0.2, 0.2),
        ],
    ),
    "state_outline": ("i ux uy", [(0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 0, 0)]),
    "parcel_outline": (
        "part ring i ux uy",
        [
            (0, 0, 0, 0, 0), (0, 0, 1, 6, 0), (0, 0, 2, 6, 3), (0, 0, 3, 3, 3),
            (0, 0, 4, 3, 6), (0, 0, 5, 0, 6), (0, 0, 6, 0, 0),
            (0, 1, 0, 1, 1), (0, 1, 1, 1, 2), (0, 1, 2, 2, 2), (0, 1, 3, 2, 1), (0, 1, 4, 1, 1),
            (1, 0, 0, 7, 7), (1, 0, 1, 8, 7), (1, 0, 2, 8, 8), (1, 0, 3, 7, 8), (1, 0, 4, 7, 7),
        ],
    ),
    # The parcel cut in two, one way or the other; the second half narrower or lower where it is odd.
    "cut_outline": (
        "way part ring i ux uy",
        [
            (0, 0, 0, 0, 0, 0), (0, 0, 0, 1, 3, 0), (0, 0, 0, 2, 3, 6), (0, 0, 0, 3, 0, 6), (0, 0, 0, 4, 0, 0),
            (0, 1, 0, 0, 3, 0), (0, 1, 0, 1, 3, 3), (0, 1, 0, 2, 6, 3), (0, 1, 0, 3, 6, 0), (0, 1, 0, 4, 3, 0),
            (1, 0, 0, 0, 6, 3), (1, 0, 0, 1, 6, 0), (1, 0, 0, 2, 0, 0), (1, 0, 0, 3, 0, 3), (1, 0, 0, 4, 6, 3),
            (1, 1, 0, 0, 0, 3), (1, 1, 0, 1, 3, 3), (1, 1, 0, 2, 3, 6), (1, 1, 0, 3, 0, 6), (1, 1, 0, 4, 0, 3),
            (0, 0, 1, 0, 1, 1), (0, 0, 1, 1, 1, 2), (0, 0, 1, 2, 2, 2), (0, 0, 1, 3, 2, 1), (0, 0, 1, 4, 1, 1),
            (1, 0, 1, 0, 1, 1), (1, 0, 1, 1, 2, 1), (1, 0, 1, 2, 2, 2), (1, 0, 1, 3, 1, 2), (1, 0, 1, 4, 1, 1),
            (0, 2, 0, 0, 7, 7), (0, 2, 0, 1, 8, 7), (0, 2, 0, 2, 8, 8), (0, 2, 0, 3, 7, 8), (0, 2, 0, 4, 7, 7),
            (1, 2, 0, 0, 7, 7), (1, 2, 0, 1, 8, 7), (1, 2, 0, 2, 8, 8), (1, 2, 0, 3, 7, 8), (1, 2, 0, 4, 7, 7),
        ],
    ),
    # Corners with their predecessor (px, py); m = corners in the ring.
    "plot_outline": (
        "part ring m i ux uy px py",
        [
            (0, 0, 6, 0, 0, 0, 0, 6), (0, 0, 6, 1, 6, 0, 0, 0), (0, 0, 6, 2, 6, 3, 6, 0),
            (0, 0, 6, 3, 3, 3, 6, 3), (0, 0, 6, 4, 3, 6, 3, 3), (0, 0, 6, 5, 0, 6, 3, 6),
            (0, 1, 4, 0, 1, 1, 2, 1), (0, 1, 4, 1, 1, 2, 1, 1), (0, 1, 4, 2, 2, 2, 1, 2),
            (0, 1, 4, 3, 2, 1, 2, 2),
            (1, 0, 4, 0, 7, 7, 7, 8), (1, 0, 4, 1, 8, 7, 7, 7), (1, 0, 4, 2, 8, 8, 8, 7),
            (1, 0, 4, 3, 7, 8, 8, 8),
        ],
    ),
}


def _spark_outline(name: str) -> str:
    columns, rows = OUTLINES[name]
    names = columns.split()
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{c}', {v}" for c, v in zip(names, row)) + ")"
        for row in rows
    )
    return f"LATERAL VIEW inline(array({structs})) u AS {', '.join(names)}"


def _duckdb_outline(name: str) -> str:
    columns, rows = OUTLINES[name]
    values = ", ".join("(" + ", ".join(map(str, row)) + ")" for row in rows)
    return f"CROSS JOIN (VALUES {values}) AS u({', '.join(columns.split())})"


def _fill(sql: str, **names: str) -> str:
    for name, text in names.items():
        sql = sql.replace("{" + name + "}", text)
    return sql


def duckdb_sql(sql: str) -> str:
    """A fixture statement as DuckDB runs it, on views named like the tables."""
    outlines = {name: _duckdb_outline(name) for name in OUTLINES}
    return _fill(sql, events="events", nation="nation", customer="customer", **outlines)

# One row per event (rev 0) and a corrected copy of every 20th (rev 1).
HAIL = """
WITH base AS (
 SELECT event_id, date_trunc('second', ts) AS ZTIME,
  CAST(-104 AS DOUBLE) + CAST((event_id*7919) % 120000 AS DOUBLE)/CAST(10000 AS DOUBLE) AS LON,
  CAST(31 AS DOUBLE) + CAST((event_id*104729) % 80000 AS DOUBLE)/CAST(10000 AS DOUBLE) AS LAT,
  concat('K', lpad(CAST(user_id % 40 AS VARCHAR(10)), 3, '0')) AS WSR_ID,
  concat(chr(CAST(65 + event_id % 26 AS INT)), CAST(event_id % 10 AS VARCHAR(10))) AS CELL_ID,
  CAST(event_id % 125 AS INT) AS RANGE_NM,
  CAST((event_id*13) % 360 AS INT) AS AZIMUTH,
  CAST(CASE WHEN event_id % 11 = 0 THEN -999 ELSE (event_id*17) % 101 END AS INT) AS SEVPROB,
  CAST(CASE WHEN event_id % 13 = 0 THEN -999 ELSE (event_id*29) % 101 END AS INT) AS PROB,
  CASE WHEN event_id % 17 = 0 THEN CAST(-999 AS DOUBLE)
       ELSE CAST((event_id*31) % 17 AS DOUBLE)*CAST(0.25 AS DOUBLE) END AS MAXSIZE
 FROM {events})
SELECT 0 AS rev, * FROM base
UNION ALL
SELECT 1 AS rev, event_id, ZTIME, LON, LAT, WSR_ID, CELL_ID, RANGE_NM, AZIMUTH, SEVPROB,
       CAST(100 AS INT) AS PROB, MAXSIZE
FROM base WHERE event_id % 20 = 0
"""

# 25 L-shaped counties on a 5 x 5 grid, every third with a hole.
COUNTY_VERTICES = """
SELECT n_nationkey AS area_id, 0 AS part, ring, i,
 CAST(-104 AS DOUBLE) + CAST(n_nationkey % 5 AS DOUBLE)*CAST(2 AS DOUBLE) + CAST(ux AS DOUBLE) AS x,
 CAST(31 AS DOUBLE) + floor(CAST(n_nationkey AS DOUBLE)/CAST(5 AS DOUBLE))*CAST(1.6 AS DOUBLE) + CAST(uy AS DOUBLE) AS y
FROM {nation} {county_outline}
WHERE ring = 0 OR n_nationkey % 3 = 0
"""

# Five states, each a rectangle over one row of counties.
STATE_VERTICES = """
SELECT k AS state_no, 0 AS part, 0 AS ring, i,
 CAST(-104 AS DOUBLE) + CAST(ux AS DOUBLE)*CAST(10 AS DOUBLE) AS x,
 CAST(31 AS DOUBLE) + CAST(k AS DOUBLE)*CAST(1.6 AS DOUBLE) + CAST(uy AS DOUBLE)*CAST(1.6 AS DOUBLE) AS y
FROM (SELECT DISTINCT CAST(floor(CAST(n_nationkey AS DOUBLE)/CAST(5 AS DOUBLE)) AS INT) AS k FROM {nation}) n
{state_outline}
"""

# 50 postcodes, points inside the lower right arm of one county, some repeated.
ADDRESSES = """
SELECT c_custkey AS address_id, CAST(73000 + pc AS VARCHAR(10)) AS postcode, 'US' AS country,
 concat('S', CAST(CAST(floor(CAST(pc % 25 AS DOUBLE)/CAST(5 AS DOUBLE)) AS INT) AS VARCHAR(10))) AS level0,
 CAST(-104 AS DOUBLE) + CAST(pc % 5 AS DOUBLE)*CAST(2 AS DOUBLE) + CAST(1.125 AS DOUBLE) + CAST(j % 7 AS DOUBLE)/CAST(16 AS DOUBLE) AS LON,
 CAST(31 AS DOUBLE) + floor(CAST(pc % 25 AS DOUBLE)/CAST(5 AS DOUBLE))*CAST(1.6 AS DOUBLE) + CAST(0.125 AS DOUBLE) + CAST(j % 3 AS DOUBLE)/CAST(16 AS DOUBLE) AS LAT
FROM (SELECT c_custkey, c_custkey % 50 AS pc,
             CAST(floor(CAST(c_custkey AS DOUBLE)/CAST(50 AS DOUBLE)) AS BIGINT) AS j FROM {customer}) z
"""

# Seven more counties, rectangles: five of a second country east of the others, each a
# state of its own; one without hail; one without hail or state.
MORE_COUNTIES = """
SELECT n_nationkey AS k, CASE WHEN n_nationkey < 5 THEN 'MX' ELSE 'US' END AS country,
 CASE WHEN n_nationkey < 5 THEN concat('MX-S', CAST(n_nationkey AS VARCHAR(10))) WHEN n_nationkey = 5 THEN 'US-S0' END AS region,
 CASE WHEN n_nationkey < 5 THEN CAST(-94 AS DOUBLE) ELSE CAST(-80 AS DOUBLE) END AS x0,
 CAST(31 AS DOUBLE) + CAST(n_nationkey AS DOUBLE)*CAST(1.6 AS DOUBLE) AS y0
FROM {nation} WHERE n_nationkey < 7
"""

MORE_VERTICES = f"""
SELECT k, 0 AS part, 0 AS ring, i, x0 + CAST(ux AS DOUBLE)*CAST(2 AS DOUBLE) AS x, y0 + CAST(uy AS DOUBLE)*CAST(1.6 AS DOUBLE) AS y
FROM ({MORE_COUNTIES}) z {{state_outline}}
"""

# Their postcodes; those of the second country have numbers that the first has too.
MORE_ADDRESSES = f"""
SELECT c_custkey AS address_id, CAST(CASE WHEN k < 5 THEN 73000 ELSE 74000 END + k AS VARCHAR(10)) AS postcode, country,
 CASE WHEN k < 5 THEN concat('S', CAST(k AS VARCHAR(10))) WHEN k = 5 THEN 'S0' END AS level0,
 x0 + CAST(1 AS DOUBLE) + CAST(c_custkey % 7 AS DOUBLE)/CAST(16 AS DOUBLE) AS LON, y0 + CAST(0.75 AS DOUBLE) AS LAT, k
FROM {{customer}} c JOIN ({MORE_COUNTIES}) z ON c.c_custkey % 50 = z.k
"""

# One parcel per customer: an L, every third with a hole, every fourth with a
# second part.
PARCEL_VERTICES = """
SELECT c_custkey AS parcel_id, part, ring, i,
 CAST(-104 AS DOUBLE) + (CAST(c_custkey % 1000 AS DOUBLE) + CAST(ux AS DOUBLE)/CAST(8 AS DOUBLE))/CAST(64 AS DOUBLE) AS x,
 CAST(31 AS DOUBLE) + (CAST(CAST(floor(CAST(c_custkey AS DOUBLE)/CAST(1000 AS DOUBLE)) AS BIGINT) % 512 AS DOUBLE) + CAST(uy AS DOUBLE)/CAST(8 AS DOUBLE))/CAST(64 AS DOUBLE) AS y
FROM {customer} {parcel_outline}
WHERE (part = 0 AND ring = 0) OR (part = 0 AND c_custkey % 3 = 0) OR (part = 1 AND c_custkey % 4 = 0)
"""

# The parcels drawn anew: the other way round, from another vertex, with the
# middle of every edge as a vertex, parts swapped. Every fifth has another shape.
PLOT_VERTICES = """
WITH corner AS (
 SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 1 - part ELSE part END AS part, ring, m,
  (m + c_custkey % m - i) % m AS j,
  CASE WHEN c_custkey % 5 = 0 AND ux = 6 THEN CAST(5 AS DOUBLE) ELSE CAST(ux AS DOUBLE) END AS ux,
  CAST(uy AS DOUBLE) AS uy,
  CASE WHEN c_custkey % 5 = 0 AND px = 6 THEN CAST(5 AS DOUBLE) ELSE CAST(px AS DOUBLE) END AS px,
  CAST(py AS DOUBLE) AS py
 FROM {customer} {plot_outline}
 WHERE (part = 0 AND ring = 0) OR (part = 0 AND c_custkey % 3 = 0) OR (part = 1 AND c_custkey % 4 = 0)),
drawn AS (
 SELECT k, part, ring, 2*j AS i, ux, uy FROM corner
 UNION ALL SELECT k, part, ring, 2*j + 1 AS i, (ux + px)/CAST(2 AS DOUBLE) AS ux, (uy + py)/CAST(2 AS DOUBLE) AS uy FROM corner
 UNION ALL SELECT k, part, ring, CAST(2*m AS BIGINT) AS i, ux, uy FROM corner WHERE j = 0)
SELECT k AS plot_id, part, ring, i,
 CAST(-104 AS DOUBLE) + (CAST(k % 1000 AS DOUBLE) + ux/CAST(8 AS DOUBLE))/CAST(64 AS DOUBLE) AS x,
 CAST(31 AS DOUBLE) + (CAST(CAST(floor(CAST(k AS DOUBLE)/CAST(1000 AS DOUBLE)) AS BIGINT) % 512 AS DOUBLE) + uy/CAST(8 AS DOUBLE))/CAST(64 AS DOUBLE) AS y
FROM drawn
"""

# The parcels cut in two parts, every seventh with less ground.
CUT_VERTICES = """
SELECT c_custkey AS cut_id, part, ring, i,
 CAST(-104 AS DOUBLE) + (CAST(c_custkey % 1000 AS DOUBLE) + CASE WHEN c_custkey % 7 = 0 AND ux = 6 THEN CAST(5 AS DOUBLE) ELSE CAST(ux AS DOUBLE) END/CAST(8 AS DOUBLE))/CAST(64 AS DOUBLE) AS x,
 CAST(31 AS DOUBLE) + (CAST(CAST(floor(CAST(c_custkey AS DOUBLE)/CAST(1000 AS DOUBLE)) AS BIGINT) % 512 AS DOUBLE) + CAST(uy AS DOUBLE)/CAST(8 AS DOUBLE))/CAST(64 AS DOUBLE) AS y
FROM {customer} {cut_outline}
WHERE way = c_custkey % 2 AND (ring = 0 OR c_custkey % 3 = 0) AND (part < 2 OR c_custkey % 4 = 0)
"""

# Reviewers' answers, several for one postcode, some no valid choice.
DECISIONS = """
SELECT CAST(73000 + c_custkey % 50 AS VARCHAR(10)) AS postcode, 'US' AS country,
 CASE WHEN c_acctbal <= 0 THEN NULL WHEN c_custkey % 50 % 3 <> 0 THEN '' ELSE CASE c_custkey % 7 WHEN 0 THEN 'Reject' WHEN 1 THEN 'Maybe' ELSE 'Confirm' END END AS decision,
 concat('case ', CAST(c_custkey AS VARCHAR(20))) AS reason
FROM {customer}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    names = [t for t in ("events", "nation", "customer") if "{" + t + "}" in sql]
    sql = _fill(sql, **{name: _spark_outline(name) for name in OUTLINES})
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in names})


def hail_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, HAIL).withColumnRenamed("RANGE_NM", "RANGE")


def hail(spark: SparkSession, sf_dir: str, rev: int = 0) -> DataFrame:
    return hail_revisions(spark, sf_dir).filter(F.col("rev") == rev).drop("rev")


def _raw_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hail_revisions(spark, sf_dir)
    text = {c: F.col(c).cast("string") for c in h.columns if c not in ("rev", "event_id")}
    text["ZTIME"] = F.when(F.col("event_id") % 89 == 0, "20241350").otherwise(
        F.date_format("ZTIME", "yyyyMMddHHmmss")
    )
    text["MAXSIZE"] = F.when(F.col("event_id") % 97 == 0, "n/a").otherwise(text["MAXSIZE"])
    return h.select("event_id", *[e.alias(c) for c, e in text.items()])


def hail_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All revisions as raw text fields, some of them broken."""
    return _raw_fields(spark, sf_dir).drop("event_id")


def hail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as lines of a file: some with an eleventh field, cut after six, without a time, or hidden."""
    key = F.col("event_id")
    time = F.when(key % 41 == 0, F.lit("")).otherwise(F.col("ZTIME"))
    raw = _raw_fields(spark, sf_dir).withColumn("ZTIME", time)
    line = F.concat_ws(",", *HAIL_CSV_COLUMNS)
    line = F.when(key % 43 == 0, F.concat(line, F.lit(",7"))).otherwise(line)
    line = F.when(key % 47 == 0, F.substring_index(line, ",", 6)).otherwise(line)
    return raw.select(F.when(key % 53 == 0, F.concat(F.lit("# "), line)).otherwise(line).alias("value"))


def counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_polygons(derive(spark, sf_dir, COUNTY_VERTICES), ["area_id"])


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_polygons(derive(spark, sf_dir, STATE_VERTICES), ["state_no"])


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_polygons(derive(spark, sf_dir, PARCEL_VERTICES), ["parcel_id"])


def plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_polygons(derive(spark, sf_dir, PLOT_VERTICES), ["plot_id"]).withColumnRenamed(
        "geometry", "plot"
    )


def cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_polygons(derive(spark, sf_dir, CUT_VERTICES), ["cut_id"]).withColumnRenamed("geometry", "cut")


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, ADDRESSES).withColumn(
        "address_levels", F.array(F.struct(F.col("level0").alias("value")))
    )


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, DECISIONS)


def division_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counties and states, and a locality per customer."""

    def named(df: DataFrame, prefix: str, key: str, subtype: str, region, name) -> DataFrame:
        return df.select(
            F.concat(F.lit(prefix), key).alias("id"),
            F.concat(F.lit(f"d-{prefix}"), key).alias("division_id"),
            F.lit(subtype).alias("subtype"),
            F.lit("US").alias("country"),
            F.concat(F.lit("US-S"), region.cast("int")).alias("region"),
            F.struct(name.alias("primary")).alias("names"),
            "geometry",
        )

    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("area_id"), "n_name")
    county = counties(spark, sf_dir).join(nation, "area_id")
    areas = named(
        county, "c", "area_id", "county", F.floor(F.col("area_id") / 5), F.col("n_name")
    ).unionByName(
        named(
            states(spark, sf_dir), "s", "state_no", "region", F.col("state_no"),
            F.concat(F.lit("State "), "state_no"),
        )
    )
    return areas.unionByName(
        named(
            parcels(spark, sf_dir), "p", "parcel_id", "locality", F.col("parcel_id") % 5,
            F.concat(F.lit("Parcel "), "parcel_id"),
        )
    )


def both_countries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Divisions, division areas and addresses with the counties, states and postcodes of :data:`MORE_COUNTIES`."""
    more = derive(spark, sf_dir, MORE_COUNTIES).join(
        assemble_polygons(derive(spark, sf_dir, MORE_VERTICES), ["k"]), "k"
    )
    held = more.filter("k < 5")  # each is its state as well

    def areas(rows: DataFrame, prefix: str, subtype: str) -> DataFrame:
        return rows.select(
            F.concat(F.lit(prefix), "k").alias("id"),
            F.concat(F.lit(f"d-{prefix}"), "k").alias("division_id"),
            F.lit(subtype).alias("subtype"),
            "country",
            "region",
            F.struct(F.concat(F.lit(f"{subtype} "), "k").alias("primary")).alias("names"),
            "geometry",
        )

    shapes = areas(more, "x", "county").unionByName(areas(held, "m", "region"))
    named = shapes.select(F.col("division_id").alias("id"), "subtype", "country", "region", "names")
    homes = derive(spark, sf_dir, MORE_ADDRESSES).drop("k").withColumn(
        "address_levels", F.array(F.struct(F.col("level0").alias("value")))
    )
    return (
        divisions(spark, sf_dir).unionByName(named),
        division_areas(spark, sf_dir).unionByName(shapes),
        addresses(spark, sf_dir).unionByName(homes),
    )


def divisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    row = F.floor(F.col("n_nationkey") / 5).cast("int")
    county = nation.select(
        F.concat(F.lit("d-c"), "n_nationkey").alias("id"),
        F.lit("county").alias("subtype"),
        F.concat(F.lit("US-S"), row).alias("region"),
        F.col("n_name").alias("name"),
    )
    state = nation.select(row.alias("k")).distinct().select(
        F.concat(F.lit("d-s"), "k"),
        F.lit("region"),
        F.concat(F.lit("US-S"), "k"),
        F.concat(F.lit("State "), "k"),
    )
    locality = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("d-p"), "c_custkey"),
        F.lit("locality"),
        F.concat(F.lit("US-S"), F.col("c_custkey") % 5),
        F.concat(F.lit("Parcel "), "c_custkey"),
    )
    return county.union(state).union(locality).select(
        "id", "subtype", F.lit("US").alias("country"), "region",
        F.struct(F.col("name").alias("primary")).alias("names"),
    )
