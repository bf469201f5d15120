"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_EXTRA=1  adds the hail multiplied by 20 and the edge-by-edge join
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailscope.functions.geometry import contains
from hailscope.operators.dedup import first_per_key
from hailscope.operators.spatial_join import points_in_areas
from hailscope.operators.upsert import upsert
from hailscope.plans.load import verify_hail
from hailscope.plans.risk import event_stats
from hailscope.schemas import HAIL_CSV_COLUMNS, MEASUREMENTS, MERGE_KEYS
from hailscope.sources.staging import release
from workload import fixtures as fx
from workload import registry

HEADLINE = [
    "load_hail",
    "dedup_latest",
    "verify_hail",
    "daily_counts",
    "upsert_hail_raw",
    "point_centroid",
    "area_sqmi",
    "polygon_centroid",
    "points_in_areas",
    "points_in_areas_shuffled",
    "match_equal_areas",
    "subset_county",
    "risk_comparison_bulk",
    "premium_adjustment",
    "worst_day_layer",
    "assign_batches",
]


def _copies(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows for each, the copies at different seconds."""
    many = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return many.withColumn("ZTIME", F.timestamp_add("SECOND", "copy", "ZTIME")).drop("copy")


def _extra() -> dict:
    def hail20(s, d, rev=0):
        return _copies(fx.hail(s, d, rev), 20)

    def pairs20(s, d):
        return points_in_areas(hail20(s, d), fx.counties(s, d), ["area_id"])

    def brute(s, d):
        test = contains("geometry", "LON", "LAT")
        return fx.hail(s, d).crossJoin(fx.counties(s, d)).filter(test).select("event_id", "area_id")

    def upsert20(s, d):
        return upsert(
            hail20(s, d).select(*HAIL_CSV_COLUMNS),
            hail20(s, d, 1),
            MERGE_KEYS["hail_raw"],
            update=MEASUREMENTS,
        )

    return {
        "points_in_areas_brute": brute,
        "points_in_areas_x20": pairs20,
        "county_stats_x20": lambda s, d: event_stats(pairs20(s, d), "area_id"),
        "upsert_hail_raw_x20": upsert20,
        "dedup_x20": lambda s, d: first_per_key(hail20(s, d), MERGE_KEYS["hail_raw"]),
        "verify_hail_x20": lambda s, d: verify_hail(hail20(s, d)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="hailscope-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = registry.queries()
    runs = {name: known[name] for name in HEADLINE}
    if os.environ.get("BENCH_EXTRA"):
        runs |= _extra()

    known["verify_hail"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the session

    seconds = {}
    for name, query in runs.items():
        best = None
        for _ in range(2):  # the first run compiles and warms up
            began = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    release(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "hail_headline_total",
                "value": round(sum(seconds[n] for n in HEADLINE), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").split("sf")[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
