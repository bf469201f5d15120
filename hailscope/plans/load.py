"""Loading and checking hail reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailscope.functions.dates import month_number, within_months
from hailscope.functions.measurements import measured, missing_count
from hailscope.operators.dedup import first_per_key
from hailscope.schemas import BROKEN_LINE, HAIL_TYPES, MEASUREMENTS, MERGE_KEYS, MONTH_COLUMN

Instant = str | datetime


def instant(t: Instant) -> Column:
    """Timestamp literal in the session's time zone."""
    return F.lit(t if isinstance(t, str) else t.isoformat(sep=" ")).cast("timestamp")


def filter_window(df: DataFrame, start: Instant, end: Instant, column: str = "ZTIME") -> DataFrame:
    """Rows with ``start <= ZTIME <= end``.

    The end is an instant: a midnight lets only 00:00:00 of that day pass.
    """
    stored = within_months(df, instant(start), instant(end)) if column == "ZTIME" else df
    return stored.filter(F.col(column).between(instant(start), instant(end)))


def filter_day(df: DataFrame, day: str, column: str = "ZTIME") -> DataFrame:
    """Rows of one ``yyyyMMdd`` day, for 14-digit string stamps."""
    return df.filter(F.col(column).between(f"{day}000000", f"{day}235959"))


def filter_date(df: DataFrame, day: str, column: str = "ZTIME") -> DataFrame:
    """Rows of one ISO day, as a half-open range that scans can use."""
    start = F.lit(day).cast("date")
    stored = within_months(df, start, start) if column == "ZTIME" else df
    return stored.filter(
        (F.col(column) >= start.cast("timestamp"))
        & (F.col(column) < F.date_add(start, 1).cast("timestamp"))
    )


def parse_hail(csv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and the raw rows that are broken.

    A row is broken if a value does not parse, a key column is NULL, or its line
    had another number of fields. Values are parsed once, behind a generator.
    """
    typed = F.struct(
        *[
            (
                F.try_to_timestamp(c, F.lit("yyyyMMddHHmmss"))
                if c == "ZTIME"
                else F.col(c).try_cast(dtype)
            ).alias(c)
            for c, dtype in HAIL_TYPES.items()
        ]
    )
    raw = csv.columns
    parsed = csv.select("*", F.explode(F.array(typed)).alias("__typed"))
    tests = [F.col(c).isNotNull() & F.col(f"__typed.{c}").isNull() for c in HAIL_TYPES]
    tests += [F.col(c).isNull() for c in MERGE_KEYS["hail_raw"]]
    if BROKEN_LINE in raw:
        tests.append(F.col(BROKEN_LINE).isNotNull())
    broken = reduce(or_, tests)
    return parsed.filter(~broken).select("__typed.*"), parsed.filter(broken).select(*raw)


def best_measured() -> list[Column]:
    """Order of copies of one report: fewest missing measurements, then the larger ones."""
    missing = reduce(add, [F.coalesce(measured(c).isNull().cast("int"), F.lit(1)) for c in MEASUREMENTS])
    others = [F.col(c).asc_nulls_last() for c in HAIL_TYPES if c not in (*MEASUREMENTS, *MERGE_KEYS["hail_raw"])]
    return [missing.asc(), *(measured(c).desc_nulls_last() for c in MEASUREMENTS), *others]


def load_hail(csv: DataFrame, start: Instant, end: Instant) -> tuple[DataFrame, DataFrame]:
    """Typed reports of the window, one per key, and the rejected raw rows."""
    rows, rejects = parse_hail(csv)
    chosen = first_per_key(filter_window(rows, start, end), MERGE_KEYS["hail_raw"], best_measured())
    return chosen, rejects


#: Registers of a distinct-count sketch, as a power of two, and the relative error that an
#: estimate keeps within, three standard errors of 1.04 / sqrt(registers).
SKETCH_BITS = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)

DISTINCT = {
    "days": lambda: F.to_date("ZTIME").cast("string"),
    "stations": lambda: F.col("WSR_ID"),
    "cells": lambda: F.concat_ws("/", "WSR_ID", "CELL_ID"),
    "places": lambda: F.concat_ws("/", F.col("LON").cast("string"), F.col("LAT").cast("string")),
}


def distinct_sketches(hail: DataFrame) -> DataFrame:
    """``(event_month, n, days, stations, cells, places)``: a row per month with its distinct-count sketches.

    A sketch takes a few kilobytes however many reports there are, and sketches of
    months merge, so after a correction only the touched months are sketched anew.
    Missing values are not counted.
    """
    month = month_number(F.col("ZTIME")).alias(MONTH_COLUMN)
    sketches = [F.hll_sketch_agg(value(), SKETCH_BITS).alias(name) for name, value in DISTINCT.items()]
    return hail.groupBy(month).agg(F.count(F.lit(1)).alias("n"), *sketches)


def merge_sketches(sketches: DataFrame, fresh: DataFrame) -> DataFrame:
    """``sketches`` with the months that are in ``fresh`` taken from there."""
    return sketches.join(fresh, MONTH_COLUMN, "left_anti").unionByName(fresh)


def distinct_estimates(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct counts over all months, or per ``by``, from sketches alone.

    Each is within ``SKETCH_ERROR`` of the exact count in all but 0.3 % of cases.
    """
    merged = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(f"unique_{name}") for name in DISTINCT]
    return sketches.groupBy(*by).agg(F.sum("n").alias("total_records"), *merged)


def verify_hail(hail: DataFrame, approx: bool = False) -> DataFrame:
    """One row on the loaded data: extent, missing values, sizes.

    Partial figures per day and station come first. They answer both distinct
    counts without holding every row once per count, and are few. With ``approx``
    there are none: one pass with sketches of fixed size, for keys without bound;
    the distinct counts are then estimates, see :func:`distinct_estimates`.
    """
    if approx:
        return _verified(hail.agg(*_verify_partials(), *_verify_sketches()), approx)
    daily = hail.groupBy(F.to_date("ZTIME").alias("day"), "WSR_ID").agg(*_verify_partials())
    return _verified(daily, approx)


def _verify_sketches() -> list[Column]:
    return [F.hll_sketch_agg(DISTINCT[name](), SKETCH_BITS).alias(name) for name in ("days", "stations")]


def _verify_partials() -> list[Column]:
    size = measured("MAXSIZE")
    return [
        F.count(F.lit(1)).alias("n"),
        F.min("ZTIME").alias("first"),
        F.max("ZTIME").alias("last"),
        missing_count("SEVPROB").alias("no_sevprob"),
        missing_count("PROB").alias("no_prob"),
        missing_count("MAXSIZE").alias("no_size"),
        F.sum(size).alias("size_sum"),
        F.count(size).alias("size_n"),
        F.max(size).alias("size_max"),
    ]


def _verified(partials: DataFrame, approx: bool) -> DataFrame:
    def distinct(exact: str, sketch: str) -> Column:
        return F.hll_sketch_estimate(F.hll_union_agg(sketch)) if approx else F.count_distinct(exact)

    total = [F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "no_sevprob", "no_prob", "no_size")]
    mean = F.sum("size_sum") / F.nullif(F.sum("size_n"), F.lit(0))
    return partials.agg(
        total[0].alias("total_records"),
        F.min("first").alias("earliest_date"),
        F.max("last").alias("latest_date"),
        distinct("day", "days").alias("unique_days"),
        distinct("WSR_ID", "stations").alias("unique_stations"),
        total[1].alias("missing_sevprob"),
        total[2].alias("missing_prob"),
        total[3].alias("missing_maxsize"),
        F.round(mean, 3).alias("avg_hail_size"),
        F.max("size_max").alias("max_hail_size"),
    )


def daily_counts(hail: DataFrame, n: int = 10) -> DataFrame:
    """Reports per day, the newest ``n`` days first."""
    days = hail.groupBy(F.to_date("ZTIME").alias("date")).agg(F.count(F.lit(1)).alias("events"))
    return days.orderBy(F.desc("date")).limit(n)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, one row each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def transpose_summary(row: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A summary row turned upright: ``(metric, value)`` with values as text."""
    columns = list(columns or row.columns)
    text = row.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return text.unpivot([], columns, "metric", "value")
