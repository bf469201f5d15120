"""Load windows and day lists."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailscope.schemas import MONTH_COLUMN


def _month_start(d: date, back: int) -> date:
    months = d.year * 12 + d.month - 1 - back
    return date(months // 12, months % 12 + 1, 1)


def hail_window(end_date: str | date, lookback: int = 3) -> tuple[datetime, datetime]:
    """First instants of the months that bound a load run on ``end_date``.

    The window closes at the start of the month before the run and opens
    ``lookback`` months earlier.
    """
    run = end_date if isinstance(end_date, date) else date.fromisoformat(end_date)
    end = _month_start(run, 1)
    start = _month_start(end, lookback)
    return datetime(start.year, start.month, 1), datetime(end.year, end.month, 1)


def hail_files(
    base: str, end_date: str | date, lookback: int = 3, granularity: str = "month"
) -> list[str]:
    """Paths of the monthly or yearly files a load run has to read."""
    start, end = hail_window(end_date, lookback)
    span = (end.year - start.year) * 12 + end.month - start.month
    months = [_month_start(end.date(), back) for back in range(span, -1, -1)]
    if granularity == "month":
        stamps = [f"{m:%Y%m}" for m in months]
    elif granularity == "year":
        stamps = sorted({f"{m:%Y}" for m in months})
    else:
        raise ValueError(f"granularity must be 'month' or 'year', not {granularity!r}")
    return [f"{base.rstrip('/')}/hail-{s}.csv" for s in stamps]


def window_bounds(day: Column | str, lookback: int = 3) -> tuple[Column, Column]:
    """:func:`hail_window` as column expressions."""
    day = F.col(day) if isinstance(day, str) else day
    end = F.add_months(F.trunc(day, "MM"), -1)
    return F.add_months(end, -lookback), end


def month_number(t: Column) -> Column:
    """``yyyymm`` of a date or timestamp, as hail tables are partitioned."""
    return (F.year(t) * 100 + F.month(t)).cast("int")


def within_months(df: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """``df`` without the months before ``start`` and after ``end``, where it is
    stored by month; other frames come back unchanged.

    Goes beside a filter on the time itself: only the month prunes partitions.
    """
    if MONTH_COLUMN not in df.columns:
        return df
    month = F.col(MONTH_COLUMN)
    if start is not None:
        df = df.filter(month >= month_number(start))
    if end is not None:
        df = df.filter(month <= month_number(end))
    return df


def days_between(start: Column | str, end: Column | str) -> Column:
    """Array of ``yyyyMMdd`` strings from ``start`` to ``end``, both included."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    days = F.when(
        start <= end, F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 day"))
    ).otherwise(F.array().cast("array<date>"))
    return F.transform(days, lambda d: F.date_format(d, "yyyyMMdd"))


def daily_dates(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end`` (ISO dates, both included)."""
    bounds = spark.range(1)
    days = days_between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return bounds.select(F.explode(days).alias("day"))
