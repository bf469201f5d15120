"""Expressions over hail measurements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Missing marker and the two severity limits.
MISSING = -999
DAMAGING_SIZE = 1.0
HIGH_RISK_PROB = 50


def measured(c: Column | str) -> Column:
    """The measurement, NULL where the missing marker stands."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(MISSING))


def missing_count(c: str) -> Column:
    return F.count_if(F.col(c) == MISSING)


def density(count: Column | str, sqmi: Column | str) -> Column:
    """Events per square mile to four places; NULL for an area of zero."""
    count = F.col(count) if isinstance(count, str) else count
    sqmi = F.col(sqmi) if isinstance(sqmi, str) else sqmi
    return F.round(count / F.nullif(sqmi, F.lit(0.0)), 4)


def floored(c: Column, floor: float = 1e-10) -> Column:
    """At least ``floor``; NULL stays NULL (``greatest`` alone would skip it)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))
