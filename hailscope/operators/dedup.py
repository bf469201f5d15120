"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """The first row of every key under ``order``.

    Without ``order`` all other columns decide, NULLs last, so that the pick does
    not depend on input order. Spark keeps one row per key in every map task
    before it shuffles (a rank filter is pushed below the exchange), so a key
    with very many copies costs one row per task, not one big group.
    """
    if order is None:
        order = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*(order or keys)))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")
