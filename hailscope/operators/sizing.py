"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailscope.sources.staging import stage

BROADCAST_BYTES = 128 * 1024 * 1024


def _width(c: Column, dtype: T.DataType) -> Column:
    """Bytes a value takes in Spark's row format, rounded up."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, (T.ArrayType, T.StringType, T.BinaryType)):
            inner = F.transform(c, lambda v: _width(v, dtype.elementType))
            total = F.aggregate(inner, F.lit(0), lambda acc, w: acc + w)
            return F.coalesce(total, F.lit(0)) + 32
        fields = len(dtype.elementType.fields) if isinstance(dtype.elementType, T.StructType) else 0
        return F.greatest(F.size(c), F.lit(0)) * (16 + 16 * fields) + 32
    if isinstance(dtype, T.StructType):
        return sum((_width(c[f.name], f.dataType) for f in dtype.fields), F.lit(16))
    return F.lit(16)


def _total(df: DataFrame) -> Column:
    width = sum((_width(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(16))
    return F.sum(width.cast("long")).alias("bytes")


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` in row format *(action: one pass over df)*."""
    return df.agg(_total(df)).first()[0] or 0


def broadcast_within(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it measures at most ``limit`` bytes, else
    as it is, so that the join shuffles *(action on df alone)*."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def stage_measured(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` staged, and its size in row format taken while it is written
    *(action)*."""
    seen = Observation()
    staged = stage(df.observe(seen, _total(df)), name)
    return staged, seen.get["bytes"] or 0
