"""Ordered batches of fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hailscope.operators.sizing import stage_measured
from hailscope.sources.staging import stage

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row number below


#: Row-format bytes that one range of rows is meant to hold.
RANGE_BYTES = 64 * 1024 * 1024


def assign_batches(
    df: DataFrame,
    order: Sequence[str],
    size: int,
    partitions: int | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """``df`` with ``batch_id``: rows in ``order``, cut every ``size`` rows.

    The input is staged and its bytes observed on the way *(action)*: there are as many
    ranges as hold ``range_bytes`` each, whatever the session's shuffle setting, and the
    pass that samples the bounds reads the staged rows. Rows are range-partitioned
    and sorted, numbered inside their partition and staged again, so the numbering is
    fixed before it is counted. Equal keys are spread over partitions by the task that
    read them. Only one row per partition meets in the window that adds the partition
    sizes up.
    """
    if size < 1:
        raise ValueError(f"size must be positive, not {size}")
    by = [F.col(c).asc_nulls_last() for c in order]
    tied, seen = stage_measured(df.withColumn("__tie", F.spark_partition_id()), "batches-input")
    n = partitions or max(1, -(-seen // range_bytes))
    ranged = tied.repartitionByRange(n, *by, F.col("__tie")).sortWithinPartitions(*by, "__tie")
    mid = F.monotonically_increasing_id()
    numbered = stage(
        ranged.withColumns(
            {
                "__part": F.shiftright(mid, _POSITION_BITS),
                "__row": mid.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
            }
        ).drop("__tie"),
        "batches",
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("__part")
        .count()
        .select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    )
    batch = F.floor((F.col("__offset") + F.col("__row")) / size).alias("batch_id")
    return numbered.join(F.broadcast(offsets), "__part").select(*df.columns, batch)
