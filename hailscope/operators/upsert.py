"""MERGE for tables without row-level updates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailscope.schemas import (
    MERGE_INSERTS,
    MERGE_KEYS,
    MERGE_UPDATES,
    MONTH_COLUMN,
    MONTH_PARTITIONED,
)
from hailscope.sources.generations import replace_partitions, replace_table
from hailscope.sources.staging import stage
from hailscope.sources.tables import with_month


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _spread_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Extra join column that scatters rows with a NULL key.

    They match nothing but would all hash to one task. The id of the task that
    read them tells copies apart and is the same on a retry.
    """
    return df.withColumn("__spread", F.when(_any_null(keys), F.spark_partition_id()).otherwise(-1))


def _counted(df: DataFrame, keys: Sequence[str], *values: Column) -> DataFrame:
    """One row per key with its count ``__n`` and the ``__spread`` of whole keys.

    The -1 is derived from the count: a literal would be folded into a filter and
    vanish from the join keys.
    """
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *values)
    return grouped.withColumn("__spread", F.least(F.col("__n"), F.lit(0)).cast("int") - 1)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Sequence[str] | str = "*",
    insert: Sequence[str] | str = "*",
) -> DataFrame:
    """``target`` after a merge of ``source``.

    Keys compare with ``=``: a NULL key never matches and is inserted. A match
    overwrites the ``update`` columns, other source rows are inserted with the
    ``insert`` columns (the rest NULL), other target rows stay. A target row
    matched by several source rows fails the query when it runs.

    The source is grouped by key before it meets the target, so many copies of
    one key shrink before the shuffle and a small source is broadcast by its
    own statistics without moving the target. A target key with many rows is on
    the streamed side of both joins, where AQE may split it.
    """
    keys = list(keys)
    columns = target.columns
    update = [c for c in columns if c not in keys] if update == "*" else list(update)
    insert = columns if insert == "*" else list(insert)

    changes = _counted(
        source.filter(~_any_null(keys)), keys, *[F.first(c).alias(f"__new_{c}") for c in update]
    )
    merged = _spread_nulls(target, keys).join(changes, [*keys, "__spread"], "left")
    clash = F.raise_error(
        F.concat(
            F.lit("upsert: several source rows for key ("),
            F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]),
            F.lit(")"),
        )
    ).cast("boolean")
    matched = F.col("__n").isNotNull()
    kept = merged.filter((F.coalesce("__n", F.lit(1)) == 1) | clash).select(
        *[
            F.when(matched, F.col(f"__new_{c}").cast(target.schema[c].dataType))
            .otherwise(F.col(c))
            .alias(c)
            if c in update
            else F.col(c)
            for c in columns
        ]
    )

    known = _counted(
        target.select(*keys).join(source.select(*keys), keys, "left_semi"), keys
    )
    fresh = (
        _spread_nulls(source, keys)
        .join(known, [*keys, "__spread"], "left_anti")
        .select(
            *[
                (F.col(c) if c in insert else F.lit(None)).cast(target.schema[c].dataType).alias(c)
                for c in columns
            ]
        )
    )
    return kept.unionByName(fresh)


def merge_table(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    *,
    keys: Sequence[str] | None = None,
    update: Sequence[str] | str | None = None,
    insert: Sequence[str] | str | None = None,
) -> None:
    """Merge ``source`` into the Parquet table ``db.table`` *(action)*.

    Keys and columns default to the table's own. Monthly tables are read and
    rewritten only in the months present in the source. The source is staged, as the
    merge reads it more than once. The merged rows are written once, to a new folder;
    then the table, or each touched month, is pointed there (see
    :mod:`hailscope.sources.generations`). So a table and every month of it are whole
    at any time, and a merge that was interrupted is mended by running it again. One
    writer at a time is assumed, and the session's time zone has to be UTC, in which
    months are cut.
    """
    table = name.split(".")[-1]
    keys = keys or MERGE_KEYS[table]
    update = MERGE_UPDATES.get(table, "*") if update is None else update
    insert = MERGE_INSERTS.get(table, "*") if insert is None else insert
    if (zone := spark.conf.get("spark.sql.session.timeZone")) not in ("UTC", "Etc/UTC"):
        raise RuntimeError(f"merge_table: the session's time zone is {zone}, not UTC")
    target = spark.table(name)
    if table not in MONTH_PARTITIONED:
        source = stage(source, f"{table}-source")
        merged = upsert(target, source, keys, update=update, insert=insert)
        replace_table(spark, name, merged.select(*target.columns))
        return

    source = stage(with_month(source), f"{table}-source")
    # One value per month of data: the list stays in the hundreds.
    months = [r[0] for r in source.select(MONTH_COLUMN).distinct().collect()]
    if not months:
        return
    part = F.col(MONTH_COLUMN)
    touched = part.isin([m for m in months if m is not None])
    if None in months:
        touched = touched | part.isNull()
    insert = insert if insert == "*" else [*insert, MONTH_COLUMN]
    merged = upsert(target.filter(touched), source, keys, update=update, insert=insert)
    replace_partitions(spark, name, MONTH_COLUMN, months, merged.select(*target.columns))


def merge_into(
    name: str,
    source: DataFrame,
    *,
    keys: Sequence[str] | None = None,
    update: Sequence[str] | str | None = None,
    insert: Sequence[str] | str | None = None,
) -> None:
    """The same merge as the engine's own MERGE, for catalogs with row-level
    operations *(action)*."""
    table = name.split(".")[-1]
    keys = keys or MERGE_KEYS[table]
    update = MERGE_UPDATES.get(table, "*") if update is None else update
    insert = MERGE_INSERTS.get(table, "*") if insert is None else insert
    if table in MONTH_PARTITIONED:
        source = with_month(source)
        insert = insert if insert == "*" else [*insert, MONTH_COLUMN]
    on = reduce(and_, [F.col(f"{name}.{k}") == F.col(f"s.{k}") for k in keys])
    merge = source.alias("s").mergeInto(name, on)
    matched, unmatched = merge.whenMatched(), merge.whenNotMatched()
    merge = (
        matched.updateAll()
        if update == "*"
        else matched.update({c: F.col(f"s.{c}") for c in update})
    )
    merge = (
        unmatched.insertAll()
        if insert == "*"
        else unmatched.insert({c: F.col(f"s.{c}") for c in insert})
    )
    merge.merge()
