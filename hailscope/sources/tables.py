"""Catalog tables: create, list, load, empty, drop."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailscope.functions.dates import month_number
from hailscope.schemas import MONTH_COLUMN, MONTH_PARTITIONED, TABLES
from hailscope.sources.generations import drop_previous


def load_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or Parquet files by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def peek(spark: SparkSession, name_or_path: str, n: int = 5) -> DataFrame:
    """Any ``n`` rows of a table."""
    return load_table(spark, name_or_path).limit(n)


def stored_schema(table: str) -> T.StructType:
    """The table's columns as stored, the month column of hail tables included."""
    if table in MONTH_PARTITIONED:
        return T.StructType([*TABLES[table].fields, T.StructField(MONTH_COLUMN, T.IntegerType())])
    return TABLES[table]


def with_month(df: DataFrame) -> DataFrame:
    """``df`` with the month (``yyyymm``) its rows are stored under."""
    return df.withColumn(MONTH_COLUMN, month_number(F.col("ZTIME")))


def ensure_tables(spark: SparkSession, db: str, tables: Iterable[str] = tuple(TABLES)) -> None:
    """Create the database and the tables where absent *(action)*."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for table in tables:
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in stored_schema(table).fields
        )
        layout = f" PARTITIONED BY ({MONTH_COLUMN})" if table in MONTH_PARTITIONED else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{table} ({columns}) USING parquet{layout}")


def list_tables(spark: SparkSession, db: str) -> DataFrame:
    """Database, name and temporary flag of every table."""
    return spark.sql(f"SHOW TABLES IN {db}")


def empty_tables(spark: SparkSession, db: str, tables: Iterable[str]) -> None:
    """Remove all rows *(action)*."""
    for table in tables:
        spark.sql(f"TRUNCATE TABLE {db}.{table}")


def drop_tables(spark: SparkSession, db: str, tables: Iterable[str]) -> None:
    """Drop tables where present, with the files of their last rewrite *(action)*."""
    present = {r["tableName"] for r in list_tables(spark, db).collect()}
    for table in tables:
        if table in present:
            drop_previous(spark, f"{db}.{table}")
        spark.sql(f"DROP TABLE IF EXISTS {db}.{table}")


def cleanup(
    spark: SparkSession,
    db: str,
    *,
    empty: bool = False,
    empty_raw: bool = False,
    drop: bool = False,
) -> None:
    """Reset the database *(action)*.

    ``drop`` removes every table and wins over the other two; ``empty`` clears
    all but ``hail_raw``; ``empty_raw`` clears ``hail_raw``. No flag, no change.
    """
    if drop:
        drop_tables(spark, db, TABLES)
        return
    if empty:
        empty_tables(spark, db, [t for t in TABLES if t != "hail_raw"])
    if empty_raw:
        empty_tables(spark, db, ["hail_raw"])
