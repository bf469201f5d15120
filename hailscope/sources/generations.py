"""Parquet tables rewritten beside their files, and then pointed at the new ones.

A write goes to a folder that nothing reads. When it is complete, the catalog is told
the new location of the table or of single partitions, one statement each. The
files a table was pointed at before stay until the next rewrite begins, so readers
that were planned before the switch still find them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from hailscope.sources.staging import delete_folder

#: Table properties: the files before the last switch of the table, and the folder of its last rewrite of partitions.
PREVIOUS, REWRITE = "hailscope.previous", "hailscope.rewrite"
#: Lists, in a rewrite's folder, the locations its partitions had before.
SUPERSEDED = "_superseded"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def table_location(spark: SparkSession, name: str, partition: str = "") -> str:
    """Where the catalog says that a table, or a partition of it, is stored."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {partition}")
    # A partition's own location is listed before the table's.
    return next(r["data_type"] for r in described.collect() if r["col_name"] == "Location").rstrip("/")


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    return next((r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect() if r["key"] == key), None)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_quoted(key)} = {_quoted(value)})")


def replace_table(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Make ``rows`` the content of a table without partitions *(action)*."""
    drop_previous(spark, name)
    old = table_location(spark, name)
    new = f"{re.sub('-v[0-9a-f]{32}$', '', old)}-v{uuid.uuid4().hex}"
    rows.write.parquet(new)
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(new)}")
    _set_property(spark, name, PREVIOUS, old)
    spark.catalog.refreshTable(name)


def drop_previous(spark: SparkSession, name: str) -> None:
    """Remove the files that the table was pointed at before its last switch."""
    old = table_property(spark, name, PREVIOUS)
    if old and old != table_location(spark, name):
        delete_folder(spark, old)


def _folder_name(column: str, value: object) -> str:
    return f"{column}={_NO_VALUE if value is None else value}"


def _spec(column: str, value: object) -> str:
    return f"PARTITION ({column} = {'null' if value is None else value})"


def replace_partitions(
    spark: SparkSession, name: str, column: str, values: Sequence[int | None], rows: DataFrame
) -> None:
    """Make ``rows`` the content of the partitions ``values`` of a table *(action)*.

    ``rows`` has rows of these alone; one without any is left empty. They are written once,
    gathered by partition in files of the advisory size, within the table's own
    folder. If the write fails nothing has changed. Then one statement adds the new
    partitions and one each switches the others. If that is interrupted, each partition
    is either as before or as it should be; the error says which.
    """
    try:
        known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        old = {
            v: table_location(spark, name, _spec(column, v)) for v in values if _folder_name(column, v) in known
        }
    except Exception as e:
        raise RuntimeError(f"{name}: its catalog does not keep partitions, so they cannot be switched; nothing is changed") from e
    drop_superseded(spark, name, column)
    folder = f"{table_location(spark, name)}/_rewrite-{uuid.uuid4().hex}"
    rows.hint("rebalance", column).write.partitionBy(column).parquet(folder)
    for v in values:
        where, files = _files(spark, f"{folder}/{_folder_name(column, v)}")
        files.mkdirs(where)  # is there, unless the partition has no rows
    _write_lines(spark, f"{folder}/{SUPERSEDED}", [f"{_folder_name(column, v)} {old[v]}" for v in old])
    _set_property(spark, name, REWRITE, folder)

    def place(value: int | None) -> str:
        return f"{_spec(column, value)} {{}} {_quoted(f'{folder}/{_folder_name(column, value)}')}"

    switched: list[int | None] = []
    try:
        if new := [v for v in values if v not in old]:
            spark.sql(f"ALTER TABLE {name} ADD " + " ".join(place(v).format("LOCATION") for v in new))
            switched += new
        for v in old:
            spark.sql(f"ALTER TABLE {name} {place(v).format('SET LOCATION')}")
            switched.append(v)
    except Exception as e:
        left = [v for v in values if v not in switched]
        raise RuntimeError(
            f"{name}: switched {switched}; still as before: {left}. Every partition is whole, the new rows are in {folder}"
        ) from e
    finally:
        spark.catalog.refreshTable(name)


def drop_superseded(spark: SparkSession, name: str, column: str) -> None:
    """Remove the files that the last rewrite replaced, unless a partition still points at them."""
    folder = table_property(spark, name, REWRITE)
    if not folder:
        return
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for line in _read_lines(spark, f"{folder}/{SUPERSEDED}"):
        part, _, path = line.partition(" ")
        value = part.removeprefix(f"{column}=")
        spec = _spec(column, None if value == _NO_VALUE else value)
        if part not in known or table_location(spark, name, spec) != path:
            delete_folder(spark, path)
            _drop_empty_rewrite(spark, path.rpartition("/")[0], folder)


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _drop_empty_rewrite(spark: SparkSession, path: str, current: str) -> None:
    """Remove the folder of an earlier rewrite when no partition is left in it."""
    where, files = _files(spark, path)
    if where.getName().startswith("_rewrite-") and path != current and files.exists(where):
        if not any(f.isDirectory() for f in files.listStatus(where)):
            files.delete(where, True)


def _write_lines(spark: SparkSession, path: str, lines: Sequence[str]) -> None:
    where, files = _files(spark, path)
    out = files.create(where, True)
    try:
        out.write(bytearray("\n".join(lines).encode()))
    finally:
        out.close()


def _read_lines(spark: SparkSession, path: str) -> list[str]:
    """Lines of a small file; none if it is gone."""
    where, files = _files(spark, path)
    if not files.exists(where):
        return []
    content = bytes(files.open(where).readAllBytes()).decode()
    return [line for line in content.split("\n") if line]
