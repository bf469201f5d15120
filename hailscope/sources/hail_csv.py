"""Hail CSV files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hailscope.schemas import BROKEN_LINE, HAIL_CSV


def read_hail_csv(
    spark: SparkSession, paths: str | Iterable[str], options: Mapping[str, str] | None = None
) -> DataFrame:
    """Ten string columns from headerless files with ``#`` comment lines, and ``broken_line``.

    All paths go into one scan. Blank lines are dropped. A line with another number of
    fields than ten is kept whole in ``broken_line``, which is NULL otherwise. ``options`` reach the file system as well, e.g.
    ``{"fs.s3a.aws.credentials.provider":
    "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"}`` for a public
    bucket read without credentials.
    """
    schema = T.StructType([*HAIL_CSV.fields, T.StructField(BROKEN_LINE, T.StringType())])
    reader = spark.read.schema(schema).option("comment", "#").option("columnNameOfCorruptRecord", BROKEN_LINE)
    # All fields are read and counted, whichever columns are used.
    reader = reader.option("columnPruning", False).options(**(options or {}))
    return reader.csv([paths] if isinstance(paths, str) else list(paths))
