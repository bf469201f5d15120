"""Written intermediate results that outlive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir`` or set on the context; an error if neither."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's intermediate results."""
    return f"{checkpoint_root(spark)}/hailscope-stage/{spark.sparkContext.applicationId}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system Spark knows, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)


def release(spark: SparkSession) -> None:
    """Remove all intermediate results of this application; what reads them no longer runs."""
    delete_folder(spark, run_folder(spark))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back *(action)*.

    Cuts the lineage: later jobs, and retries after lost executors, start from
    the files. The files also give Catalyst true sizes for its join choices.
    They stay until :func:`release`.
    """
    path = f"{run_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
