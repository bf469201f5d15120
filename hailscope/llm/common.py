"""Helpers that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailscope.sources.staging import delete_folder, stage

# The six ASCII white space characters, and the letters that are lower-cased.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Most rows of a table that a join broadcasts, see :func:`attach`.
HOT_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def discard(staged: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more; what was derived from it is staged too."""
    row = staged.select(F.input_file_name().alias("file")).first()
    if row:
        delete_folder(staged.sparkSession, row["file"].rpartition("/")[0])


#: Columns carried through an operator have this in front of their names meanwhile.
CARRIED = "carried_"


def id_text(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and ``text`` (NULL text: empty), and the columns ``keep`` under names that cannot clash."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select("doc_id", text, *(F.col(f"`{c}`").alias(CARRIED + c) for c in keep))


def kept_columns(keep: tuple[str, ...]) -> list[Column]:
    return [F.col(f"`{CARRIED}{c}`").alias(c) for c in keep]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a NULL key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def attach(big: DataFrame, small: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``big`` with ``small``, which is unique by ``on``, safe for hot keys.

    ``weight`` says how many rows of ``big`` a key has, and ``total`` how many
    rows there are. Keys with at least ``total / HOT_ROWS`` rows number
    ``HOT_ROWS`` at most, whatever the data: these are broadcast, and their rows
    are not shuffled. All other keys have few rows each and are shuffled. Both
    inputs are read twice, so stage what is costly.
    """
    heavy = F.col(weight) * HOT_ROWS >= max(total, 1)
    hot = small.filter(heavy)
    cold = small.filter(~heavy)
    by_broadcast = big.join(F.broadcast(hot), on)
    others = big.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return by_broadcast.unionByName(others.hint("merge").join(cold, on))


__all__ = ["HOT_ROWS", "LOWER", "UPPER", "WHITE", "attach", "crc_mod", "discard", "id_text", "kept_columns", "lower_ascii", "stage", "table"]
