"""Lines that many documents share are kept in one document only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailscope.llm.common import WHITE, attach, id_text, kept_columns, lower_ascii, stage

MIN_CHARS, MIN_DOCS = 40, 5
ROW = ["doc_id", "text_mark"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_dedup(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` and the columns ``keep``: each document without its shared lines.

    Lines are keyed by their text, stripped at both ends and lower-cased (ASCII).
    A key of at least ``min_chars`` code points in at least ``min_docs`` documents
    stays in the document with the largest id and leaves all others. The key is
    hashed to 128 bits; occurrences (id, position, hash) are staged, counted per
    hash with partial aggregation, joined back with :func:`attach` so that a line
    in a third of all documents is not shuffled, and the positions of one document
    are taken out of its line array.

    Documents with the same id count as one for the threshold; each row is cut on
    its own. A NULL id is one id and smaller than all others. NULL text is one empty line,
    repeated rows each come back, an empty table gives no rows, and columns not
    named in ``keep`` are not read.
    """
    texts = id_text(docs, keep).withColumn("text_mark", F.xxhash64("text"))
    key = lower_ascii(F.btrim(F.col("line"), F.lit(WHITE)))
    seen = stage(
        texts.select(*ROW, F.posexplode(_lines(F.col("text"))).alias("at", "line"))
        .select(*ROW, "at", key.alias("key"))
        .filter(F.length("key") >= min_chars)
        .select(*ROW, "at", F.unhex(F.md5("key")).alias("hash")),
        "lines",
    )
    per_doc = seen.groupBy("hash", "doc_id").agg(F.count("*").alias("n"))
    shared = stage(
        per_doc.groupBy("hash")
        .agg(F.count("*").alias("docs"), F.sum("n").alias("n"), F.max("doc_id").alias("keep_id"))
        .filter(F.col("docs") >= min_docs)
        .drop("docs"),
        "shared-lines",
    )
    dropped = (
        attach(seen, shared, ["hash"], "n", seen.count())
        .filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy(*ROW)
        .agg(F.collect_set("at").alias("gone"))
        .withColumnsRenamed({"doc_id": "gone_id", "text_mark": "gone_mark"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_mark") == F.col("gone_mark"))
    lines = F.col("lines")
    kept_at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(kept_at, lambda i: F.get(lines, i)), "\n")
    )
    return (
        texts.join(dropped, same, "left")
        .withColumn("lines", _lines(F.col("text")))
        .select(
            "doc_id",
            kept.alias("text"),
            F.size(lines).cast("long").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
            *kept_columns(keep),
        )
    )
