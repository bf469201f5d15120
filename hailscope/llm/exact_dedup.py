"""Exact duplicates by a tree of merges over sorted digest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailscope.llm.common import WHITE, id_text, stage

#: Runs merged into one per round, and rounds: up to FAN_IN ** ROUNDS runs at first.
FAN_IN, ROUNDS = 16, 3
KEY = ["digest", "proof", "length"]


def _best(order: str):
    return F.min(order).alias("best")


def exact_dedup(docs: DataFrame, fan_in: int = FAN_IN, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Every input partition forms one run of digests. In each round ``fan_in`` runs
    merge into one; within a run a digest has one row with its count and the best
    document so far, so a group of copies costs at most one row per run however
    large it is. The answer then walks back down the same tree: each run hands it
    to the runs it was merged from, and the first runs to their own documents.
    So even a group that holds a third of all rows is spread over the runs.

    A digest counts as verified by two further marks of the text, a hash of another
    family and the length, which are part of the key at every level.

    Texts are equal when identical without ASCII white space; NULL is empty. The
    text with the most code points stays, then the smallest ``doc_id`` (NULL last).
    Rows that repeat an id each count; they are ``kept`` if their id stays and
    their length is the longest. An empty table gives no rows. Other columns of
    ``docs`` are not read.
    """
    plain = F.translate(F.col("text"), WHITE, "")
    run = F.spark_partition_id() % fan_in**rounds
    leaves = stage(
        id_text(docs)
        .select("doc_id", F.length("text").alias("size"), plain.alias("plain"))
        .select(
            "doc_id",
            "size",
            F.unhex(F.sha2("plain", 256)).alias("digest"),
            F.xxhash64("plain").alias("proof"),
            F.length("plain").alias("length"),
            run.alias("run"),
        ),
        "exact-leaves",
    )
    order = F.struct((-F.col("size")).alias("minus"), F.col("doc_id").isNull().alias("no_id"), "doc_id")
    levels = [
        stage(
            leaves.withColumn("order", order)
            .groupBy(*KEY, "run")
            .agg(_best("order"), F.count("*").alias("n")),
            "exact-runs",
        )
    ]
    for _ in range(rounds):
        up = levels[-1].withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        levels.append(
            stage(
                up.groupBy(*KEY, "run").agg(_best("best"), F.sum("n").alias("n")),
                "exact-runs",
            )
        )

    known = levels.pop()  # one run is left
    while levels:
        parts = levels.pop().select(*KEY, "run", F.floor(F.col("run") / fan_in).cast("int").alias("up"))
        above = known.withColumnRenamed("run", "up")
        known = parts.join(above, [*KEY, "up"]).drop("up")
    best = F.col("best")
    return leaves.join(known, [*KEY, "run"]).select(
        "doc_id",
        best["doc_id"].alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("doc_id").eqNullSafe(best["doc_id"]) & (F.col("size") == -best["minus"])).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
