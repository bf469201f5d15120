"""Exact top-k inner products over buckets of vectors of like length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hailscope.llm.common import stage
from hailscope.operators.batches import assign_batches

#: Steps per unit when components become integers.
SCALE = 1024
#: Rows of a bucket (about) and queries of a block.
BUCKET_ROWS, BLOCK_ROWS = 8192, 1024
#: The longest vectors, which give every query a first threshold.
SEEDS = 2048
#: Local cosine thresholds from which coordinates, rather than lengths alone, prune a bucket.
COORDINATE_FROM, COORDINATES = 0.3, 8
#: Class of a length of 0, below all others.
NO_LENGTH = -1


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as long; NULL for a vector that takes no part."""
    values = vector.cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(values, lambda x: F.floor(x * scale).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; through doubles where these are exact, which is faster."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[-1])
    if most < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _keep(best: tuple, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    scores, ids = np.concatenate([best[0], scores]), np.concatenate([best[1], ids])
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search_bucket(
    queries: np.ndarray, floors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query its up to ``k`` best rows of one bucket with a score of at least its floor.

    ``rows`` are in order of falling length. The local threshold of a query is its floor
    over its own and the bucket's greatest length: above 1 the whole bucket is
    out; a high one prunes by the largest coordinates of the query and what the
    remaining ones can add at most (Cauchy-Schwarz); a low one prunes by length, which
    takes a first part of the rows. What is left is verified with exact products.
    """
    lengths = np.sqrt((rows.astype(float) ** 2).sum(axis=1))
    own = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
    longest = lengths.max(initial=0.0)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    out = [none] * len(queries)
    slack = 1 + 1e-9
    possible = floors <= own * longest * slack
    cosine = np.where(own * longest > 0, floors / np.maximum(own * longest, 1e-300), -1.0)
    narrow = possible & (cosine >= COORDINATE_FROM)
    for q in np.flatnonzero(narrow):
        lead = np.argsort(-np.abs(queries[q]), kind="stable")[:COORDINATES]
        part = rows[:, lead] @ queries[q][lead]
        seen = (rows[:, lead].astype(float) ** 2).sum(axis=1)
        left = np.sqrt(np.maximum(lengths**2 - seen, 0)) * np.sqrt(
            max(own[q] ** 2 - float((queries[q][lead].astype(float) ** 2).sum()), 0)
        )
        at = np.flatnonzero(part + left * slack + 1e-6 >= floors[q])
        scores = rows[at] @ queries[q]
        good = scores >= floors[q]
        out[q] = _keep(none, scores[good], ids[at[good]], k)
    wide = np.flatnonzero(possible & ~narrow)
    if len(wide):
        upto = int(np.searchsorted(-lengths * own[wide].max() * slack, -floors[wide].min(), "right"))
        scores = _dots(queries[wide], rows[:upto])
        for n, q in enumerate(wide):
            at = np.flatnonzero(scores[n] >= floors[q])
            if len(at) > 4 * k:  # the k-th best score, with all its ties
                low = np.partition(scores[n][at], len(at) - k)[len(at) - k]
                at = at[scores[n][at] >= low]
            out[q] = _keep(none, scores[n][at], ids[at], k)
    return out


def _size_class(length: Column) -> Column:
    """Lengths by sixteenths of a doubling; at most 16 * 64 classes, as lengths of whole numbers are."""
    return F.when(length > 0, F.floor(F.log2(length) * 16)).otherwise(NO_LENGTH).cast("int")


def meetings(queries: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a row per (block, bucket) that can hold an answer *(action)*.

    ``queries`` has ``block`` and ``least``, the length from which on a vector can reach a
    query's floor; blocks fall by ``least``. ``candidates`` has ``bucket`` and ``square``;
    buckets fall by length. So a block meets the buckets up to a last one, and a bucket
    the blocks from a first one on. Both follow from tables with a row per class of
    lengths, and nothing else is copied.
    """
    spark = queries.sparkSession
    block_class = _size_class(F.min("least").over(Window.partitionBy("block")) * (1 - 1e-9)).alias("class")
    asked = queries.select("*", block_class)
    longest = F.max("square").over(Window.partitionBy("bucket"))
    held = candidates.select("*", _size_class(F.sqrt(longest) * (1 + 1e-9)).alias("class"))
    last_of = held.groupBy("class").agg(F.max("bucket").alias("last")).collect()
    first_of = asked.groupBy("class").agg(F.min("block").alias("first"), F.max("block").alias("top")).collect()
    classes = {r["class"] for r in (*last_of, *first_of)}
    top = max((r["top"] for r in first_of), default=-1)
    rows = [
        (c, max((r["last"] for r in last_of if r["class"] >= c), default=-1), min((r["first"] for r in first_of if r["class"] <= c), default=top + 1))
        for c in classes
    ]
    bounds = F.broadcast(spark.createDataFrame(rows, "class int, last int, first int"))
    buckets = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("bucket")
    blocks = F.explode(F.sequence(F.col("first"), F.lit(top))).alias("block")
    left = asked.join(bounds, "class").filter("last >= 0").select("key", "v", "floor", "block", buckets)
    right = held.join(bounds, "class").filter(F.col("first") <= top).select("id", "v", "square", "bucket", blocks)
    return left, right


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the highest inner products with each query.

    ``queries`` is a condition on ``vectors``; all other rows are candidates, the
    query's own row is not. Products are exact on whole numbers, ties go to the
    smaller id.

    Equal vectors are one candidate with its ``k + 1`` smallest ids, more of which
    cannot be in an answer (the query may be one of them), and equal queries are
    asked once; so a vector in a third of the rows costs one row per task.
    Candidates are sorted by length into buckets of about ``BUCKET_ROWS``. The
    ``SEEDS`` longest ones give every query a first threshold, its k-th score so far.
    That over its length is the length a better answer must have, by which queries are
    sorted into blocks. A block meets the buckets that hold such a length
    (:func:`meetings`), each once (:func:`search_bucket`): blocks and buckets are fixed in
    size, and their pairs are spread over all tasks.

    NULL vectors, and those with NULL, NaN or infinite components, take no part, nor do
    NULL ids. Shorter vectors count as filled up with zeros. Products that 64 bits may not
    hold are an error. Rows that repeat an id are candidates each but not for queries of
    that id. An empty table gives no rows. Other columns are not read.
    """
    plain = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        whole_numbers(F.col(vector_col), scale).alias("v"),
        queries.alias("asks"),
    )
    plain = stage(plain.filter("id is not null and v is not null"), "vectors")
    largest = F.greatest(F.array_max("v").cast("double"), -F.array_min("v").cast("double"))
    seen = plain.agg(F.max(F.size("v")).alias("width"), F.max(largest).alias("largest")).first()
    width = seen["width"] or 0
    if width * (seen["largest"] or 0.0) ** 2 >= 2**62:
        raise ValueError(f"components up to {seen['largest']:g} after scaling: their products do not fit 64 bits")
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))
    plain = plain.withColumn("v", F.when(F.size("v") < width, F.concat("v", zeros)).otherwise(F.col("v")))
    key = F.sha2(F.concat_ws(",", F.col("v").cast("array<string>")), 256)
    keyed = stage(plain.withColumn("key", key), "keyed-vectors")

    by_id = Window.partitionBy("key").orderBy("id")
    few = keyed.select("key", "v", "id").withColumn("nth", F.row_number().over(by_id)).filter(F.col("nth") <= k + 1)
    square = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    few = few.drop("nth").withColumn("square", square)
    rows = few.count()
    parts = max(1, -(-rows // BUCKET_ROWS))
    sorted_rows = few.repartitionByRange(parts, F.desc("square"), "id")
    candidates = stage(sorted_rows.withColumn("bucket", F.spark_partition_id()), "candidates")

    asked = stage(keyed.filter("asks").groupBy("key").agg(F.first("v").alias("v")), "queries")
    seeds = candidates.orderBy(F.desc("square"), "id").limit(SEEDS).select("id", "v").collect()
    seed_rows = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), width)

    def first_floors(batches):
        for batch in batches:
            q = _matrix(batch.column("v"), width)
            scores = np.sort(_dots(q, seed_rows), axis=1)
            floor = scores[:, -(k + 1)] if scores.shape[1] > k else np.full(len(q), np.iinfo(np.int64).min)
            own = np.sqrt((q.astype(float) ** 2).sum(axis=1))
            least = np.where((own > 0) & (floor > 0), floor / np.maximum(own, 1), 0.0)
            names = ["key", "v", "floor", "less"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor), pa.array(-least)], names)

    with_floor = asked.mapInArrow(first_floors, "key string, v array<long>, floor long, less double")
    blocks = assign_batches(with_floor, ["less", "key"], BLOCK_ROWS)
    blocks = blocks.select("key", "v", "floor", (-F.col("less")).alias("least"), F.col("batch_id").cast("int").alias("block"))

    def meet(q: pa.Table, c: pa.Table) -> pa.Table:
        none = pa.table({"key": pa.array([], pa.string()), "score": pa.array([], pa.int64()), "id": pa.array([], pa.int64())})
        if not q.num_rows or not c.num_rows:
            return none
        c = c.sort_by([("square", "descending"), ("id", "ascending")])
        qv, cv = (_matrix(t["v"].combine_chunks(), width) for t in (q, c))
        found = search_bucket(qv, q["floor"].to_numpy(), cv, c["id"].to_numpy(), k + 1)
        keys = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        return pa.table(
            {
                "key": q["key"].combine_chunks().take(pa.array(keys)),
                "score": pa.array(np.concatenate([f[0] for f in found])),
                "id": pa.array(np.concatenate([f[1] for f in found])),
            }
        )

    pair = ["block", "bucket"]
    left, right = meetings(blocks, candidates)
    met = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(meet, "key string, score long, id long")

    best = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    answers = (
        met.withColumn("nth", F.row_number().over(best))
        .filter(F.col("nth") <= k + 1)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id"))).alias("answers"))
    )
    asks = keyed.filter("asks").select("key", F.col("id").alias("query_id"))
    one = asks.join(answers, "key")
    other = F.slice(F.filter("answers", lambda a: a["id"] != F.col("query_id")), 1, k)
    return one.select("query_id", F.posexplode(other).alias("at", "a")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("a.id").alias("vec_id"),
        (-F.col("a.minus")).alias("score"),
    )
