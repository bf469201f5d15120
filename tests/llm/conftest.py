from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, spread over partitions, with more columns if named."""

    def make(pairs, *more, parts=3):
        schema = T.StructType([*DOCS.fields, *(T.StructField(c, T.StringType()) for c in more)])
        rows = [(i, t, "en", "s", len(t or ""), *["x"] * len(more)) for i, t in pairs]
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
