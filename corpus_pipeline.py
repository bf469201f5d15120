"""The corpus pipeline: from raw documents to packed token sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailscope.llm import line_dedup, packing, quality, simhash, substring
from hailscope.llm.common import stage, table

CARRY = ("lang", "source")
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(cut: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text that is left."""
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines look good; the model is fitted on labels of this corpus."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, model, keep=CARRY)
    return _documents(scored.filter(F.col("score") >= quality.GOOD_FROM))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many share; a document may be left empty."""
    return _documents(line_dedup.line_dedup(docs, keep=CARRY))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs).select(*COLUMNS)


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occur elsewhere; words are joined by one space."""
    return _documents(substring.substring_dedup(docs, keep=CARRY))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("substring_dedup", dedup_substrings),
    ("packing", pack),
]

#: A field model and token ids are beyond SQL: tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
