"""The registered query of each operator: production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailscope.llm import exact_dedup, html, jaccard, lattice, line_dedup, lm, manifest, packing, quality, simhash, substring, topk, variants
from hailscope.llm.common import crc_mod, table


def _sha256(text: str):
    return F.lower(F.sha2(F.col(text), 256)).alias("kept_sha256")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = lm.count_words(docs)
    return lm.score_documents(docs, counts, lm.train(docs, counts))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).select(
        "doc_id",
        (crc_mod(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= quality.GOOD_FROM).cast("int").alias("predicted"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", _sha256("text"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", _sha256("text"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    out = packing.pack(table(spark, sf_dir, "documents"), path)
    return out.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.train(pages))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text, and whether decoding them gives the text back."""
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    out = lattice.decode(lattice.encode(docs, path), path)
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 2).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every row, and whether it still holds after tampering with a third of them."""
    out = manifest.manifest(table(spark, sf_dir, "documents"))
    folded = manifest.fold(F.coalesce("forged", "leaf"), F.col("path")).alias("folded_root")
    proof = F.sha2(manifest.siblings(F.col("path")), 256).alias("proof_sha256")
    out = out.select("doc_id", "leaf", "subroot", "root", proof, folded)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_ALL = (
    op1_lm_scoring,
    op2_quality_classifier,
    op3_substring_dedup,
    op4_line_dedup,
    op5_packing,
    op6_top_k,
    op7_html_extraction,
    op8_simhash_dedup,
    op9_exact_dedup,
    op10_sentencepiece,
    op11_spelling_variants,
    op12_jaccard_join,
    op13_merkle_manifest,
)
QUERIES = {f.__name__: f for f in _ALL}
