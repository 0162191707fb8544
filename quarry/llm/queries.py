"""The registered queries of this subpackage: each operator over its whole
table with production parameters, and the SQL of those that SQL can express.
Each callable takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (cap_filters, fingerprints, langid, lm, mixing, packing, quality, residues, simhash, substrings,
                        subvectors, token_counts, toxicity)
from quarry.llm.common import fold
from quarry.sources.tables import read_table

QUALITY_THRESHOLD, TOXIC_THRESHOLD = 0.3, 0.5


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"), "quality")
    return quality.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.lm_scores(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxic_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_THRESHOLD).cast("int").alias("predicted"),
                         F.size("passages").alias("n_passages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op8_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs)).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", F.size("runs").alias("n_runs"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return residues.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    return subvectors.cluster(read_table(spark, sf_dir, "embeddings"), first).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", subvectors.centroid_sha256().alias("centroid_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_fingerprints, op2_quality, op3_mixing, op4_lm_scoring, op5_toxicity, op6_simhash, op7_token_counts,
             op8_cap_filters, op9_language, op10_packing, op11_hard_negatives, op12_substrings, op13_centroids)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_fingerprints": fingerprints.ORACLE_SQL, "op3_mixing": mixing.ORACLE_SQL,
            "op8_cap_filters": cap_filters.ORACLE_SQL, "op11_hard_negatives": residues.ORACLE_SQL,
            "op12_substrings": substrings.ORACLE_SQL, "op13_centroids": subvectors.ORACLE_SQL}
