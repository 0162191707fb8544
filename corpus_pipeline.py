"""Corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``docs``.  Each stage
works on all its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import langid, mixing, packing, quality, simhash
from quarry.llm.queries import QUALITY_THRESHOLD, tokenizer_path
from quarry.session import scratch_path
from quarry.sources.tables import read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; the model is learned from ``docs``."""
    return langid.keep_identified(docs, langid.fit(docs), threshold=0.3)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score at least 0.3; learned from ``docs`` and the
    ``labels`` table."""
    return quality.keep_good(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")), QUALITY_THRESHOLD)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return simhash.keep_one_of_each(docs, shingle=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("quality", good_quality),
    ("simhash", simhash_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models and XXH64 fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet
    to a new folder in the shared checkpoint folder and read from there."""
    docs, base = read_table(spark, sf_dir, "documents"), scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
