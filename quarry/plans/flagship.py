"""The flagship query: rank document texts for a two-term AND query,
left-join document metadata, keep the top 20 (SURVEY 7.1 step 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import search as S
from quarry.sources.tables import read_table

FLAGSHIP_QUERY = "tion ther"


def flagship_search(spark: SparkSession, sf_dir: str, query: str = FLAGSHIP_QUERY,
                    limit: int = 20) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = read_table(spark, sf_dir, "labels")
    top = S.fts_rank(docs, "doc_id", "text", query, limit=limit)
    # metadata join after the limit: only `limit` rows meet the labels table
    joined = top.join(labels, "doc_id", "left")
    return (
        S.with_headline(joined, "text", query)
        .select("doc_id", "lang", "source", "quality", "toxic", "score", "snippet")
        .orderBy(F.col("score").desc(), F.col("doc_id"))
    )
