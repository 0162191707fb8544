"""Trigram-similar names (F11, X6, T8): ``name % q ORDER BY similarity DESC``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.trigram import py_trigrams, trigrams

DEFAULT_THRESHOLD = 0.3


def with_similarity(df: DataFrame, col: str, query: str, out_col: str = "similarity") -> DataFrame:
    """Add the Jaccard trigram similarity of ``col`` to the literal ``query``.

    The row's gram set is staged once (it feeds both the intersection and the
    union).  The query's grams are a literal array: a narrow, shuffle-free
    plan with no join and no candidate pairs.
    """
    qg = py_trigrams(query)
    q = F.array(*[F.lit(g) for g in qg]) if qg else F.array().cast("array<string>")
    staged = df.withColumn("_grams", trigrams(F.col(col)))
    union = F.size(F.array_union(F.col("_grams"), q))
    inter = F.size(F.array_intersect(F.col("_grams"), q))
    sim = F.when(union == 0, F.lit(0.0)).otherwise(inter / union)
    return staged.withColumn(out_col, F.round(sim, 6)).drop("_grams")


def fuzzy_match(df: DataFrame, id_col: str, col: str, query: str,
                threshold: float = DEFAULT_THRESHOLD, limit: int | None = 10) -> DataFrame:
    """Rows with similarity >= threshold, best first (id breaks ties)."""
    scored = with_similarity(df, col, query).filter(F.col("similarity") >= threshold)
    ordered = scored.orderBy(F.col("similarity").desc(), F.col(id_col).asc_nulls_last())
    return ordered.limit(limit) if limit is not None else ordered
