"""Trigram index for fuzzy names and contains-search.

Rows ``(field, gram, id, n_grams)``: a row per text and different trigram of
it, with the number of its different trigrams.  Stored by ``field``, sorted by
gram and number, so a query reads the row groups of its own grams and of the
numbers that a match can have.

Fuzzy search needs nothing else: the common grams of a text and the query are
its rows among the query's grams, and with both totals give the exact
similarity.  Contains-search takes the texts that have all grams that any match
must have and tests them exactly; a pattern too short for any gram scans."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import TOKEN_PATTERN
from quarry.functions.trigram import py_trigrams, trigrams
from quarry.operators.entities import ilike_any
from quarry.operators.fuzzy import DEFAULT_THRESHOLD, fuzzy_match
from quarry.operators.index import spread


def gram_rows(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """The index of some text columns of ``df``, whose ``id_col`` is a key.
    Narrow: no shuffle."""
    fields = F.array(*[F.struct(F.lit(c).alias("field"), trigrams(F.col(c)).alias("grams")) for c in columns])
    found = df.select(F.col(id_col).alias("id"), F.inline(fields))
    return found.select("field", F.explode("grams").alias("gram"), "id", F.size("grams").alias("n_grams"))


def write_grams(grams: DataFrame, path: str) -> None:
    """Store the index, sorted in each file.  A common gram spreads over
    several tasks and files; the texts are cut into grams once."""
    (spread(grams, ["field", "gram"], "id").sortWithinPartitions("field", "gram", "n_grams", "id")
     .write.mode("overwrite").partitionBy("field").parquet(path))


def fuzzy_scores(grams: DataFrame, field: str, query: str, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """``(id, similarity)`` of the texts of ``field`` at ``threshold`` (above 0)
    or more.

    Similar texts have between t m and m / t grams if the query has m; the scan
    takes only these.  Counts per id combine before the shuffle."""
    if threshold <= 0:
        raise ValueError("texts without common grams are not in the index")
    wanted = py_trigrams(query)
    m, t = len(wanted), threshold - 1e-6  # similarities are rounded to six places
    rows = grams.filter((F.col("field") == field) & F.col("gram").isin(*wanted)
                        & F.col("n_grams").between(ceil(t * m - 1e-9), floor(m / t + 1e-9)) if m else F.lit(False))
    common = rows.groupBy("id", "n_grams").agg(F.count(F.lit(1)).alias("common"))
    similarity = F.round(F.col("common") / (F.col("n_grams") + F.lit(m) - F.col("common")), 6)
    return common.select("id", similarity.alias("similarity")).filter(F.col("similarity") >= threshold)


def fuzzy_indexed(grams: DataFrame, df: DataFrame, id_col: str, col: str, query: str,
                  threshold: float = DEFAULT_THRESHOLD, limit: int = 10) -> DataFrame:
    """The rows of :func:`quarry.operators.fuzzy.fuzzy_match`, best first, from
    the index: ``df`` is read for the final ids only, with an ``IN`` filter
    that reaches its scan."""
    if threshold <= 0:
        return fuzzy_match(df, id_col, col, query, threshold, limit)
    best = fuzzy_scores(grams, col, query, threshold).orderBy(F.col("similarity").desc(), F.col("id").asc_nulls_last()).limit(limit)
    rows = best.collect()  # bounded by ``limit``
    kind = df.schema[id_col].dataType
    picked = df.filter(F.col(id_col).isin(*[F.lit(r["id"]).cast(kind) for r in rows]) if rows else F.lit(False))
    scored = df.sparkSession.createDataFrame([tuple(r) for r in rows], best.schema).withColumnRenamed("id", "_scored")
    return picked.join(scored, F.col(id_col) == F.col("_scored")).drop("_scored").orderBy(
        F.col("similarity").desc(), F.col(id_col).asc_nulls_last())


def needed_grams(text: str) -> list[str]:
    """Grams of every text that holds ``text`` (``%`` and ``_`` are wild):
    those inside its words, and at an end of a word where ``text`` shows it."""
    found: dict[str, None] = {}
    text = text.lower()
    for word in regex.finditer(TOKEN_PATTERN, text):
        before, behind = text[:word.start()][-1:], text[word.end():][:1]
        opens = "" if before in ("", "%", "_") else "  "
        closes = "" if behind in ("", "%", "_") else " "
        padded = opens + word.group() + closes
        found |= dict.fromkeys(padded[i:i + 3] for i in range(len(padded) - 2))
    return list(found)


def contains_candidates(grams: DataFrame, columns: Sequence[str], text: str) -> DataFrame | None:
    """``id`` of the rows that may hold ``text`` in one of ``columns``: some
    column has all needed grams.  None if ``text`` needs none."""
    wanted = needed_grams(text)
    if not wanted:
        return None
    rows = grams.filter(F.col("field").isin(*columns) & F.col("gram").isin(*wanted))
    return rows.groupBy("field", "id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(wanted)).select("id").distinct()


def ilike_indexed(grams: DataFrame, df: DataFrame, id_col: str, columns: Sequence[str], text: str) -> DataFrame:
    """rows of ``df`` with ``text`` in one of ``columns``, as the scan with
    :func:`quarry.operators.entities.ilike_any` finds them; only candidates
    are tested."""
    candidates = contains_candidates(grams, columns, text)
    if candidates is None:
        return df.filter(ilike_any(df, columns, text))
    ids = candidates.withColumnRenamed("id", "_candidate")
    return df.join(ids, F.col(id_col) == F.col("_candidate"), "left_semi").filter(ilike_any(df, columns, text))
