"""Trigram similarity (X6) as Column expressions.

Contract (ours; the reference relies on pg_trgm): lower-case the text, take
runs of letters/digits as words, pad each word as ``'  ' || w || ' '``, take
the distinct 3-character substrings, and score two strings by Jaccard
|A and B| / |A or B| (0 when both sets are empty).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import TOKEN_PATTERN


def trigrams(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0)
    padded = F.transform(F.array_distinct(words), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    per_word = F.transform(
        padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3))))
    return F.array_distinct(F.flatten(per_word))


def py_trigrams(text: str) -> list[str]:
    """The same rule for a literal query string (driver-side helper)."""
    import regex

    out: list[str] = []
    for w in regex.findall(TOKEN_PATTERN, (text or "").lower()):
        p = "  " + w + " "
        for i in range(len(p) - 2):
            g = p[i:i + 3]
            if g not in out:
                out.append(g)
    return out


def similarity_to(text: Column, query: str) -> Column:
    """Jaccard similarity of ``text``'s trigram set with a literal query's."""
    q = F.array(*[F.lit(g) for g in py_trigrams(query)]) if py_trigrams(query) else F.array().cast("array<string>")
    g = trigrams(text)
    union = F.size(F.array_union(g, q))
    inter = F.size(F.array_intersect(g, q))
    return F.when(union == 0, F.lit(0.0)).otherwise(inter / union)
