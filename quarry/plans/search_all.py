"""Search everything (U10: F3-F7, J1, P12, P13, T1, T2, T5, U1, X4, X5, X8).

Five lazily built branches - e-mails, document pages, messages (full text),
people and photos (case-insensitive contains) - each limited on its own
(``offset`` is applied *inside* each branch, as in the reference, so paging
``all`` is not a global offset), projected into one hit shape, unioned, then
sorted by score desc with ties in branch order (email, document, message,
person, photo) and cut to ``limit``.  Snippets are computed after the
per-branch limit, i.e. on at most ``limit`` rows per branch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import null_safe_concat, split_query
from quarry.operators import search as S
from quarry.operators.entities import ilike_any
from quarry.sources.tables import parallelism

TYPES = ("emails", "documents", "messages", "people", "photos")
TYPE_RANK = {"email": 0, "document": 1, "message": 2, "person": 3, "photo": 4}
DEFAULT_LIMIT = 20

HIT_SCHEMA = ("entity_type string, entity_id string, title string, snippet string, "
              "date string, source string, score double")


@dataclass
class SearchTables:
    """Inputs, already renamed to the reference's column names.

    emails(id, subject, sender, body, date, release_batch);
    fulltext(doc_id, text) with documents(id, title, filename, volume);
    messages(id, sender, body, date, conversation_slug);
    people(id, name, description);
    photos(id, title, filename, description, date_taken, volume).
    Any may be None (that branch yields nothing).
    """

    emails: DataFrame | None = None
    fulltext: DataFrame | None = None
    documents: DataFrame | None = None
    messages: DataFrame | None = None
    people: DataFrame | None = None
    photos: DataFrame | None = None


def check_paging(limit: int | None, offset: int | None) -> tuple[int, int]:
    """T5: limit default 20, offset default 0; negatives rejected.  A cap on
    what one request may ask for belongs to the caller that serves requests."""
    limit = DEFAULT_LIMIT if limit is None else int(limit)
    offset = 0 if offset is None else int(offset)
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must be non-negative")
    return limit, offset


def _str(c: Column) -> Column:
    return c.cast("string")


def _nz(c: Column) -> Column:
    """'' counts as missing in the reference's ``a || b`` fallbacks."""
    return F.nullif(_str(c), F.lit(""))


def _fts_top(df: DataFrame, id_col: str, text_col: str, queries: list[str], limit: int,
             offset: int) -> DataFrame:
    hits = S.fts_match_many(df, text_col, queries)
    return S.top_k_per_query(hits, [F.col("score").desc(), F.col(id_col).asc_nulls_last()], limit, offset)


def _with_snippets(top: DataFrame, text_col: str, queries: list[str]) -> DataFrame:
    """Headlines on the final rows only; each row looks up its own query's
    highlight spec, so one projection serves the whole batch."""
    specs = F.create_map(*[x for q in queries for x in (F.lit(q), S.headline_spec(q))])
    # the input is bounded (limit rows per query)
    spread_top = top.repartition(max(1, min(parallelism(top.sparkSession), 4 * len(queries))))
    return S.with_headline_by(spread_top, text_col, specs[F.col("query")])


def _email_branch(t: SearchTables, queries: list[str], limit: int, offset: int) -> DataFrame:
    e = t.emails.withColumn("_text", null_safe_concat(F.col("subject"), F.col("body")))
    top = _fts_top(e, "id", "_text", queries, limit, offset)
    top = top.withColumn("_snip_src", F.coalesce(F.col("body"), F.col("subject"), F.lit("")))
    top = _with_snippets(top, "_snip_src", queries)
    return top.select(
        "query", F.lit("email").alias("entity_type"), _str(F.col("id")).alias("entity_id"),
        F.coalesce(_nz(F.col("subject")), F.lit("(no subject)")).alias("title"),
        F.coalesce(F.col("snippet"), F.lit("")).alias("snippet"),
        _str(F.col("date")).alias("date"),
        F.coalesce(_nz(F.col("release_batch")), F.lit("")).alias("source"),
        F.col("score"), F.col("_pos"),
    )


def _document_branch(t: SearchTables, queries: list[str], limit: int, offset: int) -> DataFrame:
    # rank pages first, then meet the metadata: only the top rows are joined
    pages = t.fulltext.select("doc_id", "text")
    top = _with_snippets(_fts_top(pages, "doc_id", "text", queries, limit, offset), "text", queries)
    if t.documents is not None:
        meta = t.documents.select(F.col("id").alias("_mid"), "title", "filename", "volume")
        top = top.join(meta, top["doc_id"] == meta["_mid"], "left")
    else:
        top = top.select("*", *[F.lit(None).cast("string").alias(c) for c in ("title", "filename", "volume")])
    return top.select(
        "query", F.lit("document").alias("entity_type"), _str(F.col("doc_id")).alias("entity_id"),
        F.coalesce(_nz(F.col("title")), _nz(F.col("filename")), _str(F.col("doc_id")), F.lit("")).alias("title"),
        F.coalesce(F.col("snippet"), F.lit("")).alias("snippet"),
        F.lit(None).cast("string").alias("date"),
        F.coalesce(_nz(F.col("volume")), F.lit("")).alias("source"),
        F.col("score"), F.col("_pos"),
    )


def _message_branch(t: SearchTables, queries: list[str], limit: int, offset: int) -> DataFrame:
    top = _with_snippets(_fts_top(t.messages, "id", "body", queries, limit, offset), "body", queries)
    return top.select(
        "query", F.lit("message").alias("entity_type"), _str(F.col("id")).alias("entity_id"),
        F.concat(F.lit("Message from "), F.coalesce(_nz(F.col("sender")), F.lit("unknown"))).alias("title"),
        F.coalesce(F.col("snippet"), F.lit("")).alias("snippet"),
        _str(F.col("date")).alias("date"),
        F.coalesce(_nz(F.col("conversation_slug")), F.lit("")).alias("source"),
        F.col("score"), F.col("_pos"),
    )


def _like_top(df: DataFrame, cols: Sequence[str], queries: list[str], limit: int, offset: int) -> DataFrame:
    """F3 + T3 for many queries in one scan: flat-map each row to the queries
    it matches, then the first rows by id per query."""
    per_query = [F.struct(F.lit(q).alias("query"), ilike_any(df, cols, q).alias("_ok")) for q in queries]
    hits = df.select("*", F.inline(F.filter(F.array(*per_query), lambda x: x["_ok"]))).drop("_ok")
    return S.top_k_per_query(hits, [F.col("id").asc_nulls_last()], limit, offset)


def _people_branch(t: SearchTables, queries: list[str], limit: int, offset: int) -> DataFrame:
    top = _like_top(t.people, ["name", "description"], queries, limit, offset)
    return top.select(
        "query", F.lit("person").alias("entity_type"), _str(F.col("id")).alias("entity_id"),
        F.coalesce(_nz(F.col("name")), F.lit("")).alias("title"),
        F.substring(F.coalesce(_str(F.col("description")), F.lit("")), 1, 200).alias("snippet"),
        F.lit(None).cast("string").alias("date"),
        F.lit(None).cast("string").alias("source"),
        F.lit(1.0).alias("score"), F.col("_pos"),
    )


def _photo_branch(t: SearchTables, queries: list[str], limit: int, offset: int) -> DataFrame:
    top = _like_top(t.photos, ["title", "filename", "description"], queries, limit, offset)
    return top.select(
        "query", F.lit("photo").alias("entity_type"), _str(F.col("id")).alias("entity_id"),
        F.coalesce(_nz(F.col("title")), _nz(F.col("filename")), F.lit("")).alias("title"),
        F.substring(F.coalesce(_str(F.col("description")), F.lit("")), 1, 200).alias("snippet"),
        _str(F.col("date_taken")).alias("date"),
        F.coalesce(_nz(F.col("volume")), F.lit("")).alias("source"),
        F.lit(1.0).alias("score"), F.col("_pos"),
    )


_BRANCHES = (
    ("emails", "emails", _email_branch),
    ("documents", "fulltext", _document_branch),
    ("messages", "messages", _message_branch),
    ("people", "people", _people_branch),
    ("photos", "photos", _photo_branch),
)


def search_many(spark: SparkSession, tables: SearchTables, queries: Sequence[str], type: str = "all",
                limit: int | None = None, offset: int | None = None) -> DataFrame:
    """U10 + T2 for a batch of queries: ``query`` column plus each query's
    hits.  Every table is scanned once for the whole batch; blank queries
    (F7) and an unknown type (F6) yield no rows."""
    limit, offset = check_paging(limit, offset)
    empty = spark.createDataFrame([], "query string, " + HIT_SCHEMA)
    valid = list(dict.fromkeys(q for q in queries if split_query(q)))
    if not valid or (type != "all" and type not in TYPES):
        return empty
    parts = [fn(tables, valid, limit, offset) for tname, attr, fn in _BRANCHES
             if (type == "all" or type == tname) and getattr(tables, attr) is not None]
    if not parts:
        return empty
    allhits = parts[0]
    for p in parts[1:]:
        allhits = allhits.unionByName(p)
    rank = F.create_map(*[x for k, v in TYPE_RANK.items() for x in (F.lit(k), F.lit(v))])
    merged = S.top_k_per_query(allhits, [F.col("score").desc(), rank[F.col("entity_type")], F.col("_pos")], limit)
    return merged.drop("_pos")


def search_all(spark: SparkSession, tables: SearchTables, query: str, type: str = "all",
               limit: int | None = None, offset: int | None = None) -> DataFrame:
    """U10 for one query (the reference's ``searchAll``)."""
    return search_many(spark, tables, [query], type, limit, offset).drop("query")
