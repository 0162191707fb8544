"""Registered queries of the jobs: storage round trips, ingest, dashboard,
page-level index, e-mail search.

A job works on stored tables, so each query first writes its input (derived
from the driver tables) to the shared checkpoint folder, runs the job there
and reads back what it stored.  Oracles spell query terms by hand.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.jsonpath import field_text, field_value, json_kind
from quarry.functions.text import sql_stem, sql_stop_list
from quarry.operators import grams as GR
from quarry.operators import impact as IM
from quarry.operators import index as IX
from quarry.operators import integrity as IG
from quarry.operators import pieces as PC
from quarry.operators import search as S
from quarry.operators import segments as SG
from quarry.operators import stats as ST
from quarry.operators.keys import with_defaults
from quarry.plans import bindings as B
from quarry.plans.asset_jobs import REGISTRY_SCHEMA, discover_job
from quarry.plans.bindings import ORACLE, REGISTRY, register
from quarry.plans.dashboard import DASHBOARD_TABLES, dashboard
from quarry.plans.ingest import ingest_all, load_table, run_log
from quarry.plans.oracle_sql import fts_scores_sql, headline_sql, phrase_sql, terms_cte
from quarry.plans.search_all import SearchTables, search_many
from quarry.session import scratch_path
from quarry.sources import sinks
from quarry.sources.files import checksums, list_files
from quarry.sources.shards import read_ndjson, shard_union
from quarry.sources.tables import dealt, read_table
from quarry.streaming.asset_state import current_registry, start_asset_stream
from quarry.streaming.outcomes import ATTEMPT_SCHEMA

RUN_TIME = _dt.datetime(2024, 5, 1, 12, 0, 0)


def _new_folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _turn_id():
    return F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))


_TURN_ID = "CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)"


# ------------------------------------------------------------ page index ---

_EDITED = "CASE WHEN turn % 4 = 1 THEN text || ' revised licenses' ELSE text END"
_LATER = f"(SELECT conv_id, turn, {_EDITED} AS text FROM conversations WHERE turn % 5 <> 3)"


def _turns(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of the conversations: in the second some turns are edited
    and some are gone."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    edited = F.when(F.col("turn") % 4 == 1, F.concat("text", F.lit(" revised licenses"))).otherwise(F.col("text"))
    return c, c.filter(F.col("turn") % 5 != 3).withColumn("text", edited)


def _page_index(spark, sf_dir, positions: bool = False) -> tuple[DataFrame, DataFrame]:
    first, second = _turns(spark, sf_dir)
    path = _new_folder(spark, "page-index")
    IX.write_index(IX.index_rows(first, "message", "conv_id", "text", "turn", positions), path)
    stored = spark.read.parquet(path)
    return IX.index_increment(stored, second, "message", "conv_id", "text", "turn"), second


@register("index_increment_pages", f"""
WITH {terms_cte(_LATER, "CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR)", "text")}
SELECT split_part(id, '/', 1) AS entity_id, CAST(split_part(id, '/', 2) AS BIGINT) AS page, term, count(*) AS tf
FROM terms GROUP BY id, term
""")
def q_index_increment_pages(spark, sf_dir):
    """X1 + F10 + U12 with conversations as documents and turns as pages:
    every posting after the increment equals a rebuild's."""
    return IX.postings(_page_index(spark, sf_dir)[0]).select("entity_id", "page", "term", "tf")


@register("index_search_pages", f"""
WITH {terms_cte(_LATER, "CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR)", "text")},
tf AS (SELECT id, count(*) FILTER (WHERE starts_with(term, 'licen')) AS a,
              count(*) FILTER (WHERE term = 'revis') AS b FROM terms GROUP BY id)
SELECT split_part(id, '/', 1) AS entity_id, CAST(split_part(id, '/', 2) AS BIGINT) AS page,
       round((a / (a + 1.2) + b / (b + 1.2)) / 2.0, 6) AS score
FROM tf WHERE a > 0 AND b > 0
""")
def q_index_search_pages(spark, sf_dir):
    """F4/F5 from the page index: a page satisfies the query by itself."""
    return IX.search_index(_page_index(spark, sf_dir)[0], "licen:* revised", "message").select(
        "entity_id", "page", "score")


# ---------------------------------------------------------- index refresh ---

_FIRST = ("(SELECT doc_id, text FROM documents UNION ALL SELECT doc_id, text FROM documents WHERE doc_id % 7 = 0 "
          "UNION ALL SELECT item_id + 1000000000, text FROM benchmark)")
_SECOND = ("(SELECT doc_id, CASE WHEN doc_id % 100 = 3 THEN coalesce(text, '') || ' revised licenses' ELSE text END AS text "
           "FROM documents UNION ALL SELECT doc_id, text FROM documents WHERE doc_id % 14 = 0)")


def _snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two snapshots of the documents.  In the first, one row in seven stands
    twice and the benchmark items are there too; in the second half of the
    repeated rows and all items are gone, and one text in a hundred is edited."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    items = read_table(spark, sf_dir, "benchmark").select((F.col("item_id") + 1_000_000_000).alias("doc_id"), "text")
    edited = F.when(F.col("doc_id") % 100 == 3, F.concat(F.coalesce("text", F.lit("")), F.lit(" revised licenses"))).otherwise(F.col("text"))
    first = d.unionByName(d.filter(F.col("doc_id") % 7 == 0)).unionByName(items)
    return first, d.withColumn("text", edited).unionByName(d.filter(F.col("doc_id") % 14 == 0))


def _refreshed(spark, sf_dir) -> str:
    first, second = _snapshots(spark, sf_dir)
    path = _new_folder(spark, "segments")
    SG.create(IX.index_rows(first, "document", "doc_id", "text"), path)
    SG.refresh(spark, path, second, "document", "doc_id", "text")
    return path


@register("index_refresh", B._term_stats_sql([("document", _SECOND, "doc_id", "text")]))
def q_index_refresh(spark, sf_dir):
    """F10 + U12 on a stored index with repeated rows: after a refresh by a
    delta segment and tombstones the live postings equal a rebuild's."""
    return IX.term_stats(SG.read_index(spark, _refreshed(spark, sf_dir)))


@register("index_refresh_written", f"""
WITH a AS (SELECT doc_id, text, count(*) AS n FROM {_FIRST} GROUP BY ALL),
b AS (SELECT doc_id, text, count(*) AS n FROM {_SECOND} GROUP BY ALL),
c AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.n AS was, b.n AS now
      FROM a FULL JOIN b ON a.doc_id = b.doc_id AND a.text IS NOT DISTINCT FROM b.text WHERE a.n IS DISTINCT FROM b.n)
SELECT CAST(doc_id AS VARCHAR) AS entity_id, was, now AS copies FROM c
""")
def q_index_refresh_written(spark, sf_dir):
    """What the refresh wrote: a row for each page that came, went or changed
    its number of equal rows, and no other."""
    path = _refreshed(spark, sf_dir)
    pages = spark.read.parquet(f"{path}/pages")
    came = pages.filter("seg = 2").select("entity_id", "content_hash", "copies")
    gone = spark.read.parquet(f"{path}/dead/seg=2").join(
        pages.filter("seg = 1").select("entity_id", "content_hash", F.col("copies").alias("was")), ["entity_id", "content_hash"])
    return gone.select("entity_id", "content_hash", "was").join(came, ["entity_id", "content_hash"], "full_outer").select(
        "entity_id", "was", "copies")


RANKED_QUERIES = ("tion", "tion ther", "licens")


@register("index_top_k", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{q}' AS query, CAST(id AS VARCHAR) AS entity_id, score "
    f"FROM ({fts_scores_sql('documents', 'doc_id', 'text', q)}) ORDER BY score DESC, entity_id LIMIT 20)" for q in RANKED_QUERIES))
def q_index_top_k(spark, sf_dir):
    """T1 + X4 from impact-ordered postings that are read from the top."""
    d, path = read_table(spark, sf_dir, "documents").select("doc_id", "text"), _new_folder(spark, "impacts")
    IM.write_impacts(IX.index_rows(d, "document", "doc_id", "text"), path)
    found = [IM.top_k(spark, path, q, "document", 20).hits.select(F.lit(q).alias("query"), "entity_id", "score") for q in RANKED_QUERIES]
    return found[0].union(found[1]).union(found[2])


# ---------------------------------------------------------- trigram index ---


def _grams(spark, sf_dir, table: str, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    df, path = read_table(spark, sf_dir, table).select(key, *columns), _new_folder(spark, "grams")
    GR.write_grams(GR.gram_rows(dealt(df), key, columns), path)
    return spark.read.parquet(path), df


@register("fuzzy_index", ORACLE["fuzzy_match"])
def q_fuzzy_index(spark, sf_dir):
    """F11 + T8 + X6 from the stored trigram index."""
    grams, part = _grams(spark, sf_dir, "part", "p_partkey", ["p_name"])
    return GR.fuzzy_indexed(grams, part, "p_partkey", "p_name", B.FUZZY_QUERY, 0.3, 10)


CONTAINS = ("tion the", "licen", "of_the%and")


@register("contains_index", " UNION ALL ".join(
    f"SELECT '{q}' AS query, doc_id FROM documents WHERE text ILIKE '%{q}%'" for q in CONTAINS) + f"""
UNION ALL SELECT 'red', p_partkey FROM part WHERE p_name ILIKE '%red%' OR p_type ILIKE '%red%'""")
def q_contains_index(spark, sf_dir):
    """F3 (ILIKE) from the stored trigram index, over texts and over two columns."""
    grams, docs = _grams(spark, sf_dir, "documents", "doc_id", ["text"])
    found = [GR.ilike_indexed(grams, docs, "doc_id", ["text"], q).select(F.lit(q).alias("query"), "doc_id") for q in CONTAINS]
    grams, part = _grams(spark, sf_dir, "part", "p_partkey", ["p_name", "p_type"])
    found.append(GR.ilike_indexed(grams, part, "p_partkey", ["p_name", "p_type"], "red").select(F.lit("red"), "p_partkey"))
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


_TOKENS_SQL = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"


@register("index_positions", f"""
WITH toks AS (SELECT conv_id, turn, {_TOKENS_SQL} AS ts FROM {_LATER}),
tok AS (SELECT conv_id, turn, unnest(ts) AS t, unnest(range(len(ts))) AS pos FROM toks)
SELECT CAST(conv_id AS VARCHAR) AS entity_id, CAST(turn AS BIGINT) AS page, {sql_stem('t')} AS term, count(*) AS tf,
       string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
FROM tok WHERE t NOT IN ({sql_stop_list()}) GROUP BY ALL
""")
def q_index_positions(spark, sf_dir):
    """X1 with places: every posting of the page index, and where its term
    stands, after an increment."""
    return IX.postings(_page_index(spark, sf_dir, positions=True)[0]).select(
        "entity_id", "page", "term", "tf", F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


#: (query, the phrase as terms and places) of the phrase checks
PHRASES = (("tion<->ther", [("tion", 0), ("ther", 1)]), ("ther<2>tion", [("ther", 0), ("tion", 2)]))


@register("phrase_match", " UNION ALL ".join(
    f"SELECT '{q}' AS query, id, round(n / (n + 1.2), 6) AS score FROM ({phrase_sql('documents', 'doc_id', 'text', p)})"
    for q, p in PHRASES) + f"""
UNION ALL
SELECT 'tion !tion<->ther' AS query, id, score FROM ({fts_scores_sql('documents', 'doc_id', 'text', 'tion')})
WHERE id NOT IN (SELECT id FROM ({phrase_sql('documents', 'doc_id', 'text', PHRASES[0][1])}))
""")
def q_phrase_match(spark, sf_dir):
    """F5 phrases and distances over the texts, three queries in one pass."""
    d = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return S.fts_match_many(d, "text", [q for q, _ in PHRASES] + ["tion !tion<->ther"]).select("query", "id", "score")


@register("phrase_index", f"""
WITH toks AS (SELECT conv_id, turn, {_TOKENS_SQL} AS ts FROM {_LATER}),
tok AS (SELECT conv_id, turn, unnest(ts) AS t, unnest(range(len(ts))) AS pos FROM toks),
term AS (SELECT conv_id, turn, pos, {sql_stem('t')} AS term FROM tok WHERE t NOT IN ({sql_stop_list()})),
hit AS (SELECT a.conv_id, a.turn, count(*) AS n FROM term a JOIN term b
        ON a.conv_id = b.conv_id AND a.turn = b.turn AND b.pos = a.pos + 1
        WHERE a.term = 'revis' AND starts_with(b.term, 'lic') GROUP BY ALL)
SELECT CAST(conv_id AS VARCHAR) AS entity_id, CAST(turn AS BIGINT) AS page, round(n / (n + 1.2), 6) AS score FROM hit
""")
def q_phrase_index(spark, sf_dir):
    """F5 phrases from the places in the page index; none spans two pages."""
    return IX.search_index(_page_index(spark, sf_dir, positions=True)[0], "revised<->lic:*", "message").select(
        "entity_id", "page", "score")


@register("fts_composed", f"""
WITH {terms_cte("documents", "doc_id", "text")},
tf AS (SELECT id, count(*) FILTER (WHERE term = 'tion') AS t, count(*) FILTER (WHERE starts_with(term, 'lic')) AS l,
              count(*) FILTER (WHERE term = 'ther' OR starts_with(term, 'lic')) AS u FROM terms GROUP BY id)
SELECT 'tion !lic:*' AS query, id, round(t / (t + 1.2) / 1.0, 6) AS score FROM tf WHERE t > 0 AND l = 0
UNION ALL
SELECT 'lic:*|ther', id, round(u / (u + 1.2) / 1.0, 6) FROM tf WHERE u > 0
""")
def q_fts_composed(spark, sf_dir):
    """F5 with composed operators: an excluded prefix, a prefix among alternatives."""
    d = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return S.fts_match_many(d, "text", ["tion !lic:*", "lic:*|ther"]).select("query", "id", "score")


# ---------------------------------------------------------------- pieces ---


@register("text_pieces", """
SELECT conv_id, md5(string_agg(text, chr(10) ORDER BY turn, text)) AS whole_md5, count(*) AS n_parts, true AS bounded
FROM conversations GROUP BY conv_id
""")
def q_text_pieces(spark, sf_dir):
    """A4: the turns of a conversation in pieces of at most 300 bytes and one
    turn; joined again, they are its text."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    p = PC.text_pieces(c, "conv_id", ["turn", "text"], "text", limit=300)
    longest = F.octet_length("text") <= F.lit(300) + c.agg(F.max(F.octet_length("text") + 1)).first()[0]
    whole = F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("piece", "text"))), lambda e: e["text"]))
    return p.groupBy("conv_id").agg(F.md5(whole).alias("whole_md5"), F.sum("n_parts").alias("n_parts"),
                                    F.every(longest).alias("bounded"))


@register("children_pieces", """
WITH k AS (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (
             PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS place FROM lineitem)
SELECT o.o_orderkey, count(k.place) AS n_children,
       string_agg(k.l_linenumber || ':' || k.l_partkey, ',' ORDER BY k.place) AS children
FROM orders o LEFT JOIN k ON k.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey
""")
def q_children_pieces(spark, sf_dir):
    """An order's lines in numbered arrays of some 100 bytes; joined again,
    they are all its lines in order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    p = PC.children_pieces(o, li, "o_orderkey", "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"],
                           ["l_linenumber", "l_partkey"], limit=100)
    text = F.transform("children", lambda c: F.concat_ws(":", c["l_linenumber"], c["l_partkey"]))
    every = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("piece", text.alias("t")))), lambda e: e["t"]))
    return p.groupBy("o_orderkey").agg(every.alias("t")).select(
        "o_orderkey", F.size("t").cast("bigint").alias("n_children"),
        F.when(F.size("t") > 0, F.array_join("t", ",")).alias("children"))


# ---------------------------------------------------------------- ingest ---


@register("keyed_load", """
WITH f AS (SELECT *, row_number() OVER () AS place FROM orders),
k AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY place) = 1)
SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       o_orderpriority, CAST(o_orderkey AS BIGINT) AS raw_orderkey FROM k
""")
def q_keyed_load(spark, sf_dir):
    """S6 + S7: a table loaded with a key that repeats keeps each key's first
    row in file order (as text, '10' sorts before '9')."""
    out = _new_folder(spark, "keyed-load")
    cols = [("o_custkey", "str"), ("o_orderkey", "str"), ("o_orderpriority", "str")]
    load_table(spark, read_table(spark, sf_dir, "orders"), out, cols, "o_custkey")
    return spark.read.parquet(out).select(
        "o_custkey", "o_orderkey", "o_orderpriority",
        field_text(F.col("raw_json"), "o_orderkey").cast("bigint").alias("raw_orderkey"))


_ODD_DATE = "CASE WHEN o_orderkey % 9 = 0 THEN 'not a date' WHEN o_orderkey % 9 = 1 THEN '' ELSE CAST(o_orderdate AS VARCHAR) END"


def _odd_orders(spark, sf_dir) -> DataFrame:
    date = F.when(F.col("o_orderkey") % 9 == 0, "not a date").when(F.col("o_orderkey") % 9 == 1, "").otherwise(
        F.col("o_orderdate").cast("string"))
    return read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", date.alias("o_orderdate"))


_ODD_COLUMNS = [("o_orderkey", "str"), ("o_custkey", "str"), ("o_orderdate", "timestamp")]


@register("load_rejects", """
SELECT CAST(o_custkey AS VARCHAR) AS "key", 'o_orderdate' AS column_name, 'not a date' AS "value",
       CAST(o_orderkey AS BIGINT) AS o_orderkey FROM orders WHERE o_orderkey % 9 = 0
""")
def q_load_rejects(spark, sf_dir):
    """P5 + S6: values that don't parse load as NULL and stand in the table of
    rejects, with the whole row."""
    out = _new_folder(spark, "load")
    load_table(spark, _odd_orders(spark, sf_dir), f"{out}/orders", _ODD_COLUMNS, "o_custkey", order=["o_orderkey"],
               rejects_path=f"{out}/rejects")
    return spark.read.parquet(f"{out}/rejects").select(
        "key", "column_name", "value", field_text(F.col("raw_json"), "o_orderkey").cast("bigint").alias("o_orderkey"))


@register("load_one_pass", """
WITH k AS (SELECT o_custkey, min_by(o_orderkey, o_orderkey) AS first FROM orders GROUP BY o_custkey)
SELECT CAST(k.o_custkey AS VARCHAR) AS o_custkey, CAST(k.first AS VARCHAR) AS o_orderkey,
       CASE WHEN k.first % 9 > 1 THEN CAST(epoch(CAST(o.o_orderdate AS TIMESTAMP)) AS BIGINT) END AS seconds,
       (SELECT count(*) FROM orders) AS rows_read, (SELECT count(DISTINCT o_custkey) FROM orders) AS rows_written,
       (SELECT count(*) FROM orders WHERE o_orderkey % 9 = 0) AS rejected
FROM k JOIN orders o ON o.o_orderkey = k.first
""")
def q_load_one_pass(spark, sf_dir):
    """S6 + S7 + U8: a keyed load by an order of its own, its counts observed
    in the one scan that reads, reduces and writes."""
    out = _new_folder(spark, "load")
    n = load_table(spark, _odd_orders(spark, sf_dir), out, _ODD_COLUMNS, "o_custkey", order=["o_orderkey"])
    seconds = (B._micros(F.col("o_orderdate").cast("timestamp_ntz")) / 1_000_000).cast("bigint")
    return spark.read.parquet(out).select(
        "o_custkey", "o_orderkey", seconds.alias("seconds"), F.lit(n.read).cast("bigint").alias("rows_read"),
        F.lit(n.written).cast("bigint").alias("rows_written"), F.lit(n.rejected).cast("bigint").alias("rejected"))


@register("run_states", """
SELECT CAST(event_id AS VARCHAR) AS run_id, CASE WHEN user_id % 4 = 0 THEN 'running' WHEN user_id % 4 = 1 THEN 'failed'
       ELSE 'completed' END AS status, user_id % 4 > 0 AS closed FROM events
""")
def q_run_states(spark, sf_dir):
    """Opening and closing events of runs folded to their states; a run
    that was never closed is running."""
    e = read_table(spark, sf_dir, "events")
    at = F.lit(RUN_TIME).cast("timestamp")
    state = F.when(F.col("user_id") % 4 == 1, "failed").otherwise("completed")
    opened = e.select(F.col("event_id").cast("string").alias("run_id"), at.alias("event_at"), at.alias("started_at"),
                      F.lit(None).cast("timestamp").alias("completed_at"), F.lit("running").alias("status"))
    closed = e.filter(F.col("user_id") % 4 > 0).select(
        F.col("event_id").cast("string").alias("run_id"), at.alias("event_at"), at.alias("started_at"), at.alias("completed_at"),
        state.alias("status"))
    path = _new_folder(spark, "runs")
    opened.write.parquet(f"{path}_opened")
    closed.write.parquet(path)
    return run_log(spark, path).select("run_id", "status", F.col("completed_at").isNotNull().alias("closed"))


@register("file_footers", """
SELECT 'good' AS table_name, (SELECT count(*) FROM orders) AS row_count, 0 AS errors
UNION ALL SELECT 'mixed', -1, 1 UNION ALL SELECT 'gone', -1, 1
""")
def q_file_footers(spark, sf_dir):
    """A1 + A8: footers are read in tasks, a row per file; one file that is no
    Parquet beside good ones gives its table -1 and an error row, the other
    tables their counts."""
    root = _new_folder(spark, "footers")
    orders = dealt(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    orders.write.parquet(f"{root}/good")
    orders.write.parquet(f"{root}/mixed")
    read_table(spark, sf_dir, "region").select("r_name").coalesce(1).write.mode("append").text(f"{root}/mixed")
    paths = {t: f"{root}/{t}" for t in ("good", "mixed", "gone")}
    errors = ST.file_profile(spark, paths).groupBy("table_name").agg(F.count("error").cast("int").alias("errors"))
    return ST.table_counts(spark, paths).join(errors, "table_name")


def _archive(spark: SparkSession, sf_dir: str) -> str:
    """An archive in the layout of the ingest job, written from the driver
    tables and loaded; returns the folder of the loaded tables."""
    raw, out = _new_folder(spark, "archive-raw"), _new_folder(spark, "archive")
    c = read_table(spark, sf_dir, "conversations")
    c.select(
        _turn_id().alias("id"), F.when(F.col("turn") % 3 != 0, F.col("role")).alias("subject"),
        F.col("role").alias("sender"), F.col("text").alias("body"), (F.col("turn") % 2 == 0).alias("starred"),
        F.col("turn").alias("star_count"),
        F.concat(F.lit('[{"email":"'), F.col("role"), F.lit('@mail.test"},"x@y.test"]')).alias("recipients"),
        F.when(F.col("turn") % 2 == 0, F.lit('["c@y.test"]')).alias("cc"),
    ).write.parquet(f"{raw}/emails.parquet")
    read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"),
    ).write.parquet(f"{raw}/people.parquet")
    # ids repeat: a person per conversation and role, several turns each
    c.select(F.col("conv_id").alias("id"), F.col("role").alias("title")).write.parquet(
        f"{raw}/imessage_conversations.parquet")
    read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity_type"), F.col("user_id").alias("entity_id"), F.col("event_id").alias("count"),
    ).write.parquet(f"{raw}/star_counts.parquet")
    read_table(spark, sf_dir, "documents").select("doc_id", "text").write.parquet(f"{raw}/documents-full/part_a.parquet")
    read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("document_id"), F.col("text").alias("content")).write.parquet(
        f"{raw}/documents-full/part_b.parquet")
    ingest_all(spark, raw, out, RUN_TIME)
    return out


_LOADED = {
    "emails": "SELECT count(*) FROM conversations",
    "email_recipients": "SELECT sum(CASE WHEN turn % 2 = 0 THEN 3 ELSE 2 END) FROM conversations",
    "people": "SELECT count(DISTINCT p_partkey) FROM part",
    "imessage_conversations": "SELECT count(DISTINCT conv_id) FROM conversations",
    "star_counts": "SELECT count(*) FROM events",
    "document_fulltext": "SELECT (SELECT count(*) FROM documents) + (SELECT count(*) FROM benchmark)",
}
_READ = {
    "emails": "SELECT count(*) FROM conversations", "people": "SELECT count(*) FROM part",
    "imessage_conversations": "SELECT count(*) FROM conversations", "star_counts": "SELECT count(*) FROM events",
}


@register("ingest_job", " UNION ALL ".join(
    f"SELECT 'completed' AS status, '{t}' AS table_name, CAST(({sql}) AS BIGINT) AS row_count, "
    f"CAST(({_READ.get(t, 'NULL')}) AS BIGINT) AS rows_read" for t, sql in _LOADED.items()))
def q_ingest_job(spark, sf_dir):
    """U8 + S12 + A9: the run log's row counts after a load."""
    runs = run_log(spark, _archive(spark, sf_dir) + "/ingest_runs")
    return runs.select("status", "rows_read", F.explode("row_counts").alias("table_name", "row_count")).select(
        "status", "table_name", "row_count", F.col("rows_read")[F.col("table_name")].alias("rows_read"))


@register("ingest_emails", f"""
SELECT {_TURN_ID} AS id, CASE WHEN turn % 3 <> 0 THEN role END AS subject, text AS body, turn % 2 = 0 AS starred,
       CAST(turn AS INTEGER) AS star_count, CAST(NULL AS VARCHAR) AS thread_id,
       CASE WHEN turn % 2 = 0 THEN 3 ELSE 2 END AS n_recipients, role || '@mail.test' AS first_email
FROM conversations
""")
def q_ingest_emails(spark, sf_dir):
    """U8 + U5: loaded e-mails and their normalised recipients, read back."""
    out = _archive(spark, sf_dir)
    r = spark.read.parquet(f"{out}/email_recipients").groupBy(F.col("email_id").alias("id")).agg(
        F.count(F.lit(1)).cast("int").alias("n_recipients"),
        F.max(F.when(F.col("email").endswith("@mail.test"), F.col("email"))).alias("first_email"))
    return spark.read.parquet(f"{out}/emails").select(
        "id", "subject", "body", "starred", "star_count", "thread_id").join(r, "id", "left")


@register("dashboard_job", " UNION ALL ".join([
    *[f"SELECT 'rows' AS section, '{t}' AS name, CAST(({_LOADED.get(t, 'SELECT -1')}) AS BIGINT) AS n, "
      "CAST(NULL AS VARCHAR) AS display_class" for t in DASHBOARD_TABLES if t != "asset_registry"],
    "SELECT 'rows', 'asset_registry', (SELECT count(*) FROM pages), NULL",
    "SELECT 'assets', CASE page_id % 3 WHEN 0 THEN 'downloaded' WHEN 1 THEN 'discovered' ELSE 'failed' END, count(*), "
    "CASE page_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'warning' ELSE 'error' END FROM pages GROUP BY page_id % 3",
    "SELECT 'last_ingest', 'completed', 1, NULL"]))
def q_dashboard_job(spark, sf_dir):
    """U11 over a loaded archive: counts (-1: table absent), histogram, last run."""
    out = _archive(spark, sf_dir)
    status = (F.when(F.col("page_id") % 3 == 0, "downloaded").when(F.col("page_id") % 3 == 1, "discovered")
              .otherwise("failed"))
    sinks.overwrite_table(read_table(spark, sf_dir, "pages").select(
        F.col("url").alias("asset_url"), status.alias("status")), f"{out}/asset_registry")
    d = dashboard(spark, out)
    none = F.lit(None).cast("string").alias("display_class")
    rows = d.row_counts.select(F.lit("rows").alias("section"), F.col("table_name").alias("name"),
                               F.col("row_count").alias("n"), none)
    assets = d.asset_status.select(F.lit("assets"), "status", "count", "display_class")
    last = d.last_ingest.select(F.lit("last_ingest"), "status", F.lit(1).cast("bigint"), none)
    return rows.union(assets).union(last)


@register("shard_files", B._SHARD_SQL)
def q_shard_files(spark, sf_dir):
    """S2 + U2 through :func:`shard_union`: one stored shard per table, each
    with its own column names, tagged by file stem."""
    root = _new_folder(spark, "shards")
    read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang").write.parquet(f"{root}/documents.parquet")
    read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("document_id"), F.col("text").alias("content")).write.parquet(f"{root}/benchmark.parquet")
    read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), F.col("turn").alias("page"), F.col("text").alias("body"), "role",
    ).write.parquet(f"{root}/conversations.parquet")
    rows = shard_union(spark, [f"{root}/{t}.parquet" for t in ("documents", "benchmark", "conversations")])
    return rows.groupBy("shard_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("doc_id").alias("n_doc_ids"),
        F.sum(F.length("text")).cast("bigint").alias("text_chars"),
        F.sum("page_number").cast("bigint").alias("page_sum"),
        F.count_distinct("doc_id").alias("n_distinct_docs"))


# ---------------------------------------------------------------- assets ---


@register("asset_state_stream", ORACLE["apply_outcomes"].replace(
    "ORDER BY ts DESC, event_id DESC", "ORDER BY ts DESC, http_status DESC NULLS LAST, size_bytes DESC NULLS LAST, sha256 DESC"))
def q_asset_state_stream(spark, sf_dir):
    """U6 + S10 as keyed state over streams: registry rows and attempts arrive
    as files, decided URLs come out as a change log, laid over the registry."""
    root = _new_folder(spark, "asset-state")
    pages = read_table(spark, sf_dir, "pages")
    registry = B._registry_from_pages(pages)
    registry.select("asset_url", "status").write.parquet(f"{root}/registered")
    attempts = B._attempts_from_events(read_table(spark, sf_dir, "events"), pages)
    attempts.select(*[F.col(f.name).cast(f.dataType) for f in ATTEMPT_SCHEMA]).write.parquet(f"{root}/attempts")
    query = start_asset_stream(spark, f"{root}/registered", f"{root}/attempts", f"{root}/changes", f"{root}/state")
    query.awaitTermination()
    out = current_registry(registry, spark.read.parquet(f"{root}/changes"))
    return out.select("asset_url", "status", "http_status", "local_path", "size_bytes", "sha256",
                      B._micros(F.col("downloaded_at").cast("timestamp_ntz")).alias("downloaded_at_us"))


@register("discover_job", """
WITH found AS (
  SELECT url AS asset_url, 'photos' AS source_dataset, 'photo' AS source_entity_type, CAST(page_id AS VARCHAR) AS source_entity_id, 0 AS r, 0 AS c
  FROM pages WHERE starts_with(url, 'http')
  UNION ALL
  SELECT url || '#thumb', 'photos', 'photo', CAST(page_id AS VARCHAR), 0, 1 FROM pages WHERE page_id % 4 = 0 AND starts_with(url, 'http')
  UNION ALL
  SELECT CASE WHEN page_id % 6 = 0 THEN url ELSE url || '?a=1' END, 'emails', 'email_attachment', 'e' || CAST(page_id AS VARCHAR), 1, 0
  FROM pages WHERE page_id % 3 = 0 AND starts_with(url, 'http')
)
SELECT asset_url, source_dataset, source_entity_type, source_entity_id, 'discovered' AS status FROM found
WHERE asset_url NOT IN (SELECT url FROM pages WHERE page_id % 10 = 0)
QUALIFY row_number() OVER (PARTITION BY asset_url ORDER BY r, source_entity_id, c) = 1
UNION ALL
SELECT url, 'older', 'photo', 'x', 'downloaded' FROM pages WHERE page_id % 10 = 0
""")
def q_discover_job(spark, sf_dir):
    """URL columns of a raw dataset and the attachment JSON of loaded
    e-mails - elements without a web URL, JSON that doesn't parse and NULLs
    among them - beside a registry whose rows win."""
    root = _new_folder(spark, "discover")
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    p.select(F.col("page_id").cast("string").alias("id"), F.col("url").alias("image_url"),
             F.when(F.col("page_id") % 4 == 0, F.concat("url", F.lit("#thumb"))).otherwise("none").alias("thumbnail_url"),
             ).write.parquet(f"{root}/raw/photos.parquet")
    own = F.when(F.col("page_id") % 6 == 0, F.col("url")).otherwise(F.concat("url", F.lit("?a=1")))
    found = F.concat(F.lit('[{"url":"ftp://x"},{"name":"n"},{"url":"'), own, F.lit('"}]'))
    p.select(F.concat(F.lit("e"), F.col("page_id").cast("string")).alias("id"),
             F.when(F.col("page_id") % 3 == 0, found).when(F.col("page_id") % 3 == 1, '[{"url":').alias("attachments"),
             ).write.parquet(f"{root}/loaded/emails")
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (f.split(" ") for f in REGISTRY_SCHEMA.split(", "))}
    known = {"asset_url": F.col("url"), "source_dataset": F.lit("older"), "source_entity_type": F.lit("photo"),
             "source_entity_id": F.lit("x"), "status": F.lit("downloaded")}
    older = p.filter(F.col("page_id") % 10 == 0).select(*[known[c].alias(c) if c in known else none[c] for c in none])
    return discover_job(spark, f"{root}/raw", f"{root}/loaded", older).select(
        "asset_url", "source_dataset", "source_entity_type", "source_entity_id", "status")


# --------------------------------------------------------- sources, sinks ---


@register("ndjson_twin", "SELECT conv_id, turn, role, text FROM conversations")
def q_ndjson_twin(spark, sf_dir):
    """S3: the gzip NDJSON form of a table holds the same rows."""
    path = _new_folder(spark, "ndjson")
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    dealt(c).write.option("compression", "gzip").json(path)
    return read_ndjson(spark, path, c.schema)


@register("audit_log", """
SELECT event_type AS status, count(*) + count(*) FILTER (WHERE event_id % 2 = 0) AS "count" FROM events GROUP BY event_type
""")
def q_audit_log(spark, sf_dir):
    """S9 + S11: attempts appended in two runs; their status report, stored as
    JSON and read back."""
    log, report = _new_folder(spark, "audit"), _new_folder(spark, "report")
    attempts = read_table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("status"))
    sinks.append_audit(attempts, log)
    sinks.append_audit(attempts.filter(F.col("event_id") % 2 == 0), log)
    sinks.write_report(ST.status_counts(spark.read.parquet(log)), report)
    return spark.read.schema("status string, `count` bigint").json(report)


@register("column_defaults", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'downloaded' ELSE 'discovered' END AS status, 0 AS retries,
       CAST(epoch_us(TIMESTAMP '2024-05-01 12:00:00') AS BIGINT) AS created_us FROM pages
""")
def q_column_defaults(spark, sf_dir):
    """P17 + X14: absent and NULL columns take defaults, "now" is the run's time."""
    p = read_table(spark, sf_dir, "pages").select(
        "page_id", F.when(F.col("page_id") % 3 == 0, "downloaded").alias("status"))
    out = with_defaults(p, {"status": "discovered", "retries": 0, "created": F.lit(RUN_TIME.isoformat(" ")).cast("timestamp_ntz")})
    return out.select("page_id", "status", "retries", B._micros(F.col("created")).alias("created_us"))


@register("json_odd_keys", """
SELECT event_id, CAST(event_id % 5 AS VARCHAR) AS quoted, 'star' AS starred, '[1]' AS listed, 'object' AS kind_object,
       'string' AS kind_string, CAST(NULL AS VARCHAR) AS missing FROM events
""")
def q_json_odd_keys(spark, sf_dir):
    """P10 + P11: keys with apostrophes, quotes and wildcards are keys."""
    text = F.concat(F.lit('{"it\'s": {"k": '), (F.col("event_id") % 5).cast("string"),
                    F.lit('}, "a*?": "star", "both\'\\"": [1], "n\'": null}'))
    e = read_table(spark, sf_dir, "events").select("event_id", text.alias("j"))
    j = F.col("j")
    return e.select(
        "event_id", field_text(field_text(j, "it's"), "k").alias("quoted"), field_text(j, "a*?").alias("starred"),
        field_text(j, "both'\"").alias("listed"), json_kind(field_value(j, "it's")).alias("kind_object"),
        json_kind(field_value(j, "a*?")).alias("kind_string"), field_text(j, "not'there").alias("missing"))


_DOTTED = """'{"a.b": {"k": ' || CAST(event_id % 5 AS VARCHAR) || '}, "a": {"b": "inner"}, "list": [1, null], "n": null}'"""


@register("json_value", """
SELECT event_id, CAST(event_id % 5 AS VARCHAR) AS dotted, 'inner' AS nested, 'object' AS kind_object,
       'array' AS kind_array, 'null' AS kind_null, CAST(NULL AS VARCHAR) AS kind_missing FROM events
""")
def q_json_value(spark, sf_dir):
    """P10 + P11 + X15: a key with a dot is a key, values keep their kind."""
    j = F.expr(_DOTTED.replace("VARCHAR", "STRING"))
    e = read_table(spark, sf_dir, "events").select("event_id", j.alias("j"))
    v = {k: field_value(F.col("j"), k) for k in ("a.b", "a", "list", "n", "missing")}
    return e.select(
        "event_id", field_text(field_text(F.col("j"), "a.b"), "k").alias("dotted"),
        F.variant_get(v["a"], "$.b", "string").alias("nested"), json_kind(v["a.b"]).alias("kind_object"),
        json_kind(v["list"]).alias("kind_array"), json_kind(v["n"]).alias("kind_null"),
        json_kind(v["missing"]).alias("kind_missing"))


# ----------------------------------------------------------------- files ---


def _item_files(spark: SparkSession, sf_dir: str) -> str:
    """One text file per benchmark item, in a folder named by its id."""
    root = _new_folder(spark, "items")
    b = read_table(spark, sf_dir, "benchmark").select("item_id", F.coalesce("text", F.lit("")).alias("value"))
    b.write.partitionBy("item_id").text(root)
    return root


def _item():
    return F.regexp_extract("path", r"item_id=(\d+)/", 1).cast("bigint")


@register("file_digests", """
SELECT item_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS actual_size,
       sha256(coalesce(text, '') || chr(10)) AS actual_sha256 FROM benchmark
""")
def q_file_digests(spark, sf_dir):
    """S5 + X12: sizes and digests of files whose content is known."""
    return checksums(spark, _item_files(spark, sf_dir), "*.txt").select(
        _item().alias("item_id"), "actual_size", "actual_sha256")


@register("verify_mirror", """
SELECT item_id, CASE item_id % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'size_mismatch' WHEN 2 THEN 'hash_mismatch'
                ELSE 'verified' END AS verdict FROM benchmark
""")
def q_verify_mirror(spark, sf_dir):
    """U9 + F12 + J6: expected values come from the table, actual ones from
    the files; some expectations name a wrong file, size or digest, or none."""
    root = _item_files(spark, sf_dir)
    names = list_files(spark, root, "*.txt").select(
        _item().alias("item_id"), F.regexp_extract("path", r"(item_id=.*)$", 1).alias("rel_path"))
    k = F.col("item_id") % 5
    content = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"))
    size = F.octet_length(content).cast("bigint")
    b = read_table(spark, sf_dir, "benchmark").join(names, "item_id")
    expected = b.select(
        "item_id", F.when(k == 0, F.concat(F.lit("absent/"), "rel_path")).otherwise(F.col("rel_path")).alias("rel_path"),
        F.when(k == 1, size + 1).when(k == 3, F.lit(0)).otherwise(size).alias("expected_size"),
        F.when(k == 2, F.sha2(F.lit("other"), 256)).when(k == 3, F.lit("")).otherwise(F.sha2(content, 256))
        .alias("expected_sha256"))
    return IG.verify_mirror(spark, expected, root, "*.txt").select("item_id", "verdict")


# ----------------------------------------------------------- mail search ---

MAIL_LIMIT, MAIL_OFFSET = 150, 5
_MAILS = f"""(SELECT {_TURN_ID} AS mid, conv_id, turn, CASE WHEN turn % 3 = 0 THEN NULL WHEN turn % 3 = 1 THEN ''
  ELSE 'tion ' || role END AS subject, role, CASE WHEN turn % 7 = 5 THEN NULL ELSE text END AS body FROM conversations)"""


def _mail_tables(spark, sf_dir) -> SearchTables:
    turn = F.col("turn")
    mails = read_table(spark, sf_dir, "conversations").select(
        _turn_id().alias("id"),
        F.when(turn % 3 == 0, F.lit(None)).when(turn % 3 == 1, "").otherwise(F.concat(F.lit("tion "), "role")).alias("subject"),
        F.col("role").alias("sender"), F.when(turn % 7 == 5, F.lit(None)).otherwise(F.col("text")).alias("body"),
        F.lit("2024-01-01").alias("date"), F.concat(F.lit("batch-"), (turn % 2).cast("string")).alias("release_batch"))
    t = B.search_tables(spark, sf_dir)
    t.emails = mails
    return t


def _mail_branch_sql(limit: int, offset: int) -> str:
    """E-mails with the term ``tion``: CTEs up to ``mail`` (one row per hit)."""
    return f"""
    {terms_cte(_MAILS, 'mid', "coalesce(subject, '') || ' ' || coalesce(body, '')", 'mt')},
    mtf AS (SELECT id, count(*) AS tf FROM mt WHERE term = 'tion' GROUP BY id),
    mhit AS (SELECT id, round(tf / (tf + 1.2) / 1.0, 6) AS score FROM mtf),
    mtop AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS pos FROM mhit
             QUALIFY pos > {offset} AND pos <= {offset + limit}),
    msrc AS (SELECT m.mid AS id, coalesce(m.body, m.subject, '') AS text FROM {_MAILS} m JOIN mtop ON m.mid = mtop.id),
    mail AS (SELECT 'email' AS entity_type, h.id AS entity_id, coalesce(nullif(m.subject, ''), '(no subject)') AS title,
                    s.snippet, '2024-01-01' AS date, 'batch-' || CAST(m.turn % 2 AS VARCHAR) AS source, h.score, h.pos
             FROM mtop h JOIN {_MAILS} m ON m.mid = h.id JOIN ({headline_sql('msrc', 'tion')}) s ON s.id = h.id)"""


@register("search_emails", f"""
WITH {_mail_branch_sql(MAIL_LIMIT, MAIL_OFFSET)}
SELECT 'tion' AS query, entity_type, entity_id, title, snippet, date, source, score FROM mail
""")
def q_search_emails(spark, sf_dir):
    """U10 + F6 + F7 + T5 + X7 + X8: e-mails only, from the sixth hit; the
    blank query and the unknown type add nothing."""
    t = _mail_tables(spark, sf_dir)
    mails = search_many(spark, t, ["tion", "  "], "emails", MAIL_LIMIT, MAIL_OFFSET)
    return mails.unionByName(search_many(spark, t, ["tion"], "attachments", MAIL_LIMIT, MAIL_OFFSET))


@register("search_all_emails", f"""
WITH {_mail_branch_sql(20, 0)},
rest AS ({B._search_sql("tion").replace("ORDER BY score DESC, type_rank, pos LIMIT 20", "")}),
every AS (SELECT entity_type, entity_id, title, snippet, date, source, score, 0 AS type_rank FROM mail
          UNION ALL SELECT entity_type, entity_id, title, snippet, date, source, score,
          CASE entity_type WHEN 'document' THEN 1 WHEN 'message' THEN 2 WHEN 'person' THEN 3 ELSE 4 END FROM rest)
SELECT 'tion' AS query, entity_type, entity_id, title, snippet, date, source, score FROM every
ORDER BY score DESC, type_rank, CASE WHEN entity_type IN ('email', 'message') THEN entity_id END,
         CASE WHEN entity_type NOT IN ('email', 'message') THEN CAST(entity_id AS BIGINT) END LIMIT 20
""")
def q_search_all_emails(spark, sf_dir):
    """U10 over all five branches."""
    return search_many(spark, _mail_tables(spark, sf_dir), ["tion"], limit=20)


def queries():
    return dict(REGISTRY)


def oracles():
    return dict(ORACLE)
