"""Inverted text index (X1, X2, X7, F10, U12) and term statistics.

The index is a DataFrame ``(entity_type, entity_id, page, term, tf,
content_hash)``: one row per page of an entity and distinct analysed term
(``page`` is NULL for entities of one text).  Building it counts the terms of
each page inside its row, after equal rows have met, so postings are made where
the text is and not shuffled.  With ``positions`` a posting also lists its
places: the token numbers from 0, stop words counted; phrases and distances are
answered from them.

Every page, empty ones too, has one row with the empty term ``PAGE``, whose
``tf`` is the number of equal source rows.  These rows are the index's page
table: sorted first, read by a pushed-down filter.  :func:`postings` is the
index without them.

:func:`write_index` stores it by ``entity_type``, sorted by ``term``, so term
lookups read few pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import is_stop_word, stem, tokens


#: A text is named by its entity and page; an edit shows in its hash.
PAGE_KEY = ("entity_id", "page", "content_hash")
#: The term of a page's own row.
PAGE = ""


def _page(page_col: str | None) -> "F.Column":
    return (F.col(page_col) if page_col else F.lit(None)).cast("bigint")


def _same_page(a: str, b: str) -> "F.Column":
    """Join condition on ``PAGE_KEY`` of two aliases; NULL pages are equal."""
    return F.expr(" AND ".join(f"{a}.{c} <=> {b}.{c}" for c in PAGE_KEY))


def index_rows(df: DataFrame, entity_type: str, id_col: str, text_col: str,
               page_col: str | None = None, positions: bool = False) -> DataFrame:
    """X1 for one source: ``(entity_type, entity_id, page, term, tf,
    content_hash)`` and, if asked for, ``positions`` (array<int>, ascending).
    ``page_col`` numbers the texts of an entity that has several; without it an
    entity has one text.  Equal rows of a page add up in ``tf``, and have the
    same positions.

    Equal rows meet first, one narrow aggregation of rows that also spreads the
    texts over the tasks; a page's terms are then stemmed, sorted and counted
    inside its row, so no posting is shuffled to be counted and memory is bounded
    by a text.  The stemmer runs inside the row's lambda on purpose: as a
    projection after ``explode`` its code is one generated method too long for
    the JVM to compile.
    """
    pages = df.select(F.col(id_col).alias("_id"), _page(page_col).alias("page"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("_text")).groupBy("_id", "page", "_text").agg(
        F.count(F.lit(1)).alias("copies"))
    counted = pages.select("_id", "page", F.xxhash64("_text").alias("content_hash"), "copies",
                           F.inline(_counted(F.col("_text"), positions)))
    return counted.select(F.lit(entity_type).alias("entity_type"), F.col("_id").cast("string").alias("entity_id"),
                          "page", "term", (F.col("n") * F.col("copies")).alias("tf"), "content_hash",
                          *(["positions"] if positions else []))


def _counted(text: "F.Column", positions: bool) -> "F.Column":
    """The terms of a text in order, ``PAGE`` first: array of ``(term, n)`` and,
    if asked for, ``positions``.  Equal terms stand together once sorted; ``b``
    are the places where they begin."""
    term = (lambda x: x["term"]) if positions else (lambda x: x)
    kept = F.filter(F.transform(tokens(text), lambda t, i: F.struct(t.alias("t"), i.alias("i"))) if positions else tokens(text),
                    lambda x: ~is_stop_word(x["t"] if positions else x))
    stems = F.transform(kept, lambda x: F.struct(stem(x["t"]).alias("term"), x["i"].alias("pos")) if positions else stem(x))
    first = F.struct(F.lit(PAGE).alias("term"), F.lit(-1).alias("pos")) if positions else F.lit(PAGE)
    terms = F.sort_array(F.concat(F.array(first), stems))

    def run(ts, b, at, j):
        n = F.coalesce(F.get(b, j + 1), F.size(ts)) - at
        places = F.filter(F.transform(F.slice(ts, at + 1, n), lambda x: x["pos"]), lambda p: p >= 0)
        return F.struct(term(F.get(ts, at)).alias("term"), n.alias("n"), *([places.alias("positions")] if positions else []))

    def runs(ts):
        begins = F.filter(F.sequence(F.lit(0), F.size(ts) - 1),
                          lambda i: (i == 0) | (term(F.get(ts, i)) != term(F.get(ts, i - 1))))
        return F.get(F.transform(F.array(begins), lambda b: F.transform(b, lambda at, j: run(ts, b, at, j))), F.lit(0))

    # lambdas over arrays of one name what they use more than once, so it is computed once
    return F.get(F.transform(F.array(terms), runs), F.lit(0))


def postings(index: DataFrame) -> DataFrame:
    """The index without the pages' own rows."""
    return index.filter(F.col("term") != PAGE)


def page_rows(index: DataFrame) -> DataFrame:
    """``(entity_type, entity_id, page, content_hash, copies)``: the indexed
    pages, and how many equal rows each stands for."""
    return index.filter(F.col("term") == PAGE).select("entity_type", *PAGE_KEY, F.col("tf").alias("copies"))


def build_index(sources: list[tuple[str, DataFrame, str, str]], positions: bool = False) -> DataFrame:
    """Union of ``index_rows`` over ``(entity_type, df, id_col, text_col)``.
    Text columns are built by the caller, e.g. ``null_safe_concat(subject,
    body, sender)`` for e-mail (X7)."""
    out = None
    for etype, df, id_col, text_col in sources:
        part = index_rows(df, etype, id_col, text_col, positions=positions)
        out = part if out is None else out.unionByName(part)
    return out


def source_pages(source: DataFrame, id_col: str, text_col: str, page_col: str | None = None) -> DataFrame:
    """``PAGE_KEY`` and ``_text`` of the rows of a source."""
    return source.select(
        F.col(id_col).cast("string").alias("entity_id"), _page(page_col).alias("page"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("content_hash"),
        F.col(text_col).alias("_text"),
    )


def page_changes(known: DataFrame, rows: DataFrame) -> DataFrame:
    """Pages to index, to drop or both: ``PAGE_KEY, was, copies``, the number of
    equal rows in the index and in the source (NULL: not there), from the
    indexed ``known(PAGE_KEY, copies)`` and the source's ``rows(PAGE_KEY)``.
    A page whose number changed is to drop and to index."""
    src = rows.groupBy(*PAGE_KEY).agg(F.count(F.lit(1)).alias("copies"))
    both = src.alias("s").join(known.alias("k"), _same_page("s", "k"), "full_outer").filter(
        ~F.col("s.copies").eqNullSafe(F.col("k.copies")))
    return both.select(*[F.when(F.col("s.copies").isNull(), F.col(f"k.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in PAGE_KEY],
                       F.col("k.copies").alias("was"), F.col("s.copies").alias("copies"))


def to_index(changes: DataFrame) -> DataFrame:
    return changes.filter("copies IS NOT NULL").select(*PAGE_KEY)


def to_drop(changes: DataFrame) -> DataFrame:
    return changes.filter("was IS NOT NULL").select(*PAGE_KEY)


def index_increment(index: DataFrame, source: DataFrame, entity_type: str, id_col: str,
                    text_col: str, page_col: str | None = None) -> DataFrame:
    """F10 + U12: bring ``index`` up to date with ``source`` for one type.

    Pages absent from the index, or whose content hash or number of equal rows
    changed, are (re)indexed; pages gone from the source are dropped;
    everything else is kept as is, also the other pages of a changed entity.
    Equal to a full rebuild, at the cost of only the changed texts; positions
    are kept if the index has them.  For a stored index see
    :mod:`quarry.operators.segments`.

    One full-outer join of page keys (one row per page, not per posting)
    classifies every page.  Texts meet just the new keys and postings just the
    stale ones; AQE turns those joins into broadcasts when the sets prove small
    at run time (the steady state) and keeps a shuffle otherwise.
    """
    hashed = source_pages(source, id_col, text_col, page_col)
    mine = index.filter(F.col("entity_type") == entity_type)
    changes = page_changes(page_rows(mine).drop("entity_type"), hashed)
    new, stale = to_index(changes), to_drop(changes)
    changed = hashed.alias("t").join(new.alias("n"), _same_page("t", "n"), "left_semi")
    kept = mine.alias("m").join(stale.alias("x"), _same_page("m", "x"), "left_anti")
    fresh = index_rows(changed, entity_type, "entity_id", "_text", "page", "positions" in index.columns)
    others = index.filter(F.col("entity_type") != entity_type)
    return others.unionByName(kept).unionByName(fresh)


def term_stats(index: DataFrame) -> DataFrame:
    """Per (entity_type, term): texts containing it and total occurrences."""
    return postings(index).groupBy("entity_type", "term").agg(
        F.count(F.lit(1)).alias("n_entities"), F.sum("tf").alias("total_tf")
    )


SPREAD = 32  # places among which the rows of one term are dealt


def spread(rows: DataFrame, keys: list[str], by: str, files: int | None = None) -> DataFrame:
    """``rows`` dealt by ``keys``, those of equal keys to up to ``SPREAD``
    places by a hash of ``by``, so a hot key spreads over tasks and files.  One
    exchange: ranges would first compute all rows once more for their bounds."""
    place = F.pmod(F.xxhash64(by), F.lit(SPREAD))
    return rows.repartition(files, *keys, place) if files else rows.repartition(*keys, place)


def write_index(index: DataFrame, path: str, files: int | None = None) -> None:
    """Persist the index partitioned by ``entity_type`` and sorted by ``term``
    inside each file, so ``term IN (..)`` reads the row groups and pages of
    those terms only, through parquet min/max statistics.  A term is in up to
    ``SPREAD`` files; their number follows the session's shuffle partitions and
    the data (AQE), unless ``files`` is given."""
    (spread(index, ["entity_type", "term"], "entity_id", files)
     .sortWithinPartitions("entity_type", "term", "entity_id")
     .write.mode("overwrite").partitionBy("entity_type").parquet(path))


def _clause_postings(clauses) -> "F.Column":
    from quarry.operators.search import term_test

    cond = F.lit(False)
    for c in clauses:
        cond = cond | term_test(c, F.col("term"))
    return cond


def search_index(index: DataFrame, query: str, entity_type: str | None = None) -> DataFrame:
    """F4/F5 over the index: ``(entity_type, entity_id, page, score)`` of
    the texts satisfying every clause, scored like
    :func:`quarry.operators.search.fts_match`.  Phrases need an index with
    positions; equal rows of a page are one hit, with their ``tf`` added up
    outside phrases.  The term predicate reaches the parquet scan; only matching postings are read and shuffled, with partial
    aggregation per entity."""
    from quarry.operators.search import Clause, parse_query, phrase_starts_sql, term_test

    clauses = parse_query(query)
    pos = [i for i, c in enumerate(clauses) if c.positive]
    if not pos:
        return index.select("entity_type", "entity_id", "page", F.lit(None).cast("double").alias("score")).limit(0)
    post = index.filter(_clause_postings(clauses))
    if entity_type:
        post = post.filter(F.col("entity_type") == entity_type)

    if any(c.phrases for c in clauses) and "positions" not in index.columns:
        raise ValueError("a phrase needs an index with positions")
    # a page (one text of an entity) satisfies the query by itself or not at all
    aggs = [F.sum(F.when(term_test(c, F.col("term")), F.col("tf")).otherwise(0)).alias(f"_c{i}")
            for i, c in enumerate(clauses) if not c.phrases]
    # the places of a phrase's terms meet by page, are shifted and intersected
    places = {t: f"_p{k}" for k, t in enumerate(dict.fromkeys(t for c in clauses for p in c.phrases for t, _ in p))}
    for t, name in places.items():
        aggs.append(F.flatten(F.collect_list(F.when(term_test(Clause("any", (t,)), F.col("term")), F.col("positions")))).alias(name))
    agg = post.groupBy("entity_type", *PAGE_KEY).agg(*aggs)
    for i, c in enumerate(clauses):
        if c.phrases:
            agg = agg.withColumn(f"_c{i}", F.expr(" + ".join(f"size({phrase_starts_sql(p, places.get)})" for p in c.phrases)))
    cond = F.lit(True)
    for i, c in enumerate(clauses):
        cond = cond & ((F.col(f"_c{i}") > 0) if c.positive else (F.col(f"_c{i}") == 0))
    score = None
    for i in pos:
        term = F.col(f"_c{i}") / (F.col(f"_c{i}") + F.lit(1.2))
        score = term if score is None else score + term
    return agg.filter(cond).select("entity_type", "entity_id", "page",
                                   F.round(score / F.lit(float(len(pos))), 6).alias("score"))


def search_index_ranked(index: DataFrame, texts: DataFrame, id_col: str, text_col: str, query: str,
                        entity_type: str | None = None, limit: int = 20,
                        page_col: str | None = None) -> DataFrame:
    """Top-``limit`` index hits with headlines: ranking reads postings only;
    the texts of the final ids (at most ``limit``, collected) are fetched with
    an ``IN`` filter that reaches the text scan."""
    from quarry.operators.search import with_headline

    top = (search_index(index, query, entity_type)
           .orderBy(F.col("score").desc(), F.col("entity_id"), F.col("page")).limit(limit))
    rows = top.collect()  # bounded by `limit`
    if not rows:
        return top.withColumn("snippet", F.lit(None).cast("string"))
    # literals of the column's own type, so the filter reaches the scan
    kind = texts.schema[id_col].dataType
    ids = [F.lit(r.entity_id).cast(kind) for r in rows]
    picked = texts.filter(F.col(id_col).isin(*ids)).select(
        F.col(id_col).cast("string").alias("_id"), _page(page_col).alias("_page"), F.col(text_col).alias("_text"))
    scored = index.sparkSession.createDataFrame([tuple(r) for r in rows], top.schema)
    hits = scored.join(picked, (F.col("entity_id") == F.col("_id")) & F.col("page").eqNullSafe(F.col("_page")), "left")
    return with_headline(hits, "_text", query).select("entity_type", "entity_id", "page", "score", "snippet")
