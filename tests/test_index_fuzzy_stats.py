from pyspark.sql import functions as F

from quarry.functions.trigram import py_trigrams
from quarry.operators import index as IX
from quarry.operators import search as S
from quarry.operators import stats as ST
from quarry.operators.fuzzy import fuzzy_match, with_similarity
from quarry.sources.tables import table_path

from conftest import SF_SMALL


def test_increment_equals_full_rebuild(spark):
    d = spark.read.parquet(table_path(SF_SMALL, "documents")).select("doc_id", "text")
    first = IX.index_rows(d.filter(F.col("doc_id") % 3 != 0), "document", "doc_id", "text")
    second = d.filter(F.col("doc_id") != 5).select(
        "doc_id", F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(" edited"))).otherwise(F.col("text")).alias("text"))
    inc = IX.index_increment(first, second, "document", "doc_id", "text")
    full = IX.index_rows(second, "document", "doc_id", "text")
    cols = ["entity_type", "entity_id", "term", "tf", "content_hash"]
    assert inc.select(cols).exceptAll(full.select(cols)).count() == 0
    assert full.select(cols).exceptAll(inc.select(cols)).count() == 0


def test_index_search_equals_text_search(spark):
    d = spark.read.parquet(table_path(SF_SMALL, "documents")).select("doc_id", "text")
    idx = IX.index_rows(d, "document", "doc_id", "text")
    a = {(str(r.doc_id), r.score) for r in S.fts_match(d, "text", "tion ther").collect()}
    b = {(r.entity_id, r.score) for r in IX.search_index(idx, "tion ther").collect()}
    assert a == b and len(a) > 0


def test_trigram_cases(spark):
    assert py_trigrams("cat") == ["  c", " ca", "cat", "at "]
    df = spark.createDataFrame([(1, "Johnson"), (2, "Jonhson"), (3, ""), (4, "a"), (5, "zzz qqq")], "id int, name string")
    sims = {r.id: r.similarity for r in with_similarity(df, "name", "johnson").collect()}
    assert sims[1] == 1.0 and 0.3 < sims[2] < 1.0 and sims[3] == 0.0 and sims[5] == 0.0
    top = [r.id for r in fuzzy_match(df, "id", "name", "Johnson").collect()]
    assert top == [1, 2]
    plan = fuzzy_match(df, "id", "name", "Johnson")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_table_counts_and_profile(spark):
    paths = {"nation": table_path(SF_SMALL, "nation"), "nope": table_path(SF_SMALL, "nope")}
    counts = {r.table_name: r.row_count for r in ST.table_counts(spark, paths).collect()}
    assert counts == {"nation": 25, "nope": -1}
    prof = ST.table_profile(spark, paths).collect()
    nation = [r for r in prof if r.table_name == "nation"]
    assert [r.column_name for r in sorted(nation, key=lambda r: r.ordinal)] == ["n_nationkey", "n_name", "n_regionkey"]
    assert {r.row_count for r in nation} == {25}
    import json
    samples = ST.table_samples(spark, paths, 3).collect()
    assert len(samples) == 3 and "n_name" in json.loads(samples[0].sample)
    assert [r.error is not None for r in prof if r.table_name == "nope"] == [True]
    rc = ST.row_counts_map(ST.table_counts(spark, paths)).first().row_counts
    assert json.loads(rc) == {"nation": 25, "nope": -1}


def test_lookup_pushdown(spark):
    from quarry.operators.entities import lookup_keys
    o = spark.read.parquet(table_path(SF_SMALL, "orders"))
    plan = lookup_keys(o.select("o_orderkey", "o_totalprice"), "o_orderkey", [1, 2, 3])._jdf \
        .queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_orderkey" in plan
    assert "o_custkey" not in plan  # pruned ReadSchema
    keys = spark.createDataFrame([(1,), (2,)], "k long")
    assert lookup_keys(o, "o_orderkey", keys).count() == 2


def test_persisted_index_prunes_by_term_and_type(spark):
    import tempfile

    d = spark.read.parquet(table_path(SF_SMALL, "documents")).select("doc_id", "text")
    path = tempfile.mkdtemp(prefix="quarry-index-") + "/idx"
    IX.write_index(IX.index_rows(d, "document", "doc_id", "text"), path, files=4)
    idx = spark.read.parquet(path)
    q = IX.search_index(idx, "tion ther", "document")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(term,tion),EqualTo(term,ther))]" in plan
    assert "PartitionFilters: [isnotnull(entity_type" in plan
    direct = {(str(r.doc_id), r.score) for r in S.fts_match(d, "text", "tion ther").collect()}
    assert {(r.entity_id, r.score) for r in q.collect()} == direct
    ranked = IX.search_index_ranked(idx, d, "doc_id", "text", "tion ther", "document", limit=5).collect()
    assert len(ranked) == 5 and all("<b>" in r.snippet for r in ranked)
