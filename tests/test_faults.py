"""Cases in which earlier versions gave wrong or partial results."""

import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as PT

from quarry.functions import convert as C
from quarry.functions import jsonpath as J
from quarry.operators import index as IX
from quarry.operators.entities import ilike_search
from quarry.operators.keys import with_surrogate_id
from quarry.operators.search import fts_match
from quarry.operators.stats import table_counts, table_profile, table_samples
from quarry.plans.ingest import load_table
from quarry.plans.search_all import SearchTables, search_all
from quarry.sources.files import checksums, list_files


def folder():
    return tempfile.mkdtemp(prefix="quarry-faults-")


def test_surrogate_ids_with_payload(spark):
    out = folder() + "/ids"
    df = spark.range(0, 200_000, 1, 8).select((F.col("id") * 7919 % 200_000).alias("k"), F.repeat(F.lit("x"), 20).alias("payload"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        with_surrogate_id(df, ["k"], "sid").write.parquet(out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = spark.read.parquet(out)
    r = got.agg(F.count("sid"), F.countDistinct("sid"), F.max("sid"), F.sum((F.col("sid") != F.col("k") + 1).cast("int"))).first()
    assert tuple(r) == (200_000, 200_000, 200_000, 0)
    assert got.columns == ["k", "payload", "sid"]


def test_search_has_no_cap(spark):
    docs = spark.createDataFrame([(str(i), f"alpha {i}") for i in range(150)], "id string, text string")
    people = docs.select("id", F.col("text").alias("name"), F.lit(None).cast("string").alias("description"))
    got = search_all(spark, SearchTables(people=people), "alpha", limit=150)
    assert got.count() == 150


def test_load_keeps_first_in_file_order_and_rows_without_key(spark):
    d = folder()
    spark.createDataFrame([("1", "zzz first"), ("1", "aaa second"), (None, "no key"), ("2", "b")], "id string, title string") \
        .coalesce(1).write.parquet(d + "/a")
    cols = [("id", "str"), ("title", "str")]
    assert load_table(spark, spark.read.parquet(d + "/a"), d + "/out", cols, "id") == (4, 3)
    assert {(r.id, r.title) for r in spark.read.parquet(d + "/out").collect()} == {("1", "zzz first"), (None, "no key"), ("2", "b")}
    spark.createDataFrame([("x",), ("y",)], "title string").write.parquet(d + "/b")
    assert load_table(spark, spark.read.parquet(d + "/b"), d + "/out", cols, "id") == (2, 2)
    spark.createDataFrame([("x",)], "other string").write.parquet(d + "/c")
    assert load_table(spark, spark.read.parquet(d + "/c"), d + "/out", cols, "id") == (1, 0)
    assert spark.read.parquet(d + "/out").count() == 2  # left as it was


def test_increment_of_one_page(spark):
    pages = [("d1", "alpha one page"), ("d1", "beta two page")]
    first = IX.index_rows(spark.createDataFrame(pages, "id string, text string"), "document", "id", "text")
    second = spark.createDataFrame([pages[0], ("d1", "gamma three page")], "id string, text string")
    key = lambda df: sorted(tuple(r) for r in df.select("entity_id", "term", "tf", "content_hash").collect())
    assert key(IX.index_increment(first, second, "document", "id", "text")) == key(IX.index_rows(second, "document", "id", "text"))


def test_index_hits_are_pages(spark):
    df = spark.createDataFrame([("d1", "alpha one"), ("d1", "beta two"), ("d2", "alpha beta")], "id string, text string")
    hits = IX.search_index(IX.index_rows(df, "document", "id", "text"), "alpha beta").collect()
    assert [r.entity_id for r in hits] == [r.id for r in fts_match(df, "text", "alpha beta").collect()] == ["d2"]


def test_hot_term_spreads_over_files(spark):
    out = folder() + "/ix"
    df = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit("common").alias("text"))
    IX.write_index(IX.index_rows(df, "document", "id", "text"), out, files=8)
    assert spark.read.parquet(out).filter("term = 'common'").select(F.input_file_name()).distinct().count() >= 4


@pytest.mark.parametrize("query,ids", [("foo !lic:*", [1]), ("lic:*|zzz", [2, 3]), ("foo !lic:*|bar", []), ("ba:*|lic:*", [1, 2, 3])])
def test_composed_query_operators(spark, query, ids):
    df = spark.createDataFrame([(1, "foo bar"), (2, "foo license"), (3, "licence zzz")], "id int, text string")
    assert sorted(r.id for r in fts_match(df, "text", query).collect()) == ids
    ix = IX.index_rows(df, "document", "id", "text")
    assert sorted(int(r.entity_id) for r in IX.search_index(ix, query).collect()) == ids


def test_backslash_in_ilike(spark):
    df = spark.createDataFrame([(1, r"a\b"), (2, "ab")], "id int, name string")
    assert [r.id for r in ilike_search(df, "id", ["name"], "a\\b").collect()] == [1]


def test_converters(spark):
    df = spark.createDataFrame([((None, 1), 12345678.9, '{"a.b": 5, "a": {"b": 6}}')], "s struct<a:string,b:int>, x double, j string")
    r = df.select(C.safe_str(F.col("s"), df.schema["s"].dataType).alias("s"), C.safe_str(F.col("x"), PT.DoubleType()).alias("x"),
                  C.safe_json(F.col("s"), df.schema["s"].dataType).alias("sj"), J.field_text(F.col("j"), "a.b").alias("f"),
                  J.json_kind(J.field_value(F.col("j"), "a")).alias("k")).first()
    assert tuple(r) == ('{"a":null,"b":1}', "12345678.9", '{"a":null,"b":1}', "5", "object")


def test_corrupt_file(spark):
    d = folder()
    spark.range(3).write.parquet(d + "/good")
    os.mkdir(d + "/bad")
    with open(d + "/bad/part-0.parquet", "wb") as f:
        f.write(b"not parquet at all")
    paths = {"good": d + "/good", "bad": d + "/bad", "gone": d + "/gone"}
    assert {r.table_name: r.row_count for r in table_counts(spark, paths).collect()} == {"good": 3, "bad": -1, "gone": -1}
    assert {r.table_name for r in table_profile(spark, paths).collect() if r.error} == {"bad", "gone"}
    samples = table_samples(spark, paths)
    assert samples.filter("error IS NULL").count() == 3
    assert {r.table_name for r in samples.collect() if r.error} == {"bad", "gone"}


def test_names_with_blanks(spark):
    d = folder()
    for name, data in (("a b.txt", b"abc"), ("c%20d.txt", b"x"), ("e f.txt", b"")):
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    assert {(r.file_name, r.actual_size) for r in list_files(spark, d).collect()} == {("a b.txt", 3), ("c%20d.txt", 1), ("e f.txt", 0)}
    got = {r.file_name: r.actual_sha256 for r in checksums(spark, d).collect()}
    assert got == {"a b.txt": hashlib.sha256(b"abc").hexdigest(), "c%20d.txt": hashlib.sha256(b"x").hexdigest(),
                   "e f.txt": hashlib.sha256(b"").hexdigest()}
