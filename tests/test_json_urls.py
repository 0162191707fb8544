from pyspark.sql import functions as F

from quarry.functions.urls import asset_path, is_http, relative_path
from quarry.operators.recipients import normalize_recipients

import pytest


def test_recipients_cells(spark):
    cells = [
        ("e1", None), ("e2", "[]"), ("e3", '{"email":"a@x"}'), ("e4", '["a@x"]'),
        ("e5", '[{"email":"a@x","name":"A"}]'), ("e6", '[{"name":"A"}]'), ("e7", "[5,null]"),
        ("e8", "not json"), ("e9", '["a@x","a@x"]'),
    ]
    df = spark.createDataFrame(cells, "id string, recipients string")
    rows = sorted((r.email_id, r.recipient_type, r.email, r.name) for r in normalize_recipients(df).collect())
    assert rows == [
        ("e4", "recipients", "a@x", None),
        ("e5", "recipients", "a@x", "A"),
        ("e6", "recipients", None, "A"),
        ("e7", "recipients", None, None), ("e7", "recipients", None, None),
        ("e9", "recipients", "a@x", None), ("e9", "recipients", "a@x", None),
    ]


def test_recipients_three_columns_one_scan(spark):
    df = spark.createDataFrame([("e", '["t@x"]', '["c@x"]', '["b@x", "b2@x"]')],
                               "id string, recipients string, cc string, bcc string")
    out = normalize_recipients(df)
    assert sorted(r.recipient_type for r in out.collect()) == ["bcc", "bcc", "cc", "recipients"]
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") <= 1


def test_url_functions(spark):
    urls = [None, "http://h", "http://h/", "http://h/a/b?c=1", "http://h/a/b?c=2", "https://h/x",
            "HTTP://h/y", "ftp://h/z", "not a url"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    out = df.select("u", is_http(F.col("u")).alias("ok"),
                    asset_path(F.col("u"), F.lit("photo")).alias("p")).collect()
    ok = {r.u: r.ok for r in out}
    assert ok["http://h/a/b?c=1"] and ok["https://h/x"] and not ok["HTTP://h/y"] and not ok["ftp://h/z"]
    assert ok[None] in (None, False)
    paths = {r.u: r.p for r in out}
    assert paths["http://h/a/b?c=1"] == paths["http://h/a/b?c=2"] == "photo/a/b"
    import hashlib
    assert paths["http://h/"] == "photo/" + hashlib.md5(b"http://h/").hexdigest()
    assert paths["http://h"] == "photo/" + hashlib.md5(b"http://h").hexdigest()
    t = df.select(asset_path(F.col("u"), F.lit("")).alias("p")).collect()[3].p
    assert t == "unknown/a/b"


def test_relative_path_requires_base(spark):
    df = spark.createDataFrame([("https://b.example/d/f.parquet",)], "u string")
    assert df.select(relative_path(F.col("u"), "https://b.example/d").alias("r")).first().r == "f.parquet"
    with pytest.raises(ValueError):
        relative_path(F.col("u"), "")
