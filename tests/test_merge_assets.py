import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import assets as AS
from quarry.operators import merge as MG

REG_SCHEMA = ("asset_url string, local_path string, content_type string, size_bytes long, sha256 string, "
              "http_status int, status string, downloaded_at timestamp")
ATT_SCHEMA = ("url string, http_status int, content_type string, size_bytes long, sha256 string, "
              "local_path string, attempted_at timestamp")


def test_insert_if_absent_existing_wins_and_idempotent(spark):
    target = spark.createDataFrame([("k1", "old")], "k string, v string")
    batch = spark.createDataFrame([("k1", "new", 1), ("k2", "b", 2), ("k2", "a", 1)], "k string, v string, o int")
    once = MG.insert_if_absent(target, batch.drop("o").withColumn("o", F.lit(0)).drop("o"), "k", [F.col("v")])
    rows = sorted(tuple(r) for r in once.collect())
    assert rows == [("k1", "old"), ("k2", "a")]
    twice = MG.insert_if_absent(once, batch.drop("o"), "k", [F.col("v")])
    assert sorted(tuple(r) for r in twice.collect()) == rows


def test_upsert_partial_keeps_old_non_updated_columns(spark):
    target = spark.createDataFrame([("d", "parquet", 100, "downloaded")], "ds string, fmt string, size long, status string")
    batch = spark.createDataFrame([("d", "parquet", 999, "verified"), ("e", "ndjson", 5, "new")],
                                  "ds string, fmt string, size long, status string")
    out = MG.upsert_partial(target, batch, ["ds", "fmt"], ["status"])
    rows = sorted(tuple(r) for r in out.collect())
    assert rows == [("d", "parquet", 100, "verified"), ("e", "ndjson", 5, "new")]
    again = MG.upsert_partial(out, batch, ["ds", "fmt"], ["status"])
    assert sorted(tuple(r) for r in again.collect()) == rows


def test_apply_outcomes_fixture(spark):
    t0 = dt.datetime(2024, 1, 1)
    reg = spark.createDataFrame([
        (u, None, None, None, None, None, s, None) for u, s in
        [("u200", "discovered"), ("u403", "discovered"), ("u404", "discovered"), ("u410", "discovered"),
         ("u500", "discovered"), ("unull", "discovered"), ("utwo", "discovered"), ("udone", "downloaded"),
         ("unone", "discovered")]], REG_SCHEMA)

    def att(u, code, k):
        return (u, code, "image/png", 10, "h", "p/" + u, t0 + dt.timedelta(minutes=k))

    atts = spark.createDataFrame([
        att("u200", 200, 1), att("u403", 403, 1), att("u404", 404, 1), att("u410", 410, 1),
        att("u500", 500, 1), att("unull", None, 1), att("utwo", 500, 1), att("utwo", 200, 2),
        att("udone", 404, 1)], ATT_SCHEMA)
    out = {r.asset_url: r for r in MG.apply_outcomes(reg, atts).collect()}
    assert out["u200"].status == "downloaded" and out["u200"].local_path == "p/u200"
    assert out["u200"].downloaded_at == t0 + dt.timedelta(minutes=1)
    assert {out[u].status for u in ("u403", "u404", "u410")} == {"unreachable"}
    assert out["u404"].local_path is None and out["u404"].http_status == 404
    assert out["u500"].status == "failed" and out["unull"].status == "failed"
    assert out["utwo"].status == "downloaded"  # latest attempt wins
    assert out["udone"].status == "downloaded" and out["udone"].http_status is None  # not discovered
    assert out["unone"].status == "discovered"


def test_discover_assets_keep_first_and_http_only(spark):
    photos = spark.createDataFrame([("p1", "http://a/1.jpg", "http://a/t1.jpg", "x"), ("p2", "ftp://a/2", None, None)],
                                   "id string, image_url string, thumbnail_url string, title string")
    people = spark.createDataFrame([("d9", "http://a/1.jpg")], "doc_id string, avatar_url string")
    msgs = spark.createDataFrame([("m1", '[{"url":"http://a/att.pdf"},{"url":"rel/x"}, {"name":"n"}]'),
                                  ("m2", '{"url":"http://a/obj"}')], "id string, attachments string")
    sources = [AS.ColumnSource(photos, "photos", "photo"), AS.ColumnSource(people, "people", "person"),
               AS.JsonSource(msgs, "imessage_messages", "message_attachment", "id", "attachments")]
    out = {r.asset_url: r for r in AS.discover_assets(sources).collect()}
    assert set(out) == {"http://a/1.jpg", "http://a/t1.jpg", "http://a/att.pdf"}
    assert out["http://a/1.jpg"].source_dataset == "photos"
    assert out["http://a/att.pdf"].source_entity_id == "m1"
    assert all(r.status == "discovered" for r in out.values())


def test_latest_row(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 1)), (3, dt.datetime(2023, 1, 1))],
                               "id int, started_at timestamp")
    assert MG.latest_row(df, "started_at").first().id == 2
