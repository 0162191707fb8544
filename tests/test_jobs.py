import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from quarry.plans.dashboard import dashboard
from quarry.plans.ingest import ingest_all
from quarry.streaming.outcomes import ATTEMPT_SCHEMA, latest_version, start_outcome_stream


def _raw_fixture(spark, root):
    spark.createDataFrame(
        [("e1", "Hello", "a@x", '[{"email":"b@x","name":"B"}]', None, None, "body one", True, 3, "2024-01-01T00:00:00Z"),
         ("e1", "dup", "a@x", None, None, None, "dup", False, 1, None),
         ("e2", None, "c@x", '["d@x"]', '["e@x"]', None, None, False, 0, "garbage")],
        "id string, subject string, sender string, recipients string, cc string, bcc string, body string, "
        "starred boolean, star_count long, date string",
    ).write.parquet(os.path.join(root, "emails.parquet"))
    spark.createDataFrame([("p1", "Ann", 0.9), ("p2", "Bob", None)], "id string, name string, score double") \
        .write.parquet(os.path.join(root, "people.parquet"))
    os.makedirs(os.path.join(root, "documents-full"))
    spark.createDataFrame([("d1", "page text", 1)], "doc_id string, text string, page int") \
        .write.parquet(os.path.join(root, "documents-full", "shard1.parquet"))
    man = {"base_url": "https://b.example/x", "run_id": "r1", "datasets": {
        "emails": {"record_count": 3, "formats": {"parquet": {"url": "https://b.example/x/emails.parquet",
                                                               "size_bytes": 10, "sha256": "aa"}}}}}
    json.dump(man, open(os.path.join(root, "manifest.json"), "w"))


def test_ingest_all(spark):
    raw = tempfile.mkdtemp(prefix="quarry-raw-")
    out = tempfile.mkdtemp(prefix="quarry-out-")
    _raw_fixture(spark, raw)
    run = ingest_all(spark, raw, out).first()
    assert run.status == "completed", run.errors
    assert run.row_counts["emails"] == 2 and run.rows_read["emails"] == 3
    assert run.row_counts["email_recipients"] == 3
    assert run.row_counts["people"] == 2 and run.row_counts["document_fulltext"] == 1
    emails = {r.id: r for r in spark.read.parquet(os.path.join(out, "emails")).collect()}
    assert emails["e2"].date is None and emails["e1"].starred in (True, False)
    assert emails["e1"].recipients in ('[{"email":"b@x","name":"B"}]', None)
    assert emails["e2"].thread_id is None  # mapped column absent in the source
    people = spark.read.parquet(os.path.join(out, "people"))
    assert '"score":0.9' in people.filter(F.col("id") == "p1").first().raw_json
    # second run: mirrored_files upsert keeps old expected values, run log appends
    ingest_all(spark, raw, out)
    assert spark.read.parquet(os.path.join(out, "mirrored_files")).count() == 1
    assert spark.read.parquet(os.path.join(out, "ingest_runs")).count() == 2
    d = dashboard(spark, out)
    counts = {r.table_name: r.row_count for r in d.row_counts.collect()}
    assert counts["emails"] == 2 and counts["asset_registry"] == -1
    assert [(r.status, r.display_class) for r in d.mirror_status.collect()] == [("downloaded", "ok")]
    assert d.last_ingest.count() == 1


def test_outcome_stream(spark):
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    reg_root = os.path.join(root, "registry")
    spark.createDataFrame(
        [("u1", None, None, None, None, None, "discovered", None), ("u2", None, None, None, None, None, "discovered", None)],
        "asset_url string, local_path string, content_type string, size_bytes long, sha256 string, "
        "http_status int, status string, downloaded_at timestamp").write.parquet(os.path.join(reg_root, "v=0"))
    att_dir = os.path.join(root, "attempts")
    t0 = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("u1", 200, "x", 1, "h", "p/u1", t0)], ATTEMPT_SCHEMA).write.parquet(att_dir)
    q = start_outcome_stream(spark, att_dir, reg_root, os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    reg = {r.asset_url: r.status for r in spark.read.parquet(latest_version(spark, reg_root)).collect()}
    assert reg == {"u1": "downloaded", "u2": "discovered"}
    first_version = latest_version(spark, reg_root)
    # restart with no new attempt files: the checkpoint says nothing is left to do
    q = start_outcome_stream(spark, att_dir, reg_root, os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    assert latest_version(spark, reg_root) == first_version
    spark.createDataFrame([("u2", 404, None, None, None, None, t0)], ATTEMPT_SCHEMA) \
        .write.mode("append").parquet(att_dir)
    q = start_outcome_stream(spark, att_dir, reg_root, os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    reg = {r.asset_url: r.status for r in spark.read.parquet(latest_version(spark, reg_root)).collect()}
    assert reg == {"u1": "downloaded", "u2": "unreachable"}


def test_asset_lifecycle_and_mirror_jobs(spark):
    import hashlib

    from quarry.plans.asset_jobs import discover_job, resolve_job, verify_assets_job, verify_mirror_job

    raw = tempfile.mkdtemp(prefix="quarry-araw-")
    loaded = tempfile.mkdtemp(prefix="quarry-aload-")
    assets = tempfile.mkdtemp(prefix="quarry-assets-")
    spark.createDataFrame([("p1", "http://cdn.test/img/1.jpg", "http://cdn.test/t/1.jpg"), ("p2", "x", None)],
                          "id string, image_url string, thumbnail_url string") \
        .write.parquet(os.path.join(raw, "photos.parquet"))
    spark.createDataFrame([("e1", '[{"url":"http://cdn.test/a.pdf","filename":"a.pdf"}]')],
                          "id string, attachments string").write.parquet(os.path.join(loaded, "emails"))
    reg = discover_job(spark, raw, loaded)
    assert {r.asset_url: r.status for r in reg.collect()} == {
        "http://cdn.test/img/1.jpg": "discovered", "http://cdn.test/t/1.jpg": "discovered",
        "http://cdn.test/a.pdf": "discovered"}
    assert discover_job(spark, raw, loaded, reg).count() == 3  # replay: nothing new
    t0 = dt.datetime(2024, 1, 1)
    audit = spark.createDataFrame(
        [("http://cdn.test/img/1.jpg", 200, "image/jpeg", 3, hashlib.sha256(b"jpg").hexdigest(), t0),
         ("http://cdn.test/a.pdf", 404, None, None, None, t0),
         ("http://cdn.test/t/1.jpg", 200, "image/jpeg", 5, "00", t0)],
        "url string, http_status int, content_type string, size_bytes long, sha256 string, attempted_at timestamp")
    resolved = {r.asset_url: r for r in resolve_job(reg, audit).collect()}
    assert resolved["http://cdn.test/img/1.jpg"].local_path == "photo/img/1.jpg"
    assert resolved["http://cdn.test/a.pdf"].status == "unreachable"
    os.makedirs(os.path.join(assets, "photo", "img"))
    open(os.path.join(assets, "photo", "img", "1.jpg"), "wb").write(b"jpg")
    checked = {r.asset_url: (r.verdict, r.status)
               for r in verify_assets_job(spark, resolve_job(reg, audit), assets).collect()}
    assert checked == {"http://cdn.test/img/1.jpg": ("verified", "downloaded"),
                       "http://cdn.test/t/1.jpg": ("missing", "missing")}
    # mirror verification against a manifest
    mirror = tempfile.mkdtemp(prefix="quarry-mirror-")
    open(os.path.join(mirror, "a.parquet"), "wb").write(b"abc")
    man = {"base_url": "https://m.test/d", "datasets": {"a": {"record_count": 1, "formats": {
        "parquet": {"url": "https://m.test/d/a.parquet", "size_bytes": 3,
                    "sha256": hashlib.sha256(b"abc").hexdigest()},
        "ndjson": {"url": "https://m.test/d/a.ndjson.gz", "size_bytes": 9}}}}}
    json.dump(man, open(os.path.join(mirror, "manifest.json"), "w"))
    verdicts, summary = verify_mirror_job(spark, mirror)
    assert {r.rel_path: r.verdict for r in verdicts.collect()} == {"a.parquet": "verified", "a.ndjson.gz": "missing"}
    s = summary.first()
    assert s.n_files == 2 and s.n_verified == 1 and s.n_missing == 1
