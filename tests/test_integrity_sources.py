import gzip
import hashlib
import json
import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators import integrity as IG
from quarry.sources.files import checksums, list_files
from quarry.sources.manifest import flatten_manifest, read_manifest
from quarry.sources.shards import read_ndjson, shard_union

from conftest import SF_SMALL


def test_checksums_match_hashlib(spark):
    got = {r.file_name: (r.actual_size, r.actual_sha256) for r in checksums(spark, SF_SMALL, "*.parquet").collect()}
    for name in ("orders.parquet", "region.parquet"):
        data = open(os.path.join(SF_SMALL, name), "rb").read()
        assert got[name] == (len(data), hashlib.sha256(data).hexdigest())
    assert list_files(spark, SF_SMALL, "*.parquet").count() == len(got)


def test_verify_files_five_outcomes(spark):
    expected = spark.createDataFrame([
        ("ok", 3, "aaa"), ("gone", 3, "aaa"), ("badsize", 4, "aaa"), ("badhash", 3, "bbb"),
        ("presence", 0, ""), ("both", 9, "zzz")], "rel_path string, expected_size long, expected_sha256 string")
    listing = spark.createDataFrame([
        ("ok", 3, "aaa"), ("badsize", 3, "aaa"), ("badhash", 3, "aaa"), ("presence", 3, "aaa"), ("both", 3, "aaa")],
        "rel_path string, actual_size long, actual_sha256 string")
    v = {r.rel_path: r.verdict for r in IG.verify_files(expected, listing).collect()}
    assert v == {"ok": "verified", "gone": "missing", "badsize": "size_mismatch", "badhash": "hash_mismatch",
                 "presence": "verified", "both": "size_mismatch"}
    summary = IG.mirror_summary(IG.verify_files(expected, listing).withColumnRenamed("verdict", "status")
                                .withColumn("size_bytes", F.col("expected_size"))).first()
    assert summary.n_files == 6 and summary.n_verified == 2 and summary.n_missing == 1


def test_verify_assets_missing_sets_status_corrupt_does_not(spark):
    reg = spark.createDataFrame([("u1", "a/1", 3, "h", "downloaded"), ("u2", "a/2", 3, "h", "downloaded"),
                                 ("u3", "a/3", 3, "h", "downloaded"), ("u4", "a/4", 3, "h", "discovered")],
                                "asset_url string, local_path string, size_bytes long, sha256 string, status string")
    lst = spark.createDataFrame([("a/1", 3, "h"), ("a/3", 4, "h")], "local_path string, actual_size long, actual_sha256 string")
    out = {r.asset_url: (r.verdict, r.status) for r in IG.verify_assets(reg, lst).collect()}
    assert out == {"u1": ("verified", "downloaded"), "u2": ("missing", "missing"), "u3": ("corrupt", "downloaded")}


def test_manifest_flatten(spark):
    d = tempfile.mkdtemp(prefix="quarry-manifest-")
    man = {"version": "1", "base_url": "https://b.example/data", "datasets": {
        "emails": {"record_count": 10, "formats": {
            "parquet": {"url": "https://b.example/data/emails.parquet", "size_bytes": 5, "sha256": "ab"},
            "ndjson": {"url": "https://b.example/data/emails.ndjson.gz"}}},
        "empty": {"record_count": 0}}}
    p = os.path.join(d, "manifest.json")
    json.dump(man, open(p, "w"), indent=2)
    rows = sorted(tuple(r) for r in flatten_manifest(read_manifest(spark, p)).collect())
    assert rows == [
        ("emails", "ndjson", "https://b.example/data/emails.ndjson.gz", "emails.ndjson.gz", 0, "", 10),
        ("emails", "parquet", "https://b.example/data/emails.parquet", "emails.parquet", 5, "ab", 10),
    ]


def test_shard_union_different_column_names(spark):
    d = tempfile.mkdtemp(prefix="quarry-shards-")
    spark.createDataFrame([("d1", "hello", 1), ("", "x", 0)], "id string, text string, page_number int") \
        .write.parquet(os.path.join(d, "b.parquet"))
    spark.createDataFrame([(7, "body text", 2)], "document_id long, body string, page long") \
        .write.parquet(os.path.join(d, "a.parquet"))
    out = shard_union(spark, [os.path.join(d, "b.parquet"), os.path.join(d, "a.parquet")])
    rows = sorted(((r.shard_name, r.doc_id, r.page_number, r.text) for r in out.collect()), key=repr)
    assert rows == sorted([("a", "7", 2, "body text"), ("b", None, None, "x"), ("b", "d1", 1, "hello")], key=repr)


def test_ndjson_equals_parquet(spark):
    d = tempfile.mkdtemp(prefix="quarry-ndjson-")
    src = spark.read.parquet(os.path.join(SF_SMALL, "nation.parquet"))
    p = os.path.join(d, "nation.ndjson.gz")
    with gzip.open(p, "wt") as fh:
        for r in src.collect():
            fh.write(json.dumps(r.asDict()) + "\n")
    nd = read_ndjson(spark, p, src.schema, partitions=2)
    assert sorted(map(tuple, nd.collect())) == sorted(map(tuple, src.collect()))


def test_large_files_use_streaming_digest(spark):
    d = tempfile.mkdtemp(prefix="quarry-big-")
    blobs = {"a.bin": b"x" * 5000, "b b.bin": b"hello", "c.bin": b"", "d e.bin": b""}
    for n, b in blobs.items():
        open(os.path.join(d, n), "wb").write(b)
    got = {r.file_name: (r.actual_size, r.actual_sha256) for r in checksums(spark, d, "*.bin").collect()}
    assert got == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in blobs.items()}


def test_verify_mirror_two_pass(spark):
    from quarry.operators.integrity import verify_mirror
    d = tempfile.mkdtemp(prefix="quarry-mirror-")
    open(os.path.join(d, "ok.parquet"), "wb").write(b"abc")
    open(os.path.join(d, "bad.parquet"), "wb").write(b"abcd")
    open(os.path.join(d, "hash.parquet"), "wb").write(b"xyz")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = spark.createDataFrame([
        ("ok.parquet", 3, sha(b"abc")), ("bad.parquet", 3, sha(b"abc")), ("hash.parquet", 3, sha(b"abc")),
        ("gone.parquet", 3, "")], "rel_path string, expected_size long, expected_sha256 string")
    v = {r.rel_path: r.verdict for r in verify_mirror(spark, expected, d).collect()}
    assert v == {"ok.parquet": "verified", "bad.parquet": "size_mismatch", "hash.parquet": "hash_mismatch",
                 "gone.parquet": "missing"}
