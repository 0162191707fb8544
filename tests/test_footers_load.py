"""Footers in tasks, shards by schema, one-pass loads, the run log, odd keys."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.functions.jsonpath import field_text, field_value, json_kind
from quarry.operators import stats as ST
from quarry.plans import ingest as IN
from quarry.plans.asset_jobs import verify_assets_job
from quarry.sources.shards import shard_union


def folder():
    return tempfile.mkdtemp(prefix="quarry-test-")


def test_one_corrupt_file_beside_good_ones(spark):
    d = folder()
    rows = spark.range(10).repartition(2)
    for name in ("good", "mixed"):
        rows.write.parquet(f"{d}/{name}")
    with open(f"{d}/mixed/part-x.parquet", "w") as f:
        f.write("no footer here")
    spark.createDataFrame([], "a int").write.parquet(f"{d}/empty")
    os.mkdir(f"{d}/bare")
    paths = {n: f"{d}/{n}" for n in ("good", "mixed", "empty", "gone", "bare")}
    counts = {r.table_name: r.row_count for r in ST.table_counts(spark, paths).collect()}
    assert counts == {"good": 10, "mixed": -1, "empty": 0, "gone": -1, "bare": -1}
    files = ST.file_profile(spark, paths).collect()
    bad = [r for r in files if r.error]
    assert {(r.table_name, r.file_name) for r in bad} == {("mixed", "part-x.parquet"), ("gone", ""), ("bare", "")} or \
        {(r.table_name, r.file_name or "") for r in bad} == {("mixed", "part-x.parquet"), ("gone", ""), ("bare", "")}
    assert sum(r.row_count for r in files if r.table_name == "mixed" and r.column_name == "id") == 10
    profile = {r.table_name: r for r in ST.table_profile(spark, paths).collect()}
    assert profile["mixed"].row_count == 10 and profile["mixed"].error and profile["mixed"].data_type == "bigint"
    samples = ST.table_samples(spark, paths, 3).collect()
    assert [json.loads(r.sample)["id"] for r in sorted(samples, key=lambda r: str(r.row)) if r.table_name == "good"] == \
        [r.id for r in spark.read.parquet(sorted(f"{d}/good/{p}" for p in os.listdir(f"{d}/good") if p.endswith(".parquet"))[0]).collect()][:3]
    assert {r.table_name for r in samples if r.error} == {"mixed", "gone", "bare"}


def test_many_shards_few_scans(spark):
    d = folder()
    kinds = [("doc_id long, text string", lambda i: (i, f"t{i}")), ("id long, content string, page int", lambda i: (i, f"c{i}", i)),
             ("document_id string, body string", lambda i: (str(i), None))]
    paths = []
    for i in range(30):
        schema, row = kinds[i % 3]
        paths.append(f"{d}/a+b (x)/shard_{i:03d}.parquet")
        spark.createDataFrame([row(i)], schema).coalesce(1).write.parquet(paths[-1])
    out = shard_union(spark, paths)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3
    got = {r.shard_name: (r.doc_id, r.text, r.page_number) for r in out.collect()}
    assert len(got) == 30 and got["shard_001"] == ("1", "c1", 1) and got["shard_002"] == ("2", None, None)
    assert got["shard_027"] == ("27", "t27", None)
    with open(f"{d}/a+b (x)/shard_bad.parquet", "w") as f:
        f.write("x")
    with pytest.raises(ValueError, match="shard_bad"):
        shard_union(spark, paths + [f"{d}/a+b (x)/shard_bad.parquet"])
    assert shard_union(spark, []).collect() == []


COLS = [("id", "str"), ("name", "str"), ("at", "timestamp")]


def test_keyed_load_is_one_scan_and_counts(spark):
    d = folder()
    rows = [("10", "first", "2024-01-02"), ("9", "nine", "soon"), ("10", "second", "2024-01-03"), (None, "none", ""), (None, "none", None)]
    src = spark.createDataFrame(rows, "id string, name string, at string").coalesce(1)
    src.write.parquet(f"{d}/src")
    stored = spark.read.parquet(f"{d}/src")
    got = IN.load_table(spark, stored, f"{d}/out", COLS, "id", rejects_path=f"{d}/rejects")
    assert (*got, got.rejected) == (5, 4, 1)
    assert sorted((r.id or "", r.name) for r in spark.read.parquet(f"{d}/out").collect()) == \
        [("", "none"), ("", "none"), ("10", "first"), ("9", "nine")]
    reject = spark.read.parquet(f"{d}/rejects").first()
    assert (reject.key, reject.column_name, reject.value) == ("9", "at", "soon") and json.loads(reject.raw_json)["name"] == "nine"
    # an order of its own: the last name first; works on sources that are no files
    got = IN.load_table(spark, src.filter("id IS NOT NULL"), f"{d}/out2", COLS, "id", order=["name"])
    assert (*got, got.rejected) == (3, 2, 1)
    with pytest.raises(ValueError, match="order"):
        IN.load_table(spark, src, f"{d}/out3", COLS, "id")
    empty = spark.createDataFrame([], src.schema)
    assert IN.load_table(spark, empty, f"{d}/out4", COLS, None) == (0, 0)
    assert IN.load_table(spark, empty, f"{d}/out5", COLS, "id", order=["name"]) == (0, 0)


def test_run_log(spark, monkeypatch):
    d = folder()
    raw, out = f"{d}/raw", f"{d}/out"
    spark.createDataFrame([("1", "a")], "id string, name string").write.parquet(f"{raw}/people.parquet")
    with open(f"{raw}/manifest.json", "w") as f:
        json.dump({"run_id": "r7", "generated_at": "2024-01-02T03:04:05", "base_url": "http://h", "datasets": {
            "people": {"record_count": 1, "formats": {"parquet": {"url": "http://h/people.parquet", "size_bytes": 3, "sha256": "x"}}}}}, f)
    row = IN.ingest_all(spark, raw, out).first()
    assert row.status == "completed" and row.row_counts == {"people": 1} and row.rejected == {"people": 0}
    assert row.tables_loaded == ["people", "dataset_manifest", "mirrored_files"]
    manifest = spark.read.parquet(f"{out}/dataset_manifest").first()
    assert manifest.run_id == "r7" and "people" in json.loads(manifest.raw_json)["datasets"]

    class Killed(BaseException):
        pass

    def die(*a, **b):
        raise Killed

    monkeypatch.setattr(IN, "load_table", die)
    with pytest.raises(Killed):
        IN.ingest_all(spark, raw, out)
    states = sorted(r.status for r in IN.run_log(spark, f"{out}/ingest_runs").collect())
    assert states == ["completed", "running"]

    def fail(*a, **b):
        raise RuntimeError("boom")

    monkeypatch.setattr(IN, "load_table", fail)
    assert IN.ingest_all(spark, raw, out).first().errors == {"fatal": "boom"}


def test_odd_json_keys(spark):
    doc = {"it's": 1, "a*?": {"x": [1, "z"]}, "b'\"c": "s", "d\\e": None, "": "empty", "plain.key": True}
    df = spark.createDataFrame([(json.dumps(doc),), ("[1]",), ("bad",), (None,)], "j string")
    for key, text, kind in [("it's", "1", "number"), ("a*?", '{"x":[1,"z"]}', "object"), ("b'\"c", "s", "string"),
                            ("d\\e", None, None), ("", "empty", "string"), ("plain.key", "true", "boolean"), ("no'ne", None, None)]:
        got = df.select(field_text(F.col("j"), key).alias("t"), json_kind(field_value(F.col("j"), key)).alias("k")).collect()
        assert (got[0].t, got[0].k if text is not None else None) == (text, kind), key
        assert [r.t for r in got[1:]] == [None] * 3


def test_assets_under_an_odd_root(spark):
    d = folder() + "/assets+x(1).d"
    os.makedirs(d + "/img")
    with open(d + "/img/a.jpg", "wb") as f:
        f.write(b"abc")
    registry = spark.createDataFrame([("u", "img/a.jpg", "downloaded", 3, None)],
                                     "asset_url string, local_path string, status string, size_bytes long, sha256 string")
    out = verify_assets_job(spark, registry, d)
    first = out[0] if isinstance(out, tuple) else out
    assert "missing" not in str(first.collect())


def test_listing_by_levels(spark):
    from quarry.sources.files import _list_by_scan, list_files

    d = folder() + "/r+t (1)"
    names = ["a.txt", "b c.txt", "x/d.txt", "x/y/z/e.txt", "x/y/f.bin", "_temporary/h.txt", ".hidden", "k=_1/g.txt", "x/.i.crc", "p%20q/j.txt"]
    for i, name in enumerate(names):
        os.makedirs(os.path.dirname(f"{d}/{name}"), exist_ok=True)
        with open(f"{d}/{name}", "wb") as f:
            f.write(b"x" * i)
    os.makedirs(f"{d}/empty/folder")
    want = {("a.txt", 0), ("b c.txt", 1), ("d.txt", 2), ("e.txt", 3), ("g.txt", 7), ("j.txt", 9)}
    listed = list_files(spark, d, "*.txt")
    assert {(r.file_name, r.actual_size) for r in listed.collect()} == want
    scanned = {(r.path, r.actual_size) for r in _list_by_scan(spark, d, "*.txt").collect()}
    assert {(r.path, r.actual_size) for r in listed.collect()} == scanned
    assert {r.file_name for r in list_files(spark, d).collect()} == {n for n, _ in want} | {"f.bin"}
    assert [tuple(r)[1:] for r in list_files(spark, f"{d}/b c.txt").collect()] == [("b c.txt", 1)]
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan  # no paths from the driver
    with pytest.raises(FileNotFoundError):
        list_files(spark, d + "/gone")
