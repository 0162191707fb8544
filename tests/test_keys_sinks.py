import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators.keys import with_defaults, with_surrogate_id
from quarry.sources.sinks import append_audit, write_report


def test_surrogate_ids_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    out = with_surrogate_id(df, ["k"], "sid").collect()
    pairs = sorted((r.k, r.sid) for r in out)
    assert [s for _, s in pairs] == list(range(1, 5001))


def test_defaults(spark):
    t = dt.datetime(2024, 5, 1)
    df = spark.createDataFrame([("a", None), ("b", "done")], "u string, status string")
    out = with_defaults(df, {"status": "discovered", "discovered_at": t}).orderBy("u").collect()
    assert [r.status for r in out] == ["discovered", "done"] and out[0].discovered_at == t


def test_audit_append_and_report(spark):
    d = tempfile.mkdtemp(prefix="quarry-sink-")
    rows = spark.createDataFrame([("u", 200)], "url string, http_status int")
    append_audit(rows, os.path.join(d, "audit"))
    append_audit(rows, os.path.join(d, "audit"))
    assert spark.read.parquet(os.path.join(d, "audit")).count() == 2
    write_report(spark.createDataFrame([("verified", 3)], "status string, n long"), os.path.join(d, "report"))
    files = [f for f in os.listdir(os.path.join(d, "report")) if f.endswith(".json")]
    assert len(files) == 1
