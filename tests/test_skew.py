"""One key holding a third of all rows: results stay exact and the hot key is
combined map-side (partial aggregates / partial window-group limits)."""

from pyspark.sql import functions as F

from quarry.operators import index as IX
from quarry.operators import merge as MG
from quarry.operators import search as S
from quarry.session import cluster_conf


def _skewed(spark, n=30000):
    # key "hot" holds a third of the rows, the rest spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string")).alias("k"),
        F.col("id").alias("ts"), (F.col("id") * 7 % 101).alias("v"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_and_first_are_partial_before_the_shuffle(spark):
    df = _skewed(spark).repartition(8)
    last = MG.latest_by(df, "k", ["ts"])
    plan = _plan(last)
    assert "partial_max_by" in plan
    hot = last.filter(F.col("k") == "hot").first()
    assert hot.ts == 29997
    first = MG.dedupe_first(df, "k", [F.col("ts")])
    assert "partial_min_by" in _plan(first)
    assert first.filter(F.col("k") == "hot").first().ts == 0


def test_top_k_per_group_limits_map_side(spark):
    df = _skewed(spark).repartition(8).withColumnRenamed("k", "query").withColumn("score", F.col("v").cast("double"))
    top = S.top_k_per_query(df, [F.col("score").desc(), F.col("ts")], 5)
    plan = _plan(top)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    hot = [r.ts for r in top.filter(F.col("query") == "hot").orderBy("_pos").collect()]
    expected = sorted(((-(t * 7 % 101), t) for t in range(0, 30000, 3)))[:5]
    assert hot == [t for _, t in expected]


def test_hot_term_is_combined_before_the_shuffle(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 100, F.lit(" ".join(["hot"] * 200))).otherwise(F.lit("cold words here")).alias("text"))
    idx = IX.index_rows(docs, "document", "doc_id", "text")
    assert "partial_count" in _plan(idx)
    stats = {r.term: (r.n_entities, r.total_tf) for r in IX.term_stats(idx).collect()}
    assert stats["hot"] == (100, 20000) and stats["cold"] == (200, 200)


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(100 * (1 << 40))
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert 100_000 < parts < 200_000  # 30 TB of shuffle at ~256 MB each
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
