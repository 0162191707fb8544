"""Dataset manifest source.

The manifest is ``{"base_url", "datasets": {name: {"record_count",
"formats": {format: {"url", "size_bytes", "sha256"}}}}}``.  Read with an
explicit ``MapType`` schema and flattened with two map explodes, one row per
(dataset, format); a dataset without ``formats`` gives no rows, a missing size
is 0 and a missing hash ''.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.urls import relative_path

FORMAT_INFO = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("sha256", T.StringType()),
])
DATASET_INFO = T.StructType([
    T.StructField("record_count", T.LongType()),
    T.StructField("formats", T.MapType(T.StringType(), FORMAT_INFO)),
])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("generated_at", T.StringType()),
    T.StructField("base_url", T.StringType()),
    T.StructField("datasets", T.MapType(T.StringType(), DATASET_INFO)),
])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(path)


def parse_manifest(json_text: DataFrame, col: str = "manifest") -> DataFrame:
    """Manifest(s) held as JSON text in a column -> manifest rows."""
    return json_text.select(F.from_json(F.col(col), MANIFEST_SCHEMA).alias("m")).select("m.*")


def flatten_manifest(manifest: DataFrame, base_url: str | None = None) -> DataFrame:
    """``(dataset, format, url, rel_path, size, sha256, records)``."""
    ds = manifest.select("base_url", F.explode("datasets").alias("dataset", "info"))
    fm = ds.select(
        "base_url", "dataset", F.col("info.record_count").alias("records"),
        F.explode("info.formats").alias("format", "f"),
    )
    base = F.lit(base_url) if base_url else F.col("base_url")
    rel = (relative_path(F.col("f.url"), base_url) if base_url
           else F.replace(F.col("f.url"), F.concat(base, F.lit("/")), F.lit("")))
    return fm.select(
        "dataset", "format", F.col("f.url").alias("url"), rel.alias("rel_path"),
        F.coalesce(F.col("f.size_bytes"), F.lit(0)).cast("bigint").alias("size"),
        F.coalesce(F.col("f.sha256"), F.lit("")).alias("sha256"),
        F.col("records").cast("bigint").alias("records"),
    )
