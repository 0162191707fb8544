"""Asset and mirror jobs (U6, U7, U9, J7): the reference's scripts as Spark
jobs over stored tables.

* :func:`discover_job` - URL columns of the raw datasets + attachment JSON of
  the loaded e-mails / messages -> registry (insert-if-absent on asset_url).
* :func:`resolve_job` - latest audit attempt per URL advances ``discovered``
  registry rows (the crawler itself is out of scope; its log is the input).
* :func:`verify_assets_job` - ``downloaded`` rows checked against storage.
* :func:`verify_mirror_job` - manifest entries checked against the mirror,
  with one-pass tallies.

Each job writes a new registry directory and never overwrites the one it
reads; the caller swaps paths (or keeps versions).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.urls import asset_path
from quarry.operators import assets as AS
from quarry.operators.integrity import mirror_summary, verify_assets, verify_mirror
from quarry.operators.merge import apply_outcomes, latest_by
from quarry.plans.ingest import _try_read
from quarry.sources.files import checksums
from quarry.sources.manifest import flatten_manifest, read_manifest

# Datasets scanned for URL columns, in discovery order, with the
# entity type they describe; then the loaded tables whose attachment JSON is read.
URL_DATASETS = (
    ("photos.parquet", "photos", "photo"),
    ("documents.parquet", "documents", "document"),
    ("people.parquet", "people", "person"),
    ("emails-slim.parquet", "emails-slim", "email"),
)
ATTACHMENT_TABLES = (
    ("emails", "emails", "email_attachment"),
    ("imessage_messages", "imessage_messages", "message_attachment"),
)

REGISTRY_SCHEMA = (
    "asset_url string, source_dataset string, source_entity_type string, source_entity_id string, "
    "local_path string, content_type string, size_bytes bigint, sha256 string, http_status int, "
    "status string, discovered_at timestamp, downloaded_at timestamp"
)


def _empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_SCHEMA)


def discover_job(spark: SparkSession, raw_root: str, loaded_root: str,
                 registry: DataFrame | None = None) -> DataFrame:
    """U7 + S7: the registry after discovery (existing rows win)."""
    sources: list[AS.ColumnSource | AS.JsonSource] = []
    for fname, dataset, etype in URL_DATASETS:
        df = _try_read(spark, os.path.join(raw_root, fname))
        if df is not None:
            sources.append(AS.ColumnSource(df, dataset, etype))
    for table, dataset, etype in ATTACHMENT_TABLES:
        df = _try_read(spark, os.path.join(loaded_root, table))
        if df is not None and "attachments" in df.columns:
            sources.append(AS.JsonSource(df, dataset, etype, "id", "attachments"))
    current = registry if registry is not None else _empty_registry(spark)
    usable = [s for s in sources if not isinstance(s, AS.ColumnSource)
              or any(AS.is_url_column(c) for c in s.df.columns)]
    if not usable:
        return current
    found = AS.discover_assets(usable).withColumn("discovered_at", F.current_timestamp())
    fresh = found.select(*[F.col(c) if c in found.columns else F.lit(None).cast(t).alias(c)
                           for c, t in (f.split(" ") for f in REGISTRY_SCHEMA.split(", "))])
    return AS.register_assets(current, fresh)


def resolve_job(registry: DataFrame, audit: DataFrame) -> DataFrame:
    """U6 + S10 + F13: apply the latest attempt per URL (audit log columns
    url, http_status, content_type, size_bytes, sha256, attempted_at).  The
    local path is derived from the URL and entity type (P14)."""
    last = latest_by(audit, "url", ["attempted_at"])  # the log is reduced before it meets the registry
    attempts = last.join(
        registry.select(F.col("asset_url").alias("url"), "source_entity_type"), "url", "left"
    ).withColumn("local_path", asset_path(F.col("url"), F.col("source_entity_type")))
    return apply_outcomes(registry, attempts.drop("source_entity_type"))


def verify_assets_job(spark: SparkSession, registry: DataFrame, assets_root: str) -> DataFrame:
    """Registry ``local_path`` values are relative to ``assets_root``."""
    root = assets_root.rstrip("/")
    inside = root.split("://")[-1] + "/"
    behind = F.locate(inside, F.col("path")) + len(inside)  # the first place is that of the root
    listing = checksums(spark, root).select(
        F.substr("path", behind).alias("local_path"), "actual_size", "actual_sha256")
    return verify_assets(registry, listing)


def verify_mirror_job(spark: SparkSession, raw_root: str) -> tuple[DataFrame, DataFrame]:
    """Per-file verdicts of the manifest under ``raw_root`` and tallies."""
    flat = flatten_manifest(read_manifest(spark, os.path.join(raw_root, "manifest.json")))
    expected = flat.select("rel_path", F.col("size").alias("expected_size"),
                           F.col("sha256").alias("expected_sha256"), "dataset", "format")
    verdicts = verify_mirror(spark, expected, raw_root)
    summary = mirror_summary(verdicts.withColumnRenamed("verdict", "status"), "status", "actual_size")
    return verdicts, summary
