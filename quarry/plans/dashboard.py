"""Dashboard statistics (U11): row counts, two status histograms with their
display classes, and the latest ingest run - each one small aggregate job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.merge import latest_row
from quarry.operators.stats import display_class, status_counts, table_counts
from quarry.plans.ingest import run_log

# The tables the dashboard counts, in display order.
DASHBOARD_TABLES = (
    "emails", "email_recipients", "documents", "document_fulltext", "photos", "people",
    "photo_faces", "imessage_conversations", "imessage_messages", "star_counts",
    "release_batches", "mirrored_files", "asset_registry",
)


@dataclass
class Dashboard:
    row_counts: DataFrame
    mirror_status: DataFrame
    asset_status: DataFrame
    last_ingest: DataFrame


def dashboard(spark: SparkSession, root: str) -> Dashboard:
    paths = {t: f"{root.rstrip('/')}/{t}" for t in DASHBOARD_TABLES}
    counts = table_counts(spark, paths)

    def hist(name: str, ok, warning, otherwise) -> DataFrame:
        try:
            df = spark.read.parquet(paths[name])
        except Exception:  # noqa: BLE001 - absent table: empty histogram
            return spark.createDataFrame([], "status string, count bigint, display_class string")
        return status_counts(df).withColumn("display_class",
                                            display_class(F.col("status"), ok, warning, otherwise))

    try:
        runs = latest_row(run_log(spark, f"{root.rstrip('/')}/ingest_runs"), "started_at")
    except Exception:  # noqa: BLE001
        runs = spark.createDataFrame([], "started_at timestamp, status string")
    return Dashboard(
        row_counts=counts,
        mirror_status=hist("mirrored_files", ["downloaded", "verified"], [], "warning"),
        asset_status=hist("asset_registry", ["downloaded"], ["discovered"], "error"),
        last_ingest=runs,
    )
