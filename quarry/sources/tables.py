"""Parquet scans of the driver tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet``: Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(table_path(sf_dir, name))


def parallelism(spark: SparkSession) -> int:
    """Cores available to the application (default parallelism), or the
    shuffle-partition setting when the session exposes no SparkContext."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions", "8"))


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt round-robin over the application's cores: for callers that
    know their input is a few files of one row group each, too coarse for
    CPU-heavy per-row work.  Operators never call it."""
    return df.repartition(parallelism(df.sparkSession))
