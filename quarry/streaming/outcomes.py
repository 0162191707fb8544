"""Micro-batch asset-state resolution (optional U6 over a stream).

Fetch attempts land as files (the audit log, S9).  A Structured Streaming
query reads them incrementally and, per micro-batch, applies the same batch
function :func:`quarry.operators.merge.apply_outcomes` to the current
registry, writing the next registry version.  ``trigger(availableNow=True)``
processes what is there and stops; the checkpoint makes replays exactly-once
per batch (a retried batch rewrites the same version directory).  The
initial registry is version ``v=0``; batch ``e`` writes ``v=e+1``.

Semantics follow the batch job: only ``discovered`` rows advance, so the
first batch holding an attempt for a URL decides it; later attempts for an
already advanced URL are ignored, as the reference never retries.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.merge import apply_outcomes

ATTEMPT_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("local_path", T.StringType()),
    T.StructField("attempted_at", T.TimestampType()),
])


def latest_version(spark: SparkSession, registry_root: str, below: int | None = None) -> str | None:
    """Path of the newest registry version ``v=<n>`` (``n <= below`` if given).

    Versions are directories ``v=<n>`` under ``registry_root``; reading the
    root discovers ``v`` as a partition column, so the newest version is a
    one-value aggregate (uncommitted ``_temporary`` output is ignored).
    """
    try:
        versions = spark.read.parquet(registry_root).select("v")
    except AnalysisException:
        return None
    if below is not None:
        versions = versions.filter(F.col("v") <= below)
    v = versions.agg(F.max("v")).first()[0]
    return None if v is None else f"{registry_root.rstrip('/')}/v={v}"


def start_outcome_stream(spark: SparkSession, attempts_dir: str, registry_root: str,
                         checkpoint_dir: str, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``."""
    attempts = spark.readStream.schema(ATTEMPT_SCHEMA).parquet(attempts_dir)

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        # base = newest version written before this batch; a replayed batch
        # rebuilds its own version from the same base (never reads its output)
        current = latest_version(spark, registry_root, below=epoch_id)
        if current is None:
            raise FileNotFoundError(f"no registry version under {registry_root}")
        registry = spark.read.parquet(current)
        nxt = f"{registry_root.rstrip('/')}/v={epoch_id + 1}"
        apply_outcomes(registry, batch).write.mode("overwrite").parquet(nxt)

    writer = (attempts.writeStream.foreachBatch(apply_batch)
              .option("checkpointLocation", os.path.join(checkpoint_dir, "outcomes")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
