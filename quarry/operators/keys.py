"""Surrogate keys and column defaults."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def with_surrogate_id(df: DataFrame, order: Sequence[Column | str], out_col: str = "id") -> DataFrame:
    """P16 (SERIAL): 1-based dense ids in ``order`` without a global
    single-partition window.

    The rows are range-partitioned and sorted by ``order``, tagged with their
    partition and position, and checkpointed once, so every later use sees the
    same tags.  A per-partition count - one row per partition - gives each
    partition's offset.  ``order`` should be unique (add the key) for
    repeatable ids.
    """
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ensure_checkpoint_dir(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(parts, *cols).sortWithinPartitions(*cols)
              .withColumn("_part", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    offsets = counts.select(F.col("_part"), "_first", (F.sum("_n").over(before) - F.col("_n")).alias("_off"))
    joined = tagged.join(offsets, "_part")
    return joined.withColumn(out_col, (F.col("_off") + F.col("_mono") - F.col("_first") + 1).cast("bigint")).select(
        *df.columns, out_col)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill NULL (or absent) columns with DDL defaults, values or
    Columns; ``"now"`` means the run timestamp (pass a fixed one for
    repeatable output, X14)."""
    out = df
    for c, v in defaults.items():
        if isinstance(v, Column):
            val = v
        elif isinstance(v, _dt.datetime):
            val = F.lit(v).cast("timestamp")
        else:
            val = F.current_timestamp() if v == "now" else F.lit(v)
        out = out.withColumn(c, F.coalesce(F.col(c), val) if c in df.columns else val)
    return out
