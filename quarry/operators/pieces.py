"""Ordered families in bounded pieces (A4, J4): a family is all rows of a key.

Rows are range-partitioned and sorted by key and order once, so a large family
spreads over several partitions.  Bytes before a row in its family are those
before it in its partition plus those of the family in earlier partitions, a
table of one row per partition and key it holds.  The running bytes cut the
family into pieces numbered from 0; pieces in order, concatenated, are the
family.  No task holds more than a piece."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def _ascending(order_cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order_cols]


def with_pieces(df: DataFrame, key: str, order_cols: Sequence[str], size: Column, limit: int) -> DataFrame:
    """``df`` with ``piece`` (bigint) and ``place`` (bigint, ascending in the
    order within a piece).  A row goes to the piece in whose ``limit`` bytes it
    begins, so a piece has under ``limit`` bytes and its last row.  Rows with a
    null key are a family; ties of the order are broken once and for all."""
    ensure_checkpoint_dir(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(key).asc_nulls_last(), *_ascending(order_cols)]
    # ranges cut within a family too, also where its order has ties
    tagged = df.withColumn("_size", size.cast("bigint")).withColumn("_tie", F.xxhash64(*df.columns))
    sorted_ = (tagged.repartitionByRange(parts, *by, "_tie").sortWithinPartitions(*by, "_tie")
               .withColumn("_part", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id())
               .checkpoint(eager=True))
    here = Window.partitionBy("_part", key).orderBy("_mono").rowsBetween(Window.unboundedPreceding, 0)
    local = sorted_.withColumn("_before", F.sum("_size").over(here) - F.col("_size"))
    totals = sorted_.groupBy("_part", key).agg(F.sum("_size").alias("_total"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    offsets = totals.select(F.col("_part").alias("_p"), F.col(key).alias("_k"),
                            (F.sum("_total").over(earlier) - F.col("_total")).alias("_offset"))
    joined = local.join(offsets, (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k")))
    piece = F.floor((F.col("_before") + F.col("_offset")) / F.lit(limit)).cast("bigint")
    return joined.select(*df.columns, piece.alias("piece"), F.col("_mono").alias("place"))


def text_pieces(children: DataFrame, key: str, order_cols: Sequence[str], text_col: str, sep: str = "\n",
                limit: int = 64 << 20) -> DataFrame:
    """A4 in pieces: ``(key, piece, text, n_parts)``.  The texts of a key's
    pieces, concatenated in order, are its ``string_agg(text, sep ORDER BY
    order_cols)``: every piece but the first begins with ``sep``.  NULL texts
    count as parts and add nothing, as in :func:`ordered_text_agg`."""
    rows = children.select(key, *order_cols, F.col(text_col).alias("_text"))
    width = len(sep.encode())
    cut = with_pieces(rows, key, order_cols, F.coalesce(F.octet_length("_text") + width, F.lit(0)), limit)
    entry = F.when(F.col("_text").isNotNull(), F.struct("place", F.col("_text").alias("t")))
    joined = cut.groupBy(key, "piece").agg(F.sort_array(F.collect_list(entry)).alias("_es"), F.count(F.lit(1)).alias("n_parts"))
    body = F.array_join(F.transform("_es", lambda e: e["t"]), sep)
    # the separator stands before a piece's text if any text of the key is before it
    earlier = Window.partitionBy(key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    narrow = joined.select(key, "piece", (F.size("_es") > 0).alias("_some"))
    flags = narrow.select(F.col(key).alias("_k"), F.col("piece").alias("_p"),
                          (F.col("_some") & F.coalesce(F.max("_some").over(earlier), F.lit(False))).alias("_follows"))
    met = joined.join(flags, F.col(key).eqNullSafe(F.col("_k")) & (F.col("piece") == F.col("_p")))
    return met.select(key, "piece", F.when(F.col("_follows"), F.concat(F.lit(sep), body)).otherwise(body).alias("text"), "n_parts")


def children_pieces(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, order_cols: Sequence[str],
                    child_cols: Sequence[str], limit: int = 64 << 20, out_col: str = "children") -> DataFrame:
    """J4 + T4 in pieces: each parent with numbered, bounded arrays of its
    children in order; a parent without children has piece 0 with an empty
    array; children without a parent are dropped."""
    columns = list(dict.fromkeys([*order_cols, *child_cols]))
    rows = children.select(F.col(child_key).alias("_pk"), *[F.col(c).alias(f"_c_{c}") for c in columns])
    size = F.octet_length(F.to_json(F.struct(*[f"_c_{c}" for c in child_cols])))
    cut = with_pieces(rows, "_pk", [f"_c_{c}" for c in order_cols], size, limit)
    child = F.struct(*[F.col(f"_c_{c}").alias(c) for c in child_cols])
    grouped = cut.filter("_pk IS NOT NULL").groupBy("_pk", "piece").agg(
        F.sort_array(F.collect_list(F.struct("place", child.alias("_child")))).alias("_kids"))
    kind = children.select(F.struct(*child_cols)).schema[0].dataType.simpleString()
    joined = parents.join(grouped, parents[parent_key] == grouped["_pk"], "left")
    return joined.withColumn("piece", F.coalesce("piece", F.lit(0).cast("bigint"))).withColumn(
        out_col, F.coalesce(F.transform("_kids", lambda e: e["_child"]), F.array().cast(f"array<{kind}>"))).drop("_pk", "_kids")
