"""Mixing sources to target weights by systematic sampling (operator 3).

Sizes are word counts.  Source targets follow from per-source totals (a row
per source).  Inside a source the documents stand in order of size; each
expects target / source_size copies, the prefix sums of these get one random
offset, and a document is emitted once per integer boundary its interval
crosses.  Ordering by size keeps the taken words within about one document's
size of the target.  Prefix sums never run through one task: positions come
from a distributed sort plus the counts per (partition, source)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, ordered


def word_count(text="text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``sizes(source, size)`` -> ``(source, source_size, target)``.

    Sources by code point, null last, take ``weights`` in turn; they share
    ``budget`` x all sizes by weight, none above ``most`` x its own size, the
    excess going to the others by weight until none is above (water filling:
    in order of cap / weight the first source that stays under its cap fixes
    the level).  The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                           ((nth - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("rn", F.row_number().over(by_ratio)).withColumn(
        "level",
        (F.sum("source_size").over(everything) * F.lit(float(budget))
         - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    open_level = F.when(F.col("level") * F.col("w") < F.col("cap"), F.struct("rn", "level"))
    per = per.withColumn("first_open", F.min(open_level).over(everything))
    target = F.when(F.col("first_open").isNull() | (F.col("rn") < F.col("first_open.rn")), F.col("cap")).otherwise(
        F.col("first_open.level") * F.col("w"))
    return per.select("source", "source_size", target.alias("target"))


def random_offset(source, seed: int):
    """A fixed 20-bit fraction per (seed, source)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 5), 16, 10).cast("bigint") / F.lit(1048576.0)


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.5, most: float = 2.0,
        seed: int = 7) -> DataFrame:
    """Copies per row of ``docs(doc_id, text, source)``.

    Returns a row per input row: ``doc_id``, ``text_hash``, ``source``,
    ``size``, ``source_size``, ``target``, ``copies`` (0 to ``most``),
    ``taken`` = copies x size.  A null text has size 0; a null source is a
    source of its own; repeated rows stand next to each other in the order and
    are sampled like any others; reruns agree; an empty table gives no rows.
    A source without words has target 0 and takes nothing.
    """
    narrow = docs.select("doc_id", "source", word_count().alias("size"),
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    rows = ordered(narrow, [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id").asc_nulls_last(),
                            F.col("text_hash")])
    targets = source_targets(rows.select("source", "size"), weights, budget, most)
    blocks = rows.groupBy("_part", "source").agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first"))
    blocks = blocks.withColumn("before", F.sum("n").over(
        Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    blocks = blocks.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("_part").alias("_b"), F.col("source").alias("_bs"), "first", "before", "source_size", "target")
    out = rows.join(blocks, (rows["_part"] == blocks["_b"]) & rows["source"].eqNullSafe(blocks["_bs"]))
    k = F.col("before") + F.col("_pos") - F.col("first")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    out = out.withColumn("_k", k).withColumn("_r", rate).withColumn("_u", random_offset(F.col("source"), seed))
    crossed = F.floor((F.col("_k") + 1) * F.col("_r") + F.col("_u")) - F.floor(F.col("_k") * F.col("_r") + F.col("_u"))
    copies = F.least(crossed, F.lit(int(most))).cast("bigint")
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, **how) -> DataFrame:
    """``docs`` (all its columns) as the mix takes them: rows taken twice
    appear twice, rows not taken go.  Rows equal in doc_id, text and source
    count as one document here that appears as often as all of them are taken.
    """
    cols = docs.columns
    copies = mix(docs, **how).groupBy("doc_id", "text_hash", "source").agg(F.sum("copies").alias("_copies"))
    copies = copies.filter("_copies > 0").select(
        F.col("doc_id").alias("_mix_id"), F.col("text_hash").alias("_mix_h"), F.col("source").alias("_mix_s"), "_copies")
    hashed = docs.withColumn("_mix_hash", F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    one = hashed.dropDuplicates(["doc_id", "_mix_hash", "source"])
    out = one.join(copies, one["doc_id"].eqNullSafe(copies["_mix_id"]) & (one["_mix_hash"] == copies["_mix_h"])
                   & one["source"].eqNullSafe(copies["_mix_s"]))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))).select(*cols)


#: DuckDB SQL for the columns of ``op3`` over ``documents``.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(text, '') AS text
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
         source_size * 2.0::DOUBLE AS cap
  FROM s
), r AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS rn,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w
), o AS (SELECT min(rn) AS rn, min_by(level, rn) AS level FROM r WHERE level * w < cap
), t AS (
  SELECT r.source, r.source_size, CASE WHEN o.rn IS NULL OR r.rn < o.rn THEN cap ELSE o.level * w END AS target
  FROM r, o
), k AS (
  SELECT d.*, t.source_size, t.target,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS LAST) - 1 AS k,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('7:' || coalesce('s' || d.source, 'null')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       least(floor((k + 1) * rate + u) - floor(k * rate + u), 2)::BIGINT * size AS taken
FROM k
"""
