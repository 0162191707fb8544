"""Connected components of an edge table by alternating large and small stars.

Each round is two grouped minima and two joins; the edges shrink to one star
per component in a logarithmic number of rounds.  Nothing is collected but a
row of totals per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stable


def _totals(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.max("u")).first()
    return tuple(row)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of bigint nodes -> ``(node, root)`` for every node of an
    edge, ``root`` being the smallest node of its component.  Loops and
    repeated edges are harmless; null ends are dropped; no edges give no rows.
    """
    e = stable(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _totals(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stable(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        after = _totals(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
