"""Hard negatives by exact integer scores in residue arithmetic (operator 11).

A score is the integer inner product of two vectors of integer components.
The component matrices are reduced modulo several primes below 1,024, so that
64 products of residues add up exactly in float32 and each modulus is one
float32 matrix product.  The residues of the products give the signed score
back by Chinese remaindering in balanced mixed radix; there are as many primes
as the largest possible score needs.

Anchors and rows meet in a grid of blocks, each cell a task's work of bounded
size: the anchors are a stated query set, and no block pair is met twice in a
pass.  The first pass finds each anchor's positives, the second the best
negatives within each positive's window.  Cells send on only their best few,
which Spark ranks."""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt, prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quarry.llm.common import ship, shuffle_partitions, stable

#: Components multiplied per float32 sum, and the bound of the primes:
#: 64 * 511^2 stays below 2^24, where float32 is exact.
DEPTH, PRIMES_BELOW = 64, 1024
NONE = np.iinfo(np.int64).min


def primes_for(bound: int) -> list[int]:
    """The largest primes below ``PRIMES_BELOW`` whose product exceeds
    2 * ``bound`` + 1, so scores up to ``bound`` either way are told apart."""
    chosen: list[int] = []
    for p in range(PRIMES_BELOW - 1, 2, -1):
        if all(p % q for q in range(2, isqrt(p) + 1)):
            chosen.append(p)
            if prod(chosen) > 2 * bound + 1:
                return chosen
    raise ValueError("scores too large")


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` modulo the odd ``p`` as numbers of -(p-1)/2 .. (p-1)/2."""
    half = (p - 1) // 2
    return (x + half) % p - half


class Residues:
    """An integer matrix modulo each prime, in float32."""

    def __init__(self, x: np.ndarray, primes: list[int]):
        self.parts = [balanced(x, p).astype(np.float32) for p in primes]

    def __getitem__(self, rows: slice) -> list[np.ndarray]:
        return [p[rows] for p in self.parts]


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact int64 ``A @ B.T`` from the residues of both."""
    x, radix = np.zeros((len(a[0]), len(b[0])), np.int64), 1
    for p, left, right in zip(primes, a, b):
        r = np.zeros(x.shape, np.int32)
        for at in range(0, left.shape[1], DEPTH):
            r += (left[:, at:at + DEPTH] @ right[:, at:at + DEPTH].T).astype(np.int32) % np.int32(p)
        if radix == 1:
            x += balanced(r, p)
        else:  # the next digit of the mixed radix; products wrap modulo 2^64, as only the last sum must fit
            digit = balanced((r - x % p) * pow(radix, -1, p), p)
            x += digit * np.int64(radix % (1 << 64) - (1 << 64) * (radix % (1 << 64) >> 63))
        radix *= p
    return x


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` highest entries of each row, ties to the
    smaller column; entries ``NONE`` are no entries."""
    if not scores.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        row, col = np.nonzero((scores >= least[:, None]) & (scores != NONE))
    else:
        row, col = np.nonzero(scores != NONE)
    order = np.lexsort((col, -scores[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, np.arange(len(scores)))
    keep = np.arange(len(row)) - first[row] < k
    return row[keep], col[keep]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _labels(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    codes = pa.chunked_array([a["label"].combine_chunks(), b["label"].combine_chunks()]).combine_chunks().dictionary_encode().indices
    codes = codes.to_numpy()
    return codes[:len(a)], codes[len(a):]


def _grid(rows: DataFrame, anchors: DataFrame, blocks: int, anchor_blocks: int, run: Callable, ddl: str) -> DataFrame:
    """``run(anchors, rows)`` over every cell of equal length of vectors; the
    rows of a cell come by vec_id."""
    block_of = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    keys, parts = ["dim", "row_block", "anchor_block"], shuffle_partitions(rows)
    left = anchors.withColumn("anchor_block", block_of(anchor_blocks).cast("int")).withColumn("row_block", each(blocks))
    right = rows.withColumn("row_block", block_of(blocks).cast("int")).withColumn("anchor_block", each(anchor_blocks))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (len(a) and len(b)):
            return empty
        return run(a, b.take(pc.sort_indices(b, [("vec_id", "ascending")], null_placement="at_end")))

    empty = _arrow(ddl).empty_table()
    ship(rows)
    return left.repartition(parts, *keys).groupBy(*keys).cogroup(
        right.repartition(parts, *keys).groupBy(*keys)).applyInArrow(cell, ddl)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _table(schema: pa.Schema, *columns) -> pa.Table:
    plain = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in columns]
    return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(plain, schema)], schema=schema)


def _ranked(found: DataFrame, of: list[str], by: str, most: int) -> DataFrame:
    """The first ``most`` rows of each group by score, ties by id, with their
    ``rank``."""
    w = Window.partitionBy(*of).orderBy(F.col("score").desc(), F.col(by).asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def hard_negatives(vectors: DataFrame, anchors: Column, scale: int = 256, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, cell_values: int = 1 << 21) -> DataFrame:
    """For anchors among ``vectors(vec_id, label, embedding)`` and their
    nearest rows of the same label, the nearest rows of other labels within a
    window of scores.

    Component x becomes floor(``scale`` * x); a score is the integer inner
    product with the anchor; higher scores first, ties by smaller vec_id
    (null last).  Rows for which ``anchors`` (a boolean Column) is true are
    anchors; an anchor's positives are its first ``positives`` other rows of
    the same label.  Each anchor and positive has the first ``negatives`` rows
    of other labels whose score is ``low`` to ``high`` percent of the
    positive's.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``.  Rows with a null label, a null vector or a null or
    non-finite component take no part, nor do those whose squared length is
    2^62 or more after scaling (scores beyond 64 bits).  Vectors of different
    lengths aren't compared; empty ones score 0.  Labels may be of any type.
    Repeated rows are rows of their own: each is an anchor, a positive and a
    negative.  An empty table gives no rows."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    as_double = F.transform("embedding", lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("double"))
    bad = F.exists("embedding", lambda e: e.isNull() | F.isnan(e.cast("double"))
                   | (F.abs(e.cast("double")) * scale >= F.lit(float((1 << 31) - 1))))
    v = vectors.select("vec_id", "label", "embedding", F.coalesce(anchors, F.lit(False)).alias("is_anchor")).filter(
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    v = v.withColumn("q", as_double)
    v = v.withColumn("length", F.aggregate("q", F.lit(0.0), lambda s, x: s + x * x)).filter(F.col("length") < F.lit(float(1 << 62)))
    rows = stable(v.select("vec_id", "label", "is_anchor", F.col("q").cast("array<int>").alias("q"), F.size("q").alias("dim"), "length")
                  .withColumn("rid", F.monotonically_increasing_id()))
    asked = rows.filter("is_anchor").select("rid", "vec_id", "label", "q", "dim")
    n, dim, longest, n_asked, longest_asked = rows.agg(
        F.count(F.lit(1)), F.max("dim"), F.max("length"), F.count_if("is_anchor"), F.max(F.when(F.col("is_anchor"), F.col("length")))).first()
    out_schema = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score bigint, negative_score bigint"
    if not n_asked:
        return vectors.sparkSession.createDataFrame([], out_schema)
    primes = primes_for(int(np.sqrt(longest * longest_asked) * 1.000001) + 1)
    block = max(256, cell_values // max(dim, 1))  # rows of a block: bounded values, however long the vectors
    shape = (max(-(-n // block), shuffle_partitions(rows)), -(-n_asked // block))
    rows = rows.select("rid", "vec_id", "label", "q", "dim")
    step = lambda width: max(1, (1 << 20) // max(width, 1))  # anchors at a time

    found_ddl = f"rid bigint, vec_id {kind}, score bigint"
    found = _arrow(found_ddl)

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        own, other = _labels(a, b)
        rid, other_rid = a["rid"].to_numpy(), b["rid"].to_numpy()
        left, right = Residues(_matrix(a["q"]), primes), Residues(_matrix(b["q"]), primes)
        out = []
        for lo in range(0, len(a), step(len(b))):
            part = slice(lo, min(lo + step(len(b)), len(a)))
            s = products(left[part], right[:], primes)
            s[(own[part, None] != other[None, :]) | (rid[part, None] == other_rid[None, :])] = NONE
            i, j = best(s, positives)
            out.append((i + lo, j, s[i, j]))
        i, j, s = (np.concatenate(x) for x in zip(*out))
        return _table(found, rid[i], b["vec_id"].take(pa.array(j)), s)

    first = _ranked(_grid(rows, asked, *shape, nearest, found_ddl), ["rid"], "vec_id", positives)
    first = first.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p")).select(
        "rid", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    known = stable(asked.join(first, "rid"))  # at most ``positives`` to an anchor

    mined_ddl = f"rid bigint, place int, anchor_id {kind}, positive_id {kind}, vec_id {kind}, positive_score bigint, score bigint"
    mined = _arrow(mined_ddl)

    def within(a: pa.Table, b: pa.Table) -> pa.Table:
        own, other = _labels(a, b)
        left, right = Residues(_matrix(a["q"]), primes), Residues(_matrix(b["q"]), primes)
        wanted = a["positive_score"].to_pylist()
        ceiling = [[high * p // 100 for p in w] for w in wanted]
        floor = [[-(-low * p // 100) for p in w] for w in wanted]
        out = []
        for lo in range(0, len(a), step(len(b))):
            part = range(lo, min(lo + step(len(b)), len(a)))
            s = products(left[slice(part.start, part.stop)], right[:], primes)
            s[own[part.start:part.stop, None] == other[None, :]] = NONE
            for place in range(positives):
                have = np.array([i for i in part if place < len(wanted[i])], np.int64)
                if len(have):
                    top = np.array([ceiling[i][place] for i in have], np.int64)[:, None]
                    least = np.array([floor[i][place] for i in have], np.int64)[:, None]
                    some = s[have - lo]
                    some[(some > top) | (some < least)] = NONE
                    i, j = best(some, negatives)
                    out.append((have[i], np.full(len(i), place), j, some[i, j]))
        i, place, j, s = (np.concatenate(x) for x in zip(*out))
        at = pa.array(a["positive_id"].combine_chunks().offsets.to_numpy()[i] + place)  # the place-th of an anchor's positives
        picked = [a[c].combine_chunks().values.take(at) for c in ("positive_id", "positive_score")]
        return _table(mined, a["rid"].to_numpy()[i], place, a["vec_id"].take(pa.array(i)), picked[0],
                      b["vec_id"].take(pa.array(j)), picked[1], s)

    last = _ranked(_grid(rows, known, *shape, within, mined_ddl), ["rid", "place"], "vec_id", negatives)
    return last.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                       "positive_score", F.col("score").alias("negative_score"))


#: DuckDB SQL for the columns of ``op11`` over ``embeddings``.
ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.rid <> b.rid AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s WHERE same
  QUALIFY place <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.arid, p.place ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM p JOIN s ON p.arid = s.arid AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
  QUALIFY rank <= 10
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n
"""
