"""Embedding near-duplicates by spherical-cap filters (operator 8).

Filter directions are product codes: a seeded random rotation cuts a vector
into blocks, each block has a small codebook of random directions, and a
filter is one code word per block.  A vector is list-decoded to every filter
whose direction it exceeds by the cap height (pairs of blocks that cannot
reach it with the best third block are pruned).  Vectors that share a filter
and a label are compared exactly.  Code size and cap height follow from the
number of vectors so that each vector passes about ``hits`` filters and a
filter holds a bounded share at any size; filters that are fuller all the same
are cut into chunks, and every pair of chunks is compared in a task of its
own, so nothing is capped.  Equal vectors of a label are collapsed to one
before and counted with their number.

One code loses more pairs the larger it is.  Therefore several codes of
independent rotations are used, as many as bring the share of lost pairs at
the threshold below ``miss``: a random rotation makes any pair a random pair of
its cosine, so the loss of a code is measured on random pairs beforehand and
holds whatever the data."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import frame, map_arrow, runs, shuffle_partitions, stable
from quarry.llm.components import connected_components

BLOCKS = 3

#: Cosines of unit vectors rounded to single precision are off by less.
MARGIN = 2.5e-7


class CapCode:
    """Random product code over ``dim`` dimensions."""

    def __init__(self, dim: int, words: int, height: float, least: int, seed: int = 11, number: int = 0):
        rng = np.random.default_rng([seed, dim, words, number])
        self.blocks = min(BLOCKS, dim)
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = np.array_split(np.arange(dim), self.blocks)
        self.books = []
        for c in self.cuts:
            b = rng.standard_normal((words, len(c)))
            self.books.append(b / np.linalg.norm(b, axis=1, keepdims=True) / np.sqrt(self.blocks))
        self.words, self.height, self.least = words, height / np.sqrt(dim), least

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter a unit vector exceeds, and of its
        ``least`` highest filters in any case."""
        x = unit @ self.rotation
        scores = [x[:, c] @ b.T for c, b in zip(self.cuts, self.books)]
        n, w = len(unit), self.words
        sums, ids = scores[0], np.arange(w)
        for s in scores[1:-1]:
            sums = (sums[:, :, None] + s[:, None, :]).reshape(n, -1)
        if self.blocks == 1:
            return self._highest(sums, np.zeros((n, 1)))
        last = scores[-1]
        rows, ids = np.nonzero(sums >= self.height - last.max(axis=1)[:, None])  # the others can't reach the cap
        total = sums[rows, ids][:, None] + last[rows]
        hit, k = np.nonzero(total >= self.height)
        r1, f1 = self._highest(sums, last)
        row, code = np.r_[rows[hit], r1], np.r_[ids[hit] * w + k, f1]
        both = np.unique(row.astype(np.int64) * w ** self.blocks + code)
        return both // w ** self.blocks, both % w ** self.blocks

    def _highest(self, sums: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = min(self.least, sums.shape[1])  # the highest filters use the highest partial sums
        top = np.argpartition(-sums, k - 1, axis=1)[:, :k]
        total = np.take_along_axis(sums, top, 1)[:, :, None] + last[:, None, :]
        flat = total.reshape(len(sums), -1)
        m = min(self.least, flat.shape[1])
        best = np.argpartition(-flat, m - 1, axis=1)[:, :m]
        code = np.take_along_axis(top, best // last.shape[1], 1) * last.shape[1] + best % last.shape[1]
        return np.repeat(np.arange(len(sums)), m), code.ravel()


def code_size(n: int, hits: int = 20, bucket: int = 200) -> tuple[int, float]:
    """Words per block and cap height (in standard deviations) so that ``n``
    vectors pass about ``hits`` filters each, ``bucket`` vectors a filter."""
    words = max(8, round((n * hits / bucket) ** (1 / BLOCKS)))
    return words, -NormalDist().inv_cdf(hits / words ** BLOCKS)


def lost_share(dim: int, words: int, height: float, least: int, threshold: float, seed: int = 11,
               pairs: int = 2000) -> float:
    """Upper estimate of the share of pairs of cosine ``threshold`` without a
    common filter in one code, from random pairs."""
    rng = np.random.default_rng([seed, dim, words, pairs])
    code = CapCode(dim, words, height, least, seed, 1 << 20)  # none of those that are used
    size, lost, step = words ** code.blocks, 0, min(pairs, max(1, (1 << 21) // words ** 2))
    for lo in range(0, pairs, step):
        n = min(step, pairs - lo)
        a, b = rng.standard_normal((2, n, dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(axis=1, keepdims=True) * a
        norm = np.linalg.norm(b, axis=1, keepdims=True)
        b = threshold * a + np.sqrt(max(1 - threshold * threshold, 0.0)) * b / np.where(norm > 0, norm, 1)
        row, at = code.decode(np.concatenate([a, b / np.linalg.norm(b, axis=1, keepdims=True)]))
        common = np.intersect1d((row * size + at)[row < n], ((row - n) * size + at)[row >= n], assume_unique=True)
        lost += n - len(np.unique(common // size))
    return min((lost + 3 + 2 * lost ** 0.5) / pairs, 0.9)  # about two standard deviations up


def code_count(dims: list[int], words: int, height: float, least: int, threshold: float, miss: float, seed: int = 11) -> int:
    """Independent codes so that pairs at the threshold are lost with at most
    ``miss``."""
    worst = max((lost_share(d, words, height, least, threshold, seed) for d in dims), default=0.5)
    return max(1, ceil(log(miss) / log(worst)))


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; by the largest component first, so that no square
    over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def vector_links(reps: DataFrame, threshold: float = 0.98, hits: int = 20, least: int = 6, chunk: int = 1024,
                 seed: int = 11, miss: float = 1e-6) -> DataFrame:
    """``reps(rid, label, dim, vec, mult)`` of distinct valid vectors ->
    distinct links ``(a, b, mult_a, mult_b)`` with a < b, equal label and
    cosine (double precision) >= ``threshold``; a pair at the threshold is
    lost with probability ``miss`` at most, at any number of vectors."""
    sizes = {r["dim"]: r["n"] for r in reps.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    words, height = code_size(sum(sizes.values()), hits)
    used = {dim: code_count([dim], words, height, least, threshold, miss, seed) for dim, n in sizes.items() if n > 1}
    kind = reps.schema["label"].dataType.simpleString()
    filtered_schema = f"rid bigint, label {kind}, dim int, filter bigint, mult bigint, vec array<float>"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[tuple[int, int], CapCode] = {}
        for batch in batches:
            t = pa.Table.from_batches([batch])
            dims = t["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                part = t.take(pa.array(np.flatnonzero(dims == dim)))
                step = max(1, (1 << 22) // words ** 2)
                for lo in range(0, part.num_rows, step):
                    some = part.slice(lo, step)
                    x = unit(_vectors(some["vec"]))
                    coarse = pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.float32).ravel()), dim).cast(pa.list_(pa.float32()))
                    for number in range(used.get(dim, 0)):  # a vector alone in its dimension links with nothing
                        if (dim, number) not in codes:
                            codes[dim, number] = CapCode(dim, words, height, least, seed, number)
                        row, code_id = codes[dim, number].decode(x)
                        code_id = code_id.astype(np.int64) + number * words ** BLOCKS
                        for at in range(0, len(row), 20_000):
                            r = pa.array(row[at:at + 20_000])
                            yield pa.RecordBatch.from_arrays(
                                [some["rid"].take(r).combine_chunks(), some["label"].take(r).combine_chunks(),
                                 some["dim"].take(r).combine_chunks(), pa.array(code_id[at:at + 20_000]),
                                 some["mult"].take(r).combine_chunks(),
                                 coarse.take(r)],
                                names=["rid", "label", "dim", "filter", "mult", "vec"])

    rows = map_arrow(reps.select("rid", "label", "dim", "mult", F.col("vec").cast("array<double>").alias("vec")),
                     decode, filtered_schema)
    bucket = ["label", "dim", "filter"]
    full = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        *bucket, F.ceil(F.col("n") / F.lit(chunk)).cast("int").alias("chunks"))
    rows = rows.join(full, bucket).withColumn("c", F.pmod(F.xxhash64("rid"), F.col("chunks")).cast("int"))
    # chunk c meets every chunk: (c, j) and (j, c); a filter of one chunk gives (0, 0)
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1),
                        lambda j: F.struct(F.least("c", j).alias("ci"), F.greatest("c", j).alias("cj")))
    rows = rows.withColumn("pair", F.explode(pairs)).select(
        "rid", *bucket, "mult", "vec", "c", F.col("pair.ci").alias("ci"), F.col("pair.cj").alias("cj"))
    keys = [*bucket, "ci", "cj"]
    rows = rows.repartition(shuffle_partitions(reps), *keys).sortWithinPartitions(*keys)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("mult_a", pa.int64()), ("mult_b", pa.int64()), ("sure", pa.bool_())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, keys):
            x = _vectors(group["vec"])
            rid, mult, c = group["rid"].to_numpy(), group["mult"].to_numpy(), group["c"].to_numpy()
            for lo in range(0, len(x), 512):
                cosine = x[lo:lo + 512] @ x.T
                i, j = np.nonzero(cosine >= threshold - MARGIN)
                sure = cosine[i, j] >= threshold + MARGIN
                i += lo
                a, b = rid[i], rid[j]
                keep = a < b
                if group["ci"][0].as_py() != group["cj"][0].as_py():
                    keep &= c[i] != c[j]  # pairs within a chunk have a task of their own
                if keep.any():
                    yield frame(schema, [a[keep], b[keep], mult[i[keep]], mult[j[keep]], sure[keep]])

    # a pair's single-precision vectors, and so its cosine here, are the same in every filter
    found = map_arrow(rows, verify, "a bigint, b bigint, mult_a bigint, mult_b bigint, sure boolean").distinct()
    return found.filter("sure").drop("sure").unionByName(exact_links(found.filter("NOT sure").drop("sure"), reps, threshold))


def exact_links(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``pairs(a, b, ..)`` whose cosine in double precision is at
    least ``threshold``: for pairs too near to it for single precision."""
    vectors = reps.select("rid", F.col("vec").cast("array<double>").alias("vec"))
    met = pairs.join(vectors.select(F.col("rid").alias("a"), F.col("vec").alias("va")), "a").join(
        vectors.select(F.col("rid").alias("b"), F.col("vec").alias("vb")), "b")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bool((unit(np.array([x.as_py()], float)) * unit(np.array([y.as_py()], float))).sum() >= threshold)
                    for x, y in zip(batch.column("va"), batch.column("vb"))]
            yield batch.select(pairs_columns).filter(pa.array(keep, pa.bool_()))

    pairs_columns = pairs.columns
    return map_arrow(met.select(*pairs_columns, "va", "vb"), run, fields)


def near_vectors(vectors: DataFrame, threshold: float = 0.98, **how) -> DataFrame:
    """Near-duplicate links of ``vectors(vec_id, embedding, label)``.

    Returns a row per input row: ``vec_id``, ``n_links`` (other rows with the
    same label and cosine >= ``threshold``), ``component_id`` (smallest vec_id
    reachable), ``kept`` (vec_id = component_id; false for a null vec_id).
    Rows whose label or embedding is null, or whose embedding is empty, zero
    or holds a null or non-finite component, link with nothing.  Vectors of
    different lengths never link.  Labels may be of any type; components count
    in double precision.  Repeated rows link with each other.  An empty table
    gives no rows.
    """
    v = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    valid = (F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & ~bad
             & F.exists("vec", lambda e: e != 0))
    v = v.withColumn("valid", F.coalesce(valid, F.lit(False)))
    # two 64-bit hashes stand for (label, vector) when rows find their class again
    v = v.withColumn("h1", F.xxhash64("label", "vec")).withColumn("h2", F.xxhash64(F.lit(1), "vec", "label"))
    good = v.filter("valid")
    reps = good.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("mult"), F.first("label").alias("label"),
        F.first("vec").alias("vec"))
    reps = stable(reps.withColumn("rid", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")))
    links = stable(vector_links(reps, threshold, **how))
    degree = links.select(F.col("a").alias("rid"), F.col("mult_b").alias("m")).unionAll(
        links.select(F.col("b").alias("rid"), F.col("mult_a").alias("m"))).groupBy("rid").agg(F.sum("m").alias("others"))
    roots = connected_components(links.select("a", "b")).withColumnRenamed("node", "rid")
    known = reps.select("rid", "h1", "h2", "low", "mult").join(roots, "rid", "left").join(degree, "rid", "left")
    known = known.withColumn("root", F.coalesce("root", "rid"))
    lows = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = known.join(lows, "root").select(
        "h1", "h2", "component_id", (F.coalesce("others", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    linked = good.select("vec_id", "h1", "h2").join(known, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = v.filter(~F.col("valid")).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select("vec_id", F.col("n_links").cast("bigint").alias("n_links"), "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


#: DuckDB SQL for the columns of ``op8`` over ``embeddings``: all pairs of a
#: label (meant for small tables).
ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
         label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS valid
  FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.valid AND b.valid AND len(a.e) = len(b.e)
    AND CASE WHEN a.valid AND b.valid AND len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.98 ELSE false END
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM v
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a
), low AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node
), deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(deg.n, 0)::BIGINT AS n_links, low.component_id, v.vec_id = low.component_id AS kept
FROM v JOIN low ON low.node = v.vec_id LEFT JOIN deg ON deg.a = v.vec_id
"""
