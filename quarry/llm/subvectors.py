"""Centroid clustering over subvector dictionaries (operator 13).

Vectors become integers and are encoded once, without loss: a chunk of rows
holds, for each block of dimensions, the distinct subvectors and a code per
row.  Blocks start as single dimensions and grow in pairs while a block's
dictionary stays well under the chunk's rows, so repeated vectors end as a few
wide entries and others as many narrow ones.  A round computes the exact
squared distances of the entries to the centroids and adds them up by code;
the new centroids come from how often each entry fell to each cluster.

A dictionary belongs to its chunk and is bounded by its rows; one for the
whole table would grow with it, and every round would shuffle a row for each
vector and block to meet it.  A round moves one row for each task, cluster
and dimension; only the centroids' totals reach the driver."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import collected, map_arrow, stable

#: Components below this keep every squared distance of 64 dimensions in 64 bits.
LARGEST = 1 << 27


class Block(NamedTuple):
    """``entries`` [m, width] distinct subvectors; ``codes`` [n] of the rows."""

    entries: np.ndarray
    codes: np.ndarray


def encode(x: np.ndarray, share: int = 4) -> list[Block]:
    """The blocks of integer rows ``x`` [n, d].  Neighbours merge while their
    common dictionary has at most one entry for ``share`` rows."""
    blocks = []
    for column in x.T:
        values, codes = np.unique(column, return_inverse=True)
        blocks.append(Block(values[:, None], codes))
    grown = True
    while grown and len(blocks) > 1:
        grown, paired = False, []
        for at in range(0, len(blocks) - 1, 2):
            a, b = blocks[at], blocks[at + 1]
            both, codes = np.unique(a.codes * len(b.entries) + b.codes, return_inverse=True)
            if len(both) * share <= len(x):
                grown = True
                i, j = np.divmod(both, len(b.entries))
                paired.append(Block(np.concatenate([a.entries[i], b.entries[j]], axis=1), codes))
            else:
                paired += [a, b]
        blocks = paired + (blocks[-1:] if len(blocks) % 2 else [])
    return blocks


def distances(blocks: list[Block], centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances [n, k]: those of the entries, added up by code."""
    total, at = np.zeros((len(blocks[0].codes), len(centroids)), np.int64), 0
    for b in blocks:
        width = b.entries.shape[1]
        gap = b.entries[:, None, :] - centroids[None, :, at:at + width]
        total += (gap * gap).sum(axis=2)[b.codes]
        at += width
    return total


def cluster_sums(blocks: list[Block], cluster: np.ndarray, k: int) -> np.ndarray:
    """Sums [k, d] of the rows of each cluster, from the entries' counts."""
    out = []
    for b in blocks:
        times = np.bincount(b.codes * k + cluster, minlength=len(b.entries) * k).reshape(-1, k)
        out.append(times.T @ b.entries)
    return np.concatenate(out, axis=1)


def _pack(ids: pa.Array, blocks: list[Block]) -> pa.RecordBatch:
    one = lambda v, t: pa.array([v], pa.list_(t))
    widths = [b.entries.shape[1] for b in blocks]
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), one(widths, pa.int32()),
         one([len(b.entries) for b in blocks], pa.int32()),
         pa.array([np.concatenate([b.entries.ravel() for b in blocks]).astype(np.int32).tobytes()], pa.binary()),
         pa.array([np.concatenate([b.codes for b in blocks]).astype(np.int32).tobytes()], pa.binary())],
        names=["ids", "widths", "sizes", "entries", "codes"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[Block]]]:
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch.column("ids")[row].values
            entries = np.frombuffer(batch.column("entries")[row].as_py(), np.int32).astype(np.int64)
            codes = np.frombuffer(batch.column("codes")[row].as_py(), np.int32).reshape(-1, len(ids))
            blocks, at = [], 0
            for width, size, code in zip(batch.column("widths")[row].as_py(), batch.column("sizes")[row].as_py(), codes):
                blocks.append(Block(entries[at:at + width * size].reshape(size, width), code))
                at += width * size
            yield ids, blocks


def _chunks(vectors: DataFrame, rows: int) -> DataFrame:
    """``vectors(vec_id, x)`` encoded, up to ``rows`` to a chunk."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed(table: pa.Table) -> pa.RecordBatch:
            ids, x = (table[c].combine_chunks() for c in ("vec_id", "x"))
            return _pack(ids, encode(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)))

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= rows:
                table = pa.Table.from_batches(held)
                yield packed(table.slice(0, rows))
                held = table.slice(rows).to_batches()
        table = pa.Table.from_batches(held) if held else None
        if table is not None and table.num_rows:
            yield packed(table)

    return map_arrow(vectors, run, f"ids array<{kind}>, widths array<int>, sizes array<int>, entries binary, codes binary")


def _round(chunks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts [k], distance totals [k] and component sums [k, d] of the
    clusters of an assignment to ``centroids``."""
    k, d = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, d + 2), np.int64)
        for _, blocks in _unpack(batches):
            dist = distances(blocks, centroids)
            cluster = dist.argmin(axis=1)
            total[:, 0] += np.bincount(cluster, minlength=k)
            np.add.at(total[:, 1], cluster, dist[np.arange(len(dist)), cluster])
            total[:, 2:] += cluster_sums(blocks, cluster, k)
        c, i = np.nonzero(total)
        yield pa.record_batch([pa.array(c.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(total[c, i])], names=["c", "i", "s"])

    c, i, s = collected(map_arrow(chunks, run, "c int, i int, s bigint").groupBy("c", "i").agg(F.sum("s").alias("s")))
    total = np.zeros((k, d + 2), np.int64)
    total[c, i] = s  # at most k x (d + 2) rows
    return total[:, 0], total[:, 1], total[:, 2:]


def cluster(vectors: DataFrame, first: Column, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024,
            chunk: int = 8192) -> DataFrame:
    """Integer k-means over ``vectors(vec_id, embedding)``.

    Takes the rows of exactly ``dims`` components, none null or non-finite;
    component x becomes floor(``scale`` * x).  The ``k`` rows with the smallest
    ``first`` (nulls last, ties by components) are centroids 0, 1, ...  Each
    round assigns every row to its nearest centroid (squared distance, ties to
    the smaller number) and sets a centroid to the floor of its rows' mean; one
    without rows stays.

    Returns, for every row taken, ``vec_id, cluster, distance,
    cluster_inertia, inertia, centroid`` (array of bigint).  Rows with a
    component of 2^27 or more after scaling have no 64-bit distances and are
    left out like non-finite ones.  Null vec_ids and repeated rows are rows
    like others.  With fewer than ``k`` rows there are as many centroids as
    rows; an empty table gives no rows."""
    if dims > 64:
        raise ValueError("squared distances of over 64 dimensions may not fit 64 bits")
    scaled = F.transform("embedding", lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("int"))
    wide = F.exists("embedding", lambda e: e.isNull() | F.isnan(e.cast("double"))
                    | (F.abs(e.cast("double")) * scale >= F.lit(float(LARGEST - 1))))
    kept = vectors.filter((F.size("embedding") == dims) & ~wide).select("vec_id", first.alias("first"), scaled.alias("x"))
    start = kept.orderBy(F.col("first").asc_nulls_last(), "x").limit(k).select("x").collect()  # k rows
    kind = kept.schema["vec_id"].dataType.simpleString()
    out_schema = f"vec_id {kind}, cluster int, distance bigint"
    if not start:
        return vectors.sparkSession.createDataFrame(
            [], f"{out_schema}, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    centroids = np.array([r["x"] for r in start], np.int64)
    chunks = stable(_chunks(kept.select("vec_id", "x"), chunk))
    for _ in range(rounds):
        n, _, sums = _round(chunks, centroids)
        some = n > 0
        centroids = centroids.copy()
        centroids[some] = sums[some] // n[some, None]
    _, inertia, _ = _round(chunks, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blocks in _unpack(batches):
            dist = distances(blocks, centroids)
            own = dist.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(own.astype(np.int32)), pa.array(dist[np.arange(len(dist)), own])], names=["vec_id", "cluster", "distance"])

    at = F.col("cluster") + 1
    return map_arrow(chunks, assign, out_schema).select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*[F.lit(int(v)).cast("bigint") for v in inertia]), at).alias("cluster_inertia"),
        F.lit(int(inertia.sum())).cast("bigint").alias("inertia"),
        F.element_at(F.array(*[F.lit(",".join(map(str, c.tolist()))) for c in centroids]), at).alias("centroid")
    ).withColumn("centroid", F.split("centroid", ",").cast("array<bigint>"))


def centroid_sha256() -> Column:
    """Digest of ``centroid``'s components as decimals joined by commas."""
    return F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256)


def _oracle(rounds: int = 10, k: int = 8, scale: int = 1024, dims: int = 64) -> str:
    """DuckDB SQL for the columns of ``op13`` over ``embeddings``: a pair of
    common tables for each round."""
    ctes = [f"""v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), flat AS (SELECT rid, unnest(range({dims})) AS i, unnest(e) AS x FROM v
), c0 AS (
  SELECT c, unnest(range({dims})) AS i, unnest(e) AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), e) - 1 AS c, e FROM v ORDER BY sha256('3:' || vec_id), e LIMIT {k}))"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, c, d FROM (
    SELECT flat.rid, c{r}.c, CAST(sum((flat.x - c{r}.x) * (flat.x - c{r}.x)) AS BIGINT) AS d
    FROM flat JOIN c{r} USING (i) GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < rounds:
            ctes.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, c{r}.i, CASE WHEN s.n IS NULL THEN c{r}.x ELSE (s.s - (((s.s % s.n) + s.n) % s.n)) // s.n END AS x
  FROM c{r} LEFT JOIN (
    SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM flat JOIN a{r} USING (rid) GROUP BY c, i) s USING (c, i))""")
    last = rounds
    return "WITH " + ", ".join(ctes) + f""", per AS (SELECT c, CAST(sum(d) AS BIGINT) AS ci FROM a{last} GROUP BY c
), sha AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{last} GROUP BY c)
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, per.ci AS cluster_inertia,
  (SELECT CAST(sum(ci) AS BIGINT) FROM per) AS inertia, sha.h AS centroid_sha256
FROM v JOIN a{last} a USING (rid) JOIN per ON per.c = a.c JOIN sha ON sha.c = a.c"""


ORACLE_SQL = _oracle()
