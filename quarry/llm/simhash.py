"""SimHash near-duplicates with BK-trees (operator 6).

Fingerprints within two bits of each other agree on at least six of their
eight bytes.  Every distinct fingerprint therefore goes to 28 shards, one for
each pair of bytes left out, keyed by the other six; each linked pair meets in
a shard.  A shard differs in 16 bits only, so it holds at most 65,536 distinct
fingerprints however large the corpus.  Its task puts them in a BK-tree
(children keyed by their integer Hamming distance to the parent) and follows
only edges within the radius.  The trees are not broadcast: all of them
together grow with the corpus, so fingerprints travel to their shard instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import frame, map_arrow, runs, shuffle_partitions, slices, stable, texts_of
from quarry.llm.components import connected_components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of lower-cased (A-Z) word shingles, repeats included; a
    text of fewer words is one shingle, one without words gives 0."""
    data = (text or "").encode() if not isinstance(text, bytes) else text
    words = data.translate(LOWER).split()
    if not words:
        return 0
    norm = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    first = [0, *(ends[:-1] + 1).tolist()][: len(words) - k + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(norm[a:b], seed) for a, b in zip(first, ends[k - 1:].tolist())), np.uint64, len(first))
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 4096):  # a very long text needs no large bit matrix
        bits = np.unpackbits(hashes[lo:lo + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, text_hash, fp)``, a row per row.
    A null text counts as empty."""
    src = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(2))
            out = np.empty(len(texts), np.uint64)
            for lo, hi in slices(texts):
                out[lo:hi] = [fingerprint(t, shingle) for t in texts.slice(lo, hi - lo).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out.view(np.int64))],
                                  names=["doc_id", "text_hash", "fp"])

    return map_arrow(src, run, f"doc_id {kind}, text_hash bigint, fp bigint")


class BKTree:
    """Distinct 64-bit values; children of a node keyed by distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Indices of the values within ``radius`` bits."""
        found, todo = [], [0] if self.values else []
        while todo:
            i = todo.pop()
            d = (self.values[i] ^ value).bit_count()
            if d <= radius:
                found.append(i)
            todo.extend(j for e, j in self.children[i].items() if d - radius <= e <= d + radius)
        return found

    def add(self, value: int) -> int:
        """Insert a value that is not in the tree yet; its index."""
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        i = 0
        while new:
            d = (self.values[i] ^ value).bit_count()
            j = self.children[i].setdefault(d, new)
            if j == new:
                break
            i = j
        return new


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join what a BK-tree search joins among ``values``: one per
    value that is not the first of its local group, not all pairs."""
    tree, parent = BKTree(), []

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for v in values:
        hits = tree.near(v, radius)
        i = tree.add(v)
        parent.append(i)
        for j in hits:
            a, b = top(i), top(j)
            parent[max(a, b)] = min(a, b)
    return [(tree.values[i], tree.values[top(i)]) for i in range(len(parent)) if top(i) != i]


def fingerprint_links(fps: DataFrame, radius: int = 2, spare: int = 2) -> DataFrame:
    """Links ``(a, b)`` between distinct ``fps(fp)`` whose closure equals that
    of all pairs within ``radius`` bits (``radius`` <= ``spare`` bytes)."""
    if radius > spare:
        raise ValueError("radius must not exceed the number of bytes left out")
    masks = []
    for left_out in combinations(range(8), spare):
        m = (1 << 64) - 1
        for b in left_out:
            m &= ~(0xFF << (8 * b))
        masks.append(m - (1 << 64) if m >> 63 else m)
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])
    sharded = fps.select("fp", F.posexplode(keys).alias("left_out", "shard"))
    sharded = sharded.repartition(shuffle_partitions(fps), "left_out", "shard").sortWithinPartitions("left_out", "shard")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in runs(batches, ["left_out", "shard"]):
            values = np.unique(group["fp"].to_numpy()).view(np.uint64).tolist()
            found += shard_links(values, radius)
            if len(found) >= 50_000:
                yield frame(schema, np.array(found, np.uint64).view(np.int64).T)
                found = []
        if found:
            yield frame(schema, np.array(found, np.uint64).view(np.int64).T)

    return map_arrow(sharded, run, "a bigint, b bigint").distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """Near-duplicate groups of ``docs(doc_id, text)``.

    Returns a row per input row: ``doc_id``, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest doc_id reachable over links of at most
    ``radius`` bits; null where a group has null ids only), ``text_hash`` and
    ``kept`` (true for the rows of the one document that stays: the smallest
    (doc_id, text_hash) of the group, null ids last; rows that repeat it are
    all marked).  Null and empty texts have fingerprint zero and link like any
    other.  An empty table gives no rows.
    """
    rows = stable(fingerprints(docs, shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash"))
    per_fp = stable(rows.groupBy("fp").agg(first.alias("first")))
    roots = connected_components(fingerprint_links(per_fp.select("fp"), radius))
    grouped = per_fp.join(roots, per_fp["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    heads = grouped.groupBy("root").agg(F.min("first").alias("head"))
    by_fp = grouped.select("fp", "root").join(heads, "root").select("fp", "head")
    out = rows.join(by_fp, "fp")
    return out.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head.doc_id").alias("component_id"),
        "text_hash",
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_hash") == F.col("head.text_hash"))).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` (all its columns) without the near-duplicates: exactly one row
    of each group stays."""
    kept = simhash_groups(docs, shingle, radius).filter("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash")).distinct()
    cols = docs.columns
    hashed = docs.withColumn("_kept_hash", F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    out = hashed.join(kept, hashed["doc_id"].eqNullSafe(kept["_kept_id"]) & (hashed["_kept_hash"] == kept["_kept_hash"]),
                      "left_semi")
    return out.dropDuplicates(["doc_id", "_kept_hash"]).select(*cols)
