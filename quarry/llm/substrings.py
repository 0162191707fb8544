"""Removal of repeated word sequences by difference-cover anchors (operator 12).

A window is ``window`` consecutive words.  A difference cover D modulo a period
v holds, for any two positions i and j, a shift k < v such that i + k and j + k
both lie on D modulo v.  So if short windows of ``window`` - v + 1 words
(anchors) are hashed only at positions on D, any two equal windows share an
aligned anchor inside them.  Anchors that occur more than once are then
extended to the whole windows around them, and those that occur more than once
mark their words.  With a period of 21, D has five positions: under a quarter
of all positions are hashed and shuffled in the first step, and only words near
repeated anchors in the second.

Occurrences meet by hash.  A task pairs what it holds itself, a chunk at a
time: of a key that the chunk holds more than once only the key goes on, and
its occurrences are known to be repeated.  A passage that a third of all
documents share is thus one key per chunk, and no pairs are made.  The others
go to the bucket of their key, packed: a row per chunk and bucket holds the
bytes of the keys that the bucket doesn't imply, and places as (document of
the chunk, position).  What a bucket finds repeated returns by chunk, where the
documents' names are.  Anchor keys (40 bits beside the bucket) only choose
where to look; whole windows are compared by 80 bits beside the bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import frame, map_arrow, shuffle_partitions, slices, texts_of
from quarry.llm.word_batch import _pow, exact_hashes, mix, pieces

#: Difference sets with q + 1 members modulo q^2 + q + 1.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
CHUNK = 1 << 20  # occurrences that a task pairs at a time
STEP = 1 << 20  # words hashed at a time
KEY_BYTES = 5  # of each half of a key, beside the bucket
LONE, TOLD, MARKS, NAMES = range(4)  # kinds of packed rows

PACKED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("body", pa.binary())])
PACKED_DDL = "bucket int, chunk bigint, kind int, n int, body binary"


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period at most three fifths of the window, and its cover."""
    period = max(v for v in COVERS if v == 1 or 5 * v <= 3 * window)
    return period, COVERS[period]


def sequence_hashes(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each of the ascending positions
    ``at``, as differences of running polynomials over bounded blocks."""
    out = np.empty(len(at), np.uint64)
    lo = 0
    while lo < len(at):
        base = int(at[lo])
        hi = int(np.searchsorted(at, base + STEP))
        part = words[base:int(at[hi - 1]) + length]
        power, inverse = _pow(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * power[:len(part)], out=sums[1:])
        start = at[lo:hi] - base
        out[lo:hi] = mix((sums[start + length] - sums[start]) * inverse[start])
        lo = hi
    return out


def anchor_positions(n_words: int, window: int) -> np.ndarray:
    """Positions of anchors in a text: those on the cover; none in a text
    shorter than a window."""
    period, cover = cover_for(window)
    if n_words < window:
        return np.zeros(0, np.int64)
    last = n_words - (window - period + 1)
    at = (np.arange(last // period + 1)[:, None] * period + np.array(cover)).ravel()
    return at[at <= last]


def planes(v: np.ndarray, k: int) -> bytes:
    """The low ``k`` bytes of each number, all first bytes first."""
    return v.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k].T.tobytes()


def numbers(body: bytes, n: int, k: int, at: int = 0) -> np.ndarray:
    """Inverse of :func:`planes` from byte ``at`` on."""
    out = np.zeros((n, 8), np.uint8)
    out[:, :k] = np.frombuffer(body, np.uint8, n * k, at).reshape(k, n).T
    return out.reshape(-1).view("<u8")


class _Pairing:
    """Occurrences of a chunk -> packed rows.  A document is in one chunk."""

    def __init__(self, buckets: int, halves: int):
        self.buckets, self.halves = buckets, halves
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.names: list[tuple[int, int]] = []
        self.held, self.chunk = 0, TaskContext.get().partitionId() << 32

    def add(self, name: tuple[int, int], key: np.ndarray, more: np.ndarray | None, at: np.ndarray,
            known: bool = False) -> Iterator[pa.RecordBatch]:
        """``known``: repeated anyway, and not to be told again."""
        if not len(key):
            return
        self.parts.append((key, key if more is None else more, np.full(len(key), len(self.names)), at, np.full(len(key), known)))
        self.names.append(name)
        self.held += len(key)
        if self.held >= CHUNK:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        key, more, doc, at, known = (np.concatenate(c) for c in zip(*self.parts))
        order = np.argsort(key) if self.halves == 1 else np.lexsort((more, key))
        new = np.ones(len(key), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        if self.halves == 2:
            new[1:] |= more[order[1:]] != more[order[:-1]]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(key)])
        twice = (size > 1) | np.logical_or.reduceat(known[order], first)
        again = np.zeros(len(key), bool)
        again[order] = np.repeat(twice, size)
        rows = [*self._by_bucket(LONE, key, more, np.flatnonzero(~again), doc, at),
                *self._by_bucket(TOLD, key, more, order[first[twice]])]
        names = np.array(self.names, np.int64)
        rows.append((self.chunk % self.buckets, NAMES, len(names), names.T.tobytes()))
        mine = np.flatnonzero(again & ~known)
        if len(mine):
            rows.append((self.chunk % self.buckets, MARKS, len(mine), planes(doc[mine], 3) + planes(at[mine], 4)))
        for lo in range(0, len(rows), 256):
            bucket, kind, n, body = zip(*rows[lo:lo + 256])
            yield frame(PACKED, [bucket, [self.chunk] * len(n), kind, n, body])
        self.parts, self.names, self.held = [], [], 0
        self.chunk += 1

    def _by_bucket(self, kind: int, key: np.ndarray, more: np.ndarray, of: np.ndarray, doc: np.ndarray | None = None,
                   at: np.ndarray | None = None) -> Iterator[tuple[int, int, int, bytes]]:
        bucket = (((key[of] >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        of, bucket = of[order], bucket[order]
        edges = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(of)] if len(of) else np.zeros(1, np.int64)
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = of[lo:hi]
            body = planes(key[own], KEY_BYTES) + (planes(more[own], KEY_BYTES) if self.halves == 2 else b"")
            if doc is not None:  # documents in order: small steps
                body += planes(np.diff(doc[own], prepend=0), 3) + planes(at[own], 4)
            yield int(bucket[lo]), kind, hi - lo, body


def _grouped(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[list[dict]]:
    """Rows of sorted batches by runs of the column ``by``."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0][by] != row[by]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def repeated(packed: DataFrame, halves: int) -> DataFrame:
    """``(h1, h2, at)`` from packed rows: for each document the ascending
    positions of its keys that occur more than once, documents without any left
    out.  A document of several rows has several.

    Chunks must come out alike if a task runs again: the input's order within
    its partitions is that of files or of a sort."""
    parts = shuffle_partitions(packed)
    marks_ddl = "chunk bigint, kind int, n int, body binary"
    marks = pa.schema([(f.name, f.type) for f in PACKED if f.name != "bucket"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "bucket"):
            passed = [r for r in rows if r["kind"] in (MARKS, NAMES)]
            if passed:
                yield frame(marks, [[r[c] for r in passed] for c in marks.names])
            lone = [r for r in rows if r["kind"] == LONE]
            if not lone:
                continue
            every = lone + [r for r in rows if r["kind"] == TOLD]
            key = np.concatenate([numbers(r["body"], r["n"], KEY_BYTES) for r in every])
            n_lone = sum(r["n"] for r in lone)
            told = np.arange(len(key)) >= n_lone
            if halves == 2:
                more = np.concatenate([numbers(r["body"], r["n"], KEY_BYTES, r["n"] * KEY_BYTES) for r in every])
                order = np.lexsort((more, key))
            else:
                order = np.argsort(key)
            new = np.ones(len(key), bool)
            new[1:] = key[order[1:]] != key[order[:-1]]
            if halves == 2:
                new[1:] |= more[order[1:]] != more[order[:-1]]
            first = np.flatnonzero(new)
            size = np.diff(np.r_[first, len(key)])
            twice = (size > 1) | np.logical_or.reduceat(told[order], first)
            again = np.zeros(len(key), bool)
            again[order] = np.repeat(twice, size)
            lo, found = 0, []
            for r in lone:
                hit = np.flatnonzero(again[lo:lo + r["n"]])
                lo += r["n"]
                if len(hit):
                    after = r["n"] * KEY_BYTES * halves
                    doc = np.cumsum(numbers(r["body"], r["n"], 3, after))[hit]
                    at = numbers(r["body"], r["n"], 4, after + 3 * r["n"])[hit]
                    found.append((r["chunk"], MARKS, len(hit), planes(doc, 3) + planes(at, 4)))
            if found:
                yield frame(marks, list(zip(*found)))

    out_ddl = "h1 bigint, h2 bigint, at array<int>"
    out = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("at", pa.list_(pa.int32()))])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "chunk"):
            names = [r for r in rows if r["kind"] == NAMES]
            rows = [r for r in rows if r["kind"] == MARKS]
            if not rows:
                continue
            if not names:
                raise ValueError("a chunk's documents changed between two runs of a task: sort the input within its partitions")
            h1, h2 = np.frombuffer(names[0]["body"], np.int64).reshape(2, -1)
            doc = np.concatenate([numbers(r["body"], r["n"], 3) for r in rows]).astype(np.int64)
            at = np.concatenate([numbers(r["body"], r["n"], 4, 3 * r["n"]) for r in rows]).astype(np.int32)
            order = np.lexsort((at, doc))
            doc, at = doc[order], at[order]
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            own = doc[first]
            cuts = np.r_[first, len(doc)]
            for lo in range(0, len(own), 1000):
                hi = min(lo + 1000, len(own))
                lists = pa.ListArray.from_arrays(pa.array((cuts[lo:hi + 1] - cuts[lo]).astype(np.int32)), pa.array(at[cuts[lo]:cuts[hi]]))
                yield pa.RecordBatch.from_arrays([pa.array(h1[own[lo:hi]]), pa.array(h2[own[lo:hi]]), lists], schema=out)

    met = map_arrow(packed.repartition(parts, "bucket").sortWithinPartitions("bucket"), meet, marks_ddl)
    return map_arrow(met.repartition(parts, "chunk").sortWithinPartitions("chunk"), name, out_ddl)


def _anchors(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    """Packed rows of the anchors of ``texts(h1, h2, text)``."""
    period, _ = cover_for(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairing = _Pairing(buckets, 1)
        for batch in batches:
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, words in exact_hashes(texts_of(batch.column(2))):
                at = anchor_positions(len(words), window)
                if len(at):
                    yield from pairing.add((h1[row], h2[row]), sequence_hashes(words, at, window - period + 1), None, at)
        yield from pairing.flush()

    return map_arrow(texts, run, PACKED_DDL)


def _windows(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    """Packed rows of the windows around the anchors of ``texts(h1, h2, copied,
    anchors, text)``.  Those of a text that has copies are repeated: they are
    told to others, and not asked for."""
    period, _ = cover_for(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairing = _Pairing(buckets, 2)
        for batch in batches:
            h1, h2, copied = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "copied"))
            anchors = batch.column("anchors")
            for row, words in exact_hashes(texts_of(batch.column("text"))):
                near = np.zeros(len(words) + 1, np.int64)
                at = anchors[row].values.to_numpy()
                np.add.at(near, np.maximum(at - (period - 1), 0), 1)
                np.add.at(near, at + 1, -1)
                at = np.flatnonzero(np.cumsum(near)[:len(words) - window + 1])
                key = sequence_hashes(words, at, window)
                more = sequence_hashes(mix(words ^ np.uint64(0x5851F42D4C957F2D)), at, window)
                yield from pairing.add((h1[row], h2[row]), key, more, at, bool(copied[row]))
        yield from pairing.flush()

    return map_arrow(texts, run, PACKED_DDL)


def spans_of(starts: np.ndarray, window: int) -> np.ndarray:
    """[n, 2] word ranges covered by the windows at ``starts``."""
    starts = np.unique(starts)
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > starts[:-1] + window
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]
    return np.stack([starts[new], starts[last] + window], axis=1).astype(np.int64)


def without(text: bytes, spans: np.ndarray) -> tuple[int, bytes]:
    """Words of ``text``, and it without the word ranges ``spans``, its words
    joined by one space."""
    n, kept = 0, []
    for piece in pieces(text):
        words, base = piece.split(), n
        n += len(words)
        at = base
        for a, b in spans[np.searchsorted(spans[:, 1], base, "right"):].tolist():
            if a >= n:
                break
            kept += words[at - base:max(a - base, 0)]
            at = max(at, b)
        kept += words[max(at - base, 0):]
    return n, b" ".join(kept)


def text_key() -> list[Column]:
    """Two 64-bit hashes that stand for a whole text (null: empty)."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def remove_repeats(docs: DataFrame, window: int = 35, bucket_chars: int = 64 << 20) -> DataFrame:
    """``docs(doc_id, text)`` without the words that repeat elsewhere.

    Words are runs of other than blank and 0x09 - 0x0D, unchanged.  A word goes
    if a window of ``window`` words that covers it starts anywhere else too, in
    the same document or another; windows are those of the input.  Returns a
    row per row: ``doc_id, n_words, n_removed, spans`` (word ranges [start,
    end) removed) and ``kept`` (the other words joined by one space).  Null
    and empty texts have no words; texts shorter than a window lose none;
    repeated rows are documents of their own, so a long text among them goes
    altogether.  An empty table gives no rows.

    ``bucket_chars``: about how much text a bucket of keys stands for; its
    keys are held at once."""
    if window < 1:
        raise ValueError("a window has at least one word")
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"), *text_key())
    keys = src.groupBy("h1", "h2").agg((F.count(F.lit(1)) > 1).alias("copied"), F.min("doc_id").alias("low"))
    size = src.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(shuffle_partitions(docs), size // bucket_chars)
    marks = repeated(_anchors(src.select("h1", "h2", "text"), window, buckets), 1)
    marks = marks.groupBy("h1", "h2").agg(F.first("at").alias("anchors"))  # copies have equal ones
    near = keys.join(marks, ["h1", "h2"])
    # of a text's copies those under its lowest id speak for all
    chosen = src.join(near, ["h1", "h2"]).filter(F.col("doc_id").eqNullSafe(F.col("low")))
    chosen = chosen.select("h1", "h2", "copied", "anchors", "text").sortWithinPartitions("h1", "h2")
    starts = repeated(_windows(chosen, window, buckets), 2).groupBy("h1", "h2").agg(F.first("at").alias("starts"))
    known = keys.filter("copied").select("h1", "h2", F.lit(True).alias("copied"), F.lit(None).cast("array<int>").alias("starts"))
    known = known.unionByName(starts.withColumn("copied", F.lit(False)))
    kind = src.schema["doc_id"].dataType.simpleString()
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, starts = texts_of(batch.column("text")), batch.column("starts")
            copied = batch.column("copied").fill_null(False)
            for lo, hi in slices(texts):
                counts, spans, kept = [], [], []
                for row in range(lo, hi):
                    at = starts[row].values.to_numpy() if starts[row].is_valid else np.zeros(0, np.int64)
                    own = spans_of(at, window)
                    n, rest = without(texts[row].as_buffer().to_pybytes(), own)
                    if copied[row].as_py() and n >= window:
                        own, rest = np.array([[0, n]]), b""
                    counts.append(n)
                    spans.append(own)
                    kept.append(rest)
                flat, sizes = np.concatenate(spans), [len(s) for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(counts, pa.int64()),
                     pa.array([int((s[:, 1] - s[:, 0]).sum()) for s in spans], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()),
                                              pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(pair))),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    rows = src.join(known, ["h1", "h2"], "left").select("doc_id", "text", "copied", "starts")
    return map_arrow(rows, cut, f"doc_id {kind}, n_words bigint, n_removed bigint, "
                                "spans array<struct<start: bigint, end: bigint>>, kept string")


#: DuckDB SQL for the columns of ``op12`` over ``documents``.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, len(w) AS n, w FROM d
), g AS (SELECT rid, i, word, CASE WHEN i + 34 <= n THEN sha256(array_to_string(w[i:i + 34], ' ')) END AS h FROM p
), c AS (SELECT *, h IS NOT NULL AND count(*) OVER (PARTITION BY h) > 1 AS again FROM g
), k AS (
  SELECT rid, i, word, max(CASE WHEN again THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM c
), r AS (SELECT rid, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM k GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(r.n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(r.kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (rid)
"""
