"""Best-fit packing of tokenized documents (operator 10).

A document's ids are those of the given byte-level BPE tokenizer plus one end
id.  A document longer than a sequence is cut so that only its first piece is
short; whole pieces fill a sequence each, the others are packed by vector
best fit: a bin has residual capacities of tokens, documents and attention
cost (sum of squared lengths), a piece goes only where all three suffice, and
among those to the bin with the smallest weighted residual norm (or largest
weighted dot product).  Pieces are dealt at random into groups of bounded size
and packed longest first, so packing is parallel and its waste is about one
open bin per group of thousands."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.byte_bpe import byte_bpe
from quarry.llm.common import map_arrow, ship, slices, stable, texts_of


def cut(length: int, most: int) -> list[int]:
    """Piece lengths: whole when it fits, else full pieces behind a first one
    that holds the rest."""
    if length <= most:
        return [length]
    rest = length % most
    return [rest] * (rest > 0) + [most] * (length // most)


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = 2048, end_id: int = 0) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, piece, start, length, ids_crc32)``;
    a null or empty text is the end id alone."""
    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = byte_bpe(tokenizer), int(end_id).to_bytes(4, "little")
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in slices(texts):
                row, piece, start, length, crc = [], [], [], [], []
                for i, text in enumerate(texts.slice(lo, hi - lo).to_pylist(), lo):
                    data, at = encode(text).astype("<u4").tobytes() + end, 0
                    for j, n in enumerate(cut(len(data) // 4, max_tokens)):
                        row.append(i)
                        piece.append(j)
                        start.append(at)
                        length.append(n)
                        crc.append(zlib.crc32(data[4 * at:4 * (at + n)]))
                        at += n
                yield pa.record_batch([batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                                      names=names)

    return map_arrow(src, run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: np.ndarray, capacity: Sequence[float], weights: Sequence[float] = (1.0, 1.0, 1.0),
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Vector best fit of pieces, longest first: bin and offset of each.

    ``capacity`` = tokens, documents, attention cost of a bin.  Demands and
    residuals are compared as shares of the capacities.  ``rule`` "norm" takes
    the feasible bin with the least weighted residual norm after the piece,
    "dot" the one with the largest weighted product of demand and residual;
    ties go to the oldest bin.  A piece that no bin takes opens one.
    """
    cap, w = np.asarray(capacity, float), np.asarray(weights, float)
    n = len(lengths)
    if rule not in ("norm", "dot"):
        raise ValueError(f"no such rule: {rule}")
    where, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    free, number = np.empty((n, 3)), np.empty(n, np.int64)  # open bins: residuals, ids
    n_open = n_bins = 0
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min()) if n else 0
    for i in order.tolist():
        size = float(lengths[i])
        need = np.array([size, 1.0, size * size])
        if (need > cap).any():
            raise ValueError("a piece exceeds a sequence's capacities")
        left = free[:n_open] - need
        fits = np.flatnonzero((left[:, 0] >= 0) & (left[:, 1] >= 0) & (left[:, 2] >= 0))
        if len(fits):
            if rule == "norm":
                s = left[fits] / cap
                j = int(fits[np.argmin((w * s * s).sum(axis=1))])
            else:
                j = int(fits[np.argmax((w * (need / cap) * (free[fits] / cap)).sum(axis=1))])
        else:
            j = n_open
            free[j], number[j] = cap, n_bins
            n_open += 1
            n_bins += 1
        where[i], offset[i] = number[j], int(cap[0] - free[j, 0])
        free[j] -= need
        if free[j, 0] < least or free[j, 1] < 1 or free[j, 2] < least * least:  # takes no more: close it
            n_open -= 1
            free[j:n_open], number[j:n_open] = free[j + 1:n_open + 1].copy(), number[j + 1:n_open + 1].copy()
    return where, offset


def pack(docs: DataFrame, tokenizer: str, max_tokens: int = 2048, max_docs: int | None = None,
         max_cost: float | None = None, weights: Sequence[float] = (1.0, 1.0, 1.0), rule: str = "norm",
         group: int = 8192, end_id: int = 0) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``max_tokens``.

    Returns a row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.  ``max_docs`` and ``max_cost`` (sum of squared
    piece lengths) default to values that a full sequence just reaches, so
    tokens alone bind.  Null and empty texts are packed as the end id alone,
    repeated rows as often as they occur; an empty table gives no rows.
    """
    docs_cap = float(max_docs or max_tokens)
    cost_cap = float(max_cost or max_tokens * max_tokens)
    rows = stable(pieces(docs, tokenizer, max_tokens, end_id).withColumn("uid", F.monotonically_increasing_id()))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = rows.filter(F.col("length") == max_tokens).select(
        *names[:5], (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = rows.filter(F.col("length") < max_tokens)
    groups = max(1, -(-rest.count() // group))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # rows of a group come together by a hash of their row number: near ``group`` of them whatever the data
    dealt = rest.withColumn("g", F.pmod(F.xxhash64("uid"), F.lit(groups)))

    def run(key, pdf):
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        where, offset = best_fit(pdf["length"].to_numpy(), (max_tokens, docs_cap, cost_cap), weights, rule)
        pdf["sequence_id"], pdf["offset"] = int(key[0]) * (1 << 24) + where, offset
        return pdf[names]

    ship(docs)
    packed = dealt.groupBy("g").applyInPandas(run, f"doc_id {kind}, piece int, start bigint, length bigint, "
                                                   "ids_crc32 bigint, sequence_id bigint, offset bigint")
    return full.unionByName(packed)
