"""Quality classifier: Naive Bayes support vectors (operator 2).

Features are hashed n-gram indicators: words, word pairs, and one to three
consecutive word shapes (letter case, digits and punctuation with runs
collapsed, and whether the word repeats the one before).  Each indicator is
scaled by the log ratio of its smoothed class counts, counted over all
labelled training documents; a linear hinge-loss model over the scaled
indicators is fitted by dual coordinate descent on a bounded sample of them,
and a logistic curve on a held-back part of that sample turns margins into
probabilities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import collected, fold, map_arrow, stable, texts_of
from quarry.llm.word_batch import Running, Words, mix, word_batches

DIMS = 1 << 18
_SALTS = np.array([0x1F3D5B79, 0x2E4C6A88, 0x3D5B7997, 0x4C6A88A6, 0x5B7997B5], np.uint64)

_CLASS = np.arange(256, dtype=np.uint8)  # punctuation stands for itself
_CLASS[97:123] = _CLASS[128:] = ord("a")
_CLASS[65:91] = ord("A")
_CLASS[48:58] = ord("0")


def _shapes(w: Words) -> np.ndarray:
    """Hash of each word's byte classes with runs collapsed."""
    cls = _CLASS[w.data]
    keep = np.ones(len(cls), bool)
    keep[1:] = cls[1:] != cls[:-1]
    keep[w.start] = True
    at = np.r_[0, np.cumsum(keep)]
    return Running(cls[keep]).of(at[w.start], at[w.end])


def indicators(w: Words, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, feature) of every n-gram present, each pair once, by doc."""
    h = w.hashes()
    shape = _shapes(w)
    shape = np.where(w.repeats(h), mix(shape + np.uint64(0x5EED)), shape)
    one = np.uint64(31)
    pair = mix(h[:-1] * one + h[1:]) if len(h) else h
    shape2 = mix(shape[:-1] * one + shape[1:]) if len(h) else h
    shape3 = mix(shape2[:-1] * one + shape[2:]) if len(h) > 1 else h[:0]
    same2 = w.doc[1:] == w.doc[:-1]
    same3 = w.doc[2:] == w.doc[:-2]
    parts = [(h, w.doc), (pair[same2], w.doc[1:][same2]), (shape, w.doc), (shape2[same2], w.doc[1:][same2]),
             (shape3[same3], w.doc[2:][same3])]
    keys = [d.astype(np.int64) * DIMS + (mix(x + s) % np.uint64(DIMS)).astype(np.int64) for (x, d), s in zip(parts, _SALTS)]
    keys = np.unique(np.concatenate(keys))
    return keys // DIMS, keys % DIMS


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dims: int, c: np.ndarray,
                            epochs: int = 12, seed: int = 3) -> np.ndarray:
    """Weights of the linear SVM min |w|^2/2 + sum c_i max(0, 1 - y_i w.x_i)
    (L1 hinge) by coordinate descent on its dual; rows are (indices, values),
    y is -1 or 1."""
    w, alpha = np.zeros(dims), np.zeros(len(rows))
    norm = np.array([max(float(v @ v), 1e-12) for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)).tolist():
            idx, val = rows[i]
            g = y[i] * float(w[idx] @ val) - 1.0
            new = min(max(alpha[i] - g / norm[i], 0.0), c[i])
            if new != alpha[i]:
                w[idx] += (new - alpha[i]) * y[i] * val
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Weighted logistic regression by Newton steps; ``x`` has an intercept
    column last, which the ridge leaves alone."""
    beta = np.zeros(x.shape[1])
    pen = np.full(x.shape[1], ridge * max(weight.sum(), 1e-9) / max(len(y), 1))
    pen[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (weight * (p - y)) + pen * beta
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(pen)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta


class QualityModel:
    """``table`` weight per feature; ``ratio`` squared ratio per feature (for
    the norm); margin = table[f].sum() / sqrt(ratio[f].sum()) + bias."""

    def __init__(self, table: np.ndarray, ratio: np.ndarray, bias: float, slope: float, shift: float):
        self.table, self.ratio, self.bias = table.astype(np.float32), ratio.astype(np.float32), bias
        self.slope, self.shift = slope, shift

    def margins(self, w: Words, n_docs: int) -> np.ndarray:
        doc, f = indicators(w, n_docs)
        total = np.bincount(doc, self.table[f].astype(float), n_docs)
        norm = np.sqrt(np.maximum(np.bincount(doc, self.ratio[f].astype(float), n_docs), 1e-12))
        return total / norm + self.bias

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def labelled_rows(docs: DataFrame, labels: DataFrame, column: str, held: int = 5) -> tuple[DataFrame, DataFrame]:
    """``(rows(doc_id, text, y), totals(y, n))`` to learn from: documents with
    a label and a crc32 fold modulo ``held`` other than 0.

    Ids that repeat in ``labels`` count once, the larger label stands; null
    ids and null labels are none.  Equal texts with equal labels give one row
    (the smallest id), so a large group of copies weighs no more than a
    document.  Texts of other rows are filtered away before the shuffle only
    by fold; narrow rows decide which ids take part."""
    y = labels.select("doc_id", F.col(column).cast("int").alias("y")).dropna()
    y = y.groupBy("doc_id").agg((F.max("y") > 0).cast("int").alias("y")).filter(fold(F.col("doc_id"), held) != 0)
    mine = docs.select("doc_id", "text").filter(fold(F.col("doc_id"), held) != 0)
    hashed = mine.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    chosen = stable(hashed.join(y, "doc_id").groupBy("h", "y").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "h", "y"))
    rows = mine.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).join(chosen, ["doc_id", "h"])
    return rows.select("doc_id", "text", "y"), chosen.groupBy("y").agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", sample: int = 6000, cost: float = 1.0,
        seed: int = 5) -> QualityModel:
    """Fit on ``docs(doc_id, text)`` joined to ``labels(doc_id, column)``;
    rows whose crc32 fold modulo 5 is 0 are left out.  Class counts cover all
    labelled rows; the hinge-loss fit sees about ``sample`` of them at most,
    half of each class, chosen by a hash of their text.  Without labels of
    both classes the model gives the share of label 1 (0.5 without any)."""
    rows, totals = labelled_rows(docs, labels, column)
    n_of = {r["y"]: r["n"] for r in totals.collect()}  # a row per class
    rates = [min(1.0, sample / 2 / max(n_of.get(k, 0), 1)) for k in (0, 1)]
    dice = F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = rows.select("text", "y", (dice < F.when(F.col("y") > 0, rates[1]).otherwise(rates[0])).alias("picked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "f", "n0", "n1"]
        counts = np.zeros((2, DIMS), np.int64)
        size = [0, 0]
        for batch in batches:
            ys, picked = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            for lo, hi, w in word_batches(texts_of(batch.column(0))):
                doc, f = indicators(w, hi - lo)
                label = ys[lo:hi]
                for k in (0, 1):
                    counts[k] += np.bincount(f[label[doc] == k], minlength=DIMS)
                    size[k] += int((label == k).sum())
                cuts = np.searchsorted(doc, np.arange(hi - lo + 1))
                for i in np.flatnonzero(picked[lo:hi]).tolist():
                    yield pa.record_batch([pa.array([int(label[i])], pa.int32()),
                                           pa.array([f[cuts[i]:cuts[i + 1]].astype(np.int32)], pa.list_(pa.int32())),
                                           pa.array([None], pa.list_(pa.int32())), pa.array([None], pa.list_(pa.int32()))], names=names)
        found = np.flatnonzero(counts.any(axis=0))
        f = np.r_[found, -1].astype(np.int32)  # the last entry holds the numbers of documents
        yield pa.record_batch([pa.array([2], pa.int32()), pa.array([f], pa.list_(pa.int32())),
                               pa.array([np.r_[counts[0, found], size[0]].astype(np.int32)], pa.list_(pa.int32())),
                               pa.array([np.r_[counts[1, found], size[1]].astype(np.int32)], pa.list_(pa.int32()))], names=names)

    found = stable(map_arrow(rows, run, "kind int, f array<int>, n0 array<int>, n1 array<int>"))
    each = found.filter("kind = 2").select(F.inline(F.arrays_zip("f", "n0", "n1")))
    table = collected(each.groupBy("f").agg(F.sum("n0").cast("double"), F.sum("n1").cast("double")))  # at most DIMS + 1 rows
    kept = found.filter("kind < 2").limit(sample + sample // 2).select("kind", "f").toArrow()
    return _solve(table, kept, sample, cost, seed)


def _solve(table, kept, sample: int, cost: float, seed: int) -> QualityModel:
    counts = np.zeros((2, DIMS))
    size = np.zeros(2)
    f, n0, n1 = table
    counts[0, f[f >= 0]], counts[1, f[f >= 0]] = n0[f >= 0], n1[f >= 0]
    if (f < 0).any():
        size[:] = n0[f < 0][0], n1[f < 0][0]
    if not size.all():
        share = float(np.clip(size[1] / size.sum(), 1e-3, 1 - 1e-3)) if size.sum() else 0.5
        return QualityModel(np.zeros(DIMS), np.zeros(DIMS), 0.0, 0.0, float(np.log(share / (1 - share))))
    p = (counts + 1) / (size + 2)[:, None]
    ratio = np.log(p[1] / p[0])
    rows, y = [], np.where(kept["kind"].to_numpy() > 0, 1.0, -1.0)
    for item in kept["f"]:
        f = item.values.to_numpy()
        v = ratio[f]
        rows.append((np.r_[f, DIMS], np.r_[v / max(np.linalg.norm(v), 1e-6), 1.0]))  # last: the bias
    order = np.random.default_rng(seed).permutation(len(rows))
    held, used = order[: len(order) // 4], order[len(order) // 4:]
    n_of = {k: max(int((y[used] == k).sum()), 1) for k in (-1.0, 1.0)}
    c = np.array([cost * len(used) / (2 * n_of[y[i]]) for i in used])
    w = dual_coordinate_descent([rows[i] for i in used], y[used], DIMS + 1, c)
    margin = np.array([float(w[rows[i][0]] @ rows[i][1]) for i in held])
    # the sample holds the classes in equal parts: weigh them back to their shares
    share = {1.0: size[1] / size.sum(), -1.0: size[0] / size.sum()}
    n_held = {k: max(int((y[held] == k).sum()), 1) for k in (-1.0, 1.0)}
    weight = np.array([share[y[i]] / n_held[y[i]] * len(held) for i in held])
    slope, shift = logistic(np.c_[margin, np.ones(len(held))], (y[held] > 0).astype(float), weight)
    return QualityModel(w[:DIMS] * ratio, ratio * ratio, float(w[DIMS]), float(slope), float(shift))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``(doc_id, score)`` per row of ``docs(doc_id, text)``: the probability
    of label 1.  Null and empty texts get that of a text without n-grams."""
    src = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two float32 tables of DIMS entries
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(_scores(shared.value, batch.column(1)))], names=["doc_id", "score"])

    return map_arrow(src, run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` (all its columns) without those that score below ``threshold``."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch.column(at)) >= threshold))

    return map_arrow(docs, run, docs.schema)


def _scores(model: QualityModel, column: pa.Array) -> np.ndarray:
    texts = texts_of(column)
    out = np.zeros(len(texts))
    for lo, hi, w in word_batches(texts):
        out[lo:hi] = model.score(model.margins(w, hi - lo))
    return out
