"""Toxic passages by maximum-scoring segment search (operator 5).

Tokens are runs of letters and digits.  A token's features are itself and its
first four, five and six bytes; for each the log odds of toxic against clean
training documents are taken with a Dirichlet prior and their lower
confidence bound (what small counts can't show counts as nothing), less a
drift.  A linear scan (Ruzzo and Tompa) finds all maximal scoring segments of
a text.  Clean training documents give the extreme-value law of a text's best
segment, P(S > x) = 1 - exp(-K n exp(-lambda x)); a segment's expected number
by chance makes it significant or not, and a logistic curve over the best
segment's evidence and the number of significant ones gives the score."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import collected, map_arrow, stable, texts_of
from quarry.llm.quality import labelled_rows, logistic
from quarry.llm.word_batch import NOT_ALNUM, Words, mix, word_batches

DIMS = 1 << 20
PREFIXES = (4, 5, 6)


def features(w: Words) -> list[np.ndarray]:
    """Hashed feature of each token: the token, then its prefixes."""
    kinds = [w.hashes(), *(w.prefix(k) for k in PREFIXES)]
    return [(mix(h + np.uint64(0xA11CE * (i + 1))) % np.uint64(DIMS)).astype(np.int64) for i, h in enumerate(kinds)]


def token_scores(counts: np.ndarray, prior: float = 0.5, confidence: float = 2.33, drift: float = 0.3,
                 low: float = -2.0, high: float = 6.0) -> np.ndarray:
    """Score per feature from document counts ``counts[class, feature]``
    (class 1 toxic): the log odds' confidence bound nearest to nought (nought
    if the interval holds it) minus ``drift``."""
    n0, n1 = counts.sum(axis=1, dtype=float)
    if not n0 or not n1:
        return np.full(counts.shape[1], -drift, np.float32)
    used = max(int(counts.any(axis=0).sum()), 1)
    out = np.empty(counts.shape[1], np.float32)
    for lo in range(0, len(out), 1 << 16):  # in parts: no wide intermediate arrays
        out[lo:lo + (1 << 16)] = _bounds(counts[:, lo:lo + (1 << 16)].astype(float), n0, n1, used, prior, confidence)
    return np.clip(out - np.float32(drift), low, high)


def _bounds(counts: np.ndarray, n0: float, n1: float, used: int, prior: float, confidence: float) -> np.ndarray:
    a0, a1 = prior * (n0 / (n0 + n1)), prior * (n1 / (n0 + n1))  # the prior follows the classes' shares
    delta = np.log((counts[1] + a1) / (n1 + a1 * used)) - np.log((counts[0] + a0) / (n0 + a0 * used))
    sigma = np.sqrt(1 / (counts[1] + a1) + 1 / (counts[0] + a0))
    # a feature without clean documents has as much to show as one clean document would leave it
    sigma = np.where(counts[0] < 1, np.sqrt(1 / (counts[1] + a1) + 1), sigma)
    delta = np.where(counts[0] < 1, np.minimum(delta, np.log((counts[1] + a1) / n1) - np.log(1 / n0)), delta)
    return np.maximum(delta - confidence * sigma, 0) + np.minimum(delta + confidence * sigma, 0)


def maximal_segments(scores: np.ndarray, at: np.ndarray, total: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a text whose
    positive tokens stand at ``at``; ``total`` is the running sum of all
    scores with a leading 0.  Linear in the positive tokens."""
    found: list[list] = []  # start, end, sum before, sum after
    for i in at.tolist():
        k = [i, i + 1, float(total[i]), float(total[i + 1])]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= k[2]:
                j -= 1
            if j < 0 or found[j][3] >= k[3]:
                found.append(k)
                break
            k[0], k[2] = found[j][0], found[j][2]
            del found[j:]
    return [(s, e, r - l) for s, e, l, r in found]


def segments(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, n_tokens, best, segments)``, a row
    per row; ``segments`` holds start and end byte, score and (hashed) first
    token of every maximal scoring segment, ``best`` the highest score (0 without any)."""
    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(table)  # DIMS float32
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("opening", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = shared.value
        for batch in batches:
            texts = texts_of(batch.column(1))
            n, best, found = np.zeros(len(texts), np.int64), np.zeros(len(texts)), [[] for _ in range(len(texts))]
            for lo, hi, w in word_batches(texts, NOT_ALNUM):
                n[lo:hi] = w.count
                kinds = features(w)
                s = np.maximum.reduce([scores[f] for f in kinds]).astype(float)
                s[w.repeats(kinds[0])] = min(0.0, float(scores.min()))  # a word said over and over is one word
                hot, words = np.flatnonzero(s > 0), kinds[0]
                for d in np.unique(w.doc[hot]).tolist():
                    a, b = int(w.first[d]), int(w.first[d] + w.count[d])
                    at = hot[np.searchsorted(hot, a):np.searchsorted(hot, b)] - a
                    here = maximal_segments(s[a:b], at, np.r_[0.0, np.cumsum(s[a:b])])
                    base = w.offsets[d]
                    found[lo + d] = [{"start": int(w.start[a + i] - base), "end": int(w.end[a + j - 1] - base), "score": x,
                                      "opening": int(words[a + i])} for i, j, x in here]
                    best[lo + d] = max(x for _, _, x in here)
            yield pa.record_batch([batch.column(0), pa.array(n), pa.array(best), pa.array(found, pa.list_(item))],
                                  names=["doc_id", "n_tokens", "best", "segments"])

    return map_arrow(src, run, f"doc_id {kind}, n_tokens bigint, best double, "
                               "segments array<struct<start:bigint,end:bigint,score:double,opening:bigint>>")


def count_features(rows: DataFrame) -> np.ndarray:
    """Documents of each class that hold each feature: ``rows(text, y)`` ->
    array [2, DIMS]; tasks add up their rows first, so at most DIMS rows per
    task are shuffled and DIMS reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, DIMS), np.int32)
        for batch in batches:
            ys = batch.column(1).to_numpy()
            for lo, hi, w in word_batches(texts_of(batch.column(0)), NOT_ALNUM):
                label = ys[lo:hi]
                keys = np.unique(np.concatenate([w.doc.astype(np.int64) * DIMS + f for f in features(w)]))
                which = label[keys // DIMS]
                for k in (0, 1):
                    counts[k] += np.bincount(keys[which == k] % DIMS, minlength=DIMS).astype(np.int32)
        f = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(f), 20_000):
            g = f[at:at + 20_000]
            yield pa.record_batch([pa.array(g.astype(np.int32)), pa.array(counts[0, g]), pa.array(counts[1, g])],
                                  names=["f", "n0", "n1"])

    sums = map_arrow(rows.select("text", "y"), run, "f int, n0 int, n1 int").groupBy("f").agg(
        F.sum("n0").cast("float").alias("n0"), F.sum("n1").cast("float").alias("n1"))
    f, n0, n1 = collected(sums)
    counts = np.zeros((2, DIMS), np.float32)
    counts[0, f], counts[1, f] = n0, n1
    return counts


def toxic_documents(docs: DataFrame, labels: DataFrame, column: str = "toxic", evalue: float = 0.01,
                    sample: int = 20_000) -> DataFrame:
    """Score ``docs(doc_id, text)`` against ``labels(doc_id, column)``.

    Returns a row per row: ``doc_id``, ``score`` (probability of label 1),
    ``n_tokens`` and ``passages``, the segments whose expected number by
    chance is at most ``evalue`` (start and end in bytes, score).  Learns only
    from labelled rows whose crc32 fold modulo 5 is not 0; token counts and the
    extreme-value law cover all of them, the logistic curve about ``sample`` at
    most.  Null and empty texts have no segment and the score of that; without
    labels of both classes no segment is found and all scores are equal.
    """
    rows, totals = labelled_rows(docs, labels, column)
    table = token_scores(count_features(rows))
    found = stable(segments(docs, table))
    y = stable(found.select("doc_id", "n_tokens", "best", "segments").join(rows.select("doc_id", "y").distinct(), "doc_id")
               .dropDuplicates(["doc_id"]))
    clean = y.filter("y = 0").agg(F.sum((F.col("best") > 0).cast("int")), F.sum("best"), F.sum("n_tokens")).first()
    hits, mass, tokens = (float(v or 0) for v in clean)
    # tail of the clean documents' best segments: exponential above 0, one pseudo segment of score 1 in hand
    lam, big_k = (hits + 1) / (mass + 1), (hits + 1) / (tokens + 1)
    chance = lambda s: F.lit(big_k) * F.greatest("n_tokens", F.lit(1)) * F.exp(F.lit(-lam) * s)

    def evidence(df: DataFrame) -> DataFrame:
        df = df.withColumn("passages", F.filter("segments", lambda s: chance(s["score"]) <= F.lit(evalue)))
        return df.withColumn("x1", F.when(F.col("best") > 0, F.greatest(F.lit(0.0), F.least(F.lit(30.0), -F.log(chance(F.col("best"))))))
                             .otherwise(F.lit(0.0))).withColumn("x2", F.log1p(
            F.size(F.array_distinct(F.transform("passages", lambda s: s["opening"]))).cast("double")))

    n_of = {r["y"]: r["n"] for r in totals.collect()}
    rate = min(1.0, sample / max(sum(n_of.values()), 1))
    dice = F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 20)) < F.lit(int(rate * (1 << 20)))
    x1, x2, label = collected(evidence(y).filter(dice).select("x1", "x2", "y").limit(sample + sample // 2))
    beta = np.zeros(3)
    if n_of.get(0) and n_of.get(1) and len(np.unique(label)) == 2:
        beta = logistic(np.c_[x1, x2, np.ones(len(x1))], label.astype(float), np.ones(len(x1)))
    out = evidence(found)
    z = F.lit(float(beta[0])) * F.col("x1") + F.lit(float(beta[1])) * F.col("x2") + F.lit(float(beta[2]))
    return out.select("doc_id", (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("score"), "n_tokens", "passages")
