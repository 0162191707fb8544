"""Word-level language identification by a linear-chain CRF (operator 9).

A word's emission scores add up learned weights of its prefixes and suffixes,
of the byte trigrams in it (with its borders), and of a lexicon: the log ratio
of how many training documents of each language hold the word.  Learned
transitions tie neighbouring words, so code-switched text is labelled in runs.
Forward-backward is exact over whole texts: texts are cut into blocks, blocks
are turned into transfer matrices side by side, a scan over each text's blocks
hands the boundary vectors on, and then all blocks run at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import collected, fold, map_arrow, texts_of
from quarry.llm.word_batch import Words, mix, word_batches

AFFIX, GRAMS, LEXICON, BLOCK = 1 << 16, 1 << 16, 1 << 18, 64
NONE = "und"
WINDOWS, WINDOW_CHARS = 4, 2048  # of a long document that the weights are learned on

NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False


def lower(column: pa.Array) -> pa.Array:
    return texts_of(pc.utf8_lower(texts_of(column)))


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


class Features:
    """Feature numbers of the words of a batch."""

    def __init__(self, w: Words):
        self.n = len(w)
        kinds = [w.prefix(k) for k in (1, 2, 3)] + [w.suffix(k) for k in (1, 2, 3)]
        self.affix = np.stack([(mix(h + np.uint64(77 * i + 1)) % np.uint64(AFFIX)).astype(np.int64)
                               for i, h in enumerate(kinds)], axis=1) if self.n else np.zeros((0, 6), np.int64)
        self.word = (w.hashes() % np.uint64(LEXICON)).astype(np.int64)
        here = np.where(NOT_LETTER[w.data], 32, w.lower).astype(np.uint32)
        before, after = np.full(len(here), 32, np.uint32), np.full(len(here), 32, np.uint32)
        before[1:], after[:-1] = here[:-1], here[1:]
        full = np.diff(w.offsets) > 0
        before[w.offsets[:-1][full]] = after[w.offsets[1:][full] - 1] = 32  # texts don't touch
        h = before * np.uint32(0x9E3779B1) + here * np.uint32(0x85EBCA6B) + after * np.uint32(0xC2B2AE35)
        self.gram = ((h ^ (h >> np.uint32(15))) % np.uint32(GRAMS)).astype(np.int64)  # one per byte, centred on it
        self.start, self.end = w.start, w.end


class Crf:
    """Weights over ``langs``; see :meth:`emissions`."""

    def __init__(self, langs: list[str], lexicon: np.ndarray):
        k = len(langs)
        self.langs = langs
        self.affix, self.gram = np.zeros((AFFIX, k), np.float32), np.zeros((GRAMS, k), np.float32)
        self.lexicon = lexicon.astype(np.float32)  # [LEXICON, k]
        self.scale, self.bias = np.full(k, 0.5, np.float32), np.zeros(k, np.float32)
        self.transition = np.eye(k, dtype=np.float64)

    def emissions(self, f: Features) -> np.ndarray:
        k = len(self.langs)
        if not f.n:
            return np.zeros((0, k))
        grams = np.add.reduceat(np.vstack([self.gram[f.gram], np.zeros((1, k), np.float32)]),
                                np.stack([f.start, f.end], 1).ravel(), axis=0)[::2]
        out = grams + self.affix[f.affix].sum(axis=1) + self.lexicon[f.word] * self.scale + self.bias
        return out.astype(np.float64)


def marginals(emission: np.ndarray, count: np.ndarray, transition: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Posterior label probabilities [words, k] of consecutive sequences with
    ``count`` words each, by exact forward-backward."""
    n, k = emission.shape
    if not n:
        return np.zeros((0, k))
    a = np.exp(transition - transition.max())
    e = np.exp(emission - emission.max(axis=1, keepdims=True)) + 1e-30
    per = -(-count // block)  # blocks per sequence
    first_block = np.r_[0, np.cumsum(per)[:-1]]
    nb = int(per.sum())
    seq = np.repeat(np.arange(len(count)), per)
    nth = np.arange(nb) - first_block[seq]
    begin = (np.cumsum(count) - count)[seq] + nth * block
    size = np.minimum(block, count[seq] - nth * block)
    order = np.argsort(-size, kind="stable")  # long blocks first: a step works on a prefix of them
    begin, size = begin[order], size[order]
    active = [int(np.searchsorted(-size, -t, "left")) for t in range(block)]  # blocks longer than t words
    m = np.zeros((nb, k, k))
    m[:, np.arange(k), np.arange(k)] = e[begin]
    for t in range(1, block):
        c = active[t]
        if not c:
            break
        m[:c] = (m[:c] @ a) * e[begin[:c] + t][:, None, :]
        if t % 8 == 0:
            m[:c] /= m[:c].max(axis=(1, 2), keepdims=True)
    m /= m.max(axis=(1, 2), keepdims=True)
    place = np.empty(nb, np.int64)
    place[order] = np.arange(nb)  # block number -> row in the sorted order
    u, post = np.empty((nb, k)), np.ones((nb, k))
    longest = np.argsort(-per, kind="stable")
    longest = longest[per[longest] > 0]
    rounds = int(per.max())
    live = [int(np.searchsorted(-per[longest], -r, "left")) for r in range(rounds)]
    u[place[first_block[longest]]] = 1.0 / k
    for r in range(rounds - 1):
        now = place[first_block[longest[:live[r + 1]]] + r]
        nxt = place[first_block[longest[:live[r + 1]]] + r + 1]
        v = np.einsum("bi,bij->bj", u[now], m[now]) @ a
        u[nxt] = v / v.sum(axis=1, keepdims=True)
    for r in range(rounds - 1, 0, -1):
        now = place[first_block[longest[:live[r]]] + r]
        prev = place[first_block[longest[:live[r]]] + r - 1]
        v = np.einsum("bij,bj->bi", m[now], post[now]) @ a.T
        post[prev] = v / v.max(axis=1, keepdims=True)
    alpha = np.empty((n, k))
    alpha[begin] = u * e[begin]
    for t in range(1, block):
        c = active[t]
        if not c:
            break
        at = begin[:c] + t
        v = (alpha[at - 1] @ a) * e[at]
        alpha[at] = v / v.sum(axis=1, keepdims=True)
    beta = np.empty((n, k))
    beta[begin + size - 1] = post
    for t in range(block - 2, -1, -1):
        c = active[t + 1]
        if c:
            at = begin[:c] + t
            v = (e[at + 1] * beta[at + 1]) @ a.T
            beta[at] = v / v.max(axis=1, keepdims=True)
    g = alpha * beta
    return g / g.sum(axis=1, keepdims=True)


def pair_expectations(emission: np.ndarray, transition: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Node marginals and summed pair marginals of equal-length sequences
    (training): emission [s * length, k]."""
    k = emission.shape[1]
    e = np.exp(emission - emission.max(axis=1, keepdims=True)).reshape(-1, length, k) + 1e-30
    a = np.exp(transition - transition.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    alpha[:, 0] = e[:, 0]
    for t in range(1, length):
        v = (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] = v / v.sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        v = (e[:, t + 1] * beta[:, t + 1]) @ a.T
        beta[:, t] = v / v.max(axis=1, keepdims=True)
    node = alpha * beta
    node /= node.sum(axis=2, keepdims=True)
    pair = alpha[:, :-1, :, None] * a * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return node.reshape(-1, k), pair.sum(axis=(0, 1))


def count_lexicon(docs: DataFrame, langs: list[str]) -> np.ndarray:
    """Documents of each language that hold a word (hashed): [LEXICON, k];
    every task adds up its own rows first."""
    code = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int") - 1
    rows = docs.select("text", code.alias("y"))
    k = len(langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((k, LEXICON), np.int32)
        for batch in batches:
            ys = batch.column(1).to_numpy()
            for lo, hi, w in word_batches(lower(batch.column(0)), NOT_LETTER):
                keys = np.unique(w.doc.astype(np.int64) * LEXICON + (w.hashes() % np.uint64(LEXICON)).astype(np.int64))
                y = ys[lo:hi][keys // LEXICON]
                for j in range(k):
                    counts[j] += np.bincount(keys[y == j] % LEXICON, minlength=LEXICON).astype(np.int32)
        for j in range(k):
            f = np.flatnonzero(counts[j])
            yield pa.record_batch([pa.array(f.astype(np.int32)), pa.array(np.full(len(f), j, np.int32)), pa.array(counts[j, f])],
                                  names=["f", "y", "n"])

    f, y, n = collected(map_arrow(rows, run, "f int, y int, n int").groupBy("f", "y").agg(F.sum("n").cast("float").alias("n")))
    out = np.zeros((LEXICON, k), np.float32)
    out[f, y] = n
    return out


def log_ratios(counts: np.ndarray, prior: float = 0.5) -> np.ndarray:
    """Centred log rates per language of a word's counts; zeros if unseen."""
    return _rates(counts, counts.sum(axis=0), prior)


def _rates(counts: np.ndarray, totals: np.ndarray, prior: float = 0.5) -> np.ndarray:
    rate = np.log(counts + prior * (totals + 1) / (totals.sum() + len(totals)) * len(totals)) - np.log(totals + 1)
    rate -= rate.mean(axis=-1, keepdims=True)
    return np.where(counts.sum(axis=-1, keepdims=True) > 0, np.clip(rate, -4, 4), 0.0)


def fit(docs: DataFrame, sample: int = 600, batches: int = 400, length: int = 64, seed: int = 9, held: tuple[int, int] = (4, 2)) -> Crf:
    """Fit on ``docs(doc_id, text, lang)`` with a language and a crc32 fold
    modulo 4 other than 2.  The lexicon counts all of them; the weights are
    learned on about ``sample`` documents of each language, twice as many at
    most, spliced into sequences with and without language switches.

    One pass draws for all languages, by a hash of the row, so copies of a text
    are drawn one by one.  Of a long document ``WINDOWS`` windows spread over
    all of it are taken, so what reaches the driver is bounded in bytes."""
    rows = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), held[0]) != held[1]))
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    langs = sorted(totals)
    if not langs:
        return Crf([], np.zeros((LEXICON, 0)))
    counts = count_lexicon(rows, langs)
    model = Crf(langs, log_ratios(counts))
    if len(langs) == 1:
        return model
    picked = drawn(rows, {x: min(1.0, sample / n) for x, n in totals.items()}, seed)
    first = Window.partitionBy("lang").orderBy("row", "text")  # of the drawn rows alone
    picked = picked.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= 2 * sample).orderBy("lang", "place")
    _train(model, picked.select(spread("text").alias("text"), "lang").toArrow(), counts, batches, length, seed)
    return model


def drawn(rows: DataFrame, rates: dict[str, float], seed: int) -> DataFrame:
    """``rows(doc_id, text, lang)`` of each language at its rate, with the hash
    ``row`` that draws them."""
    rate = F.create_map(*[F.lit(v) for pair in sorted(rates.items()) for v in pair])[F.col("lang")]
    row = F.xxhash64(F.lit(seed), "doc_id", "text")
    return rows.withColumn("row", row).filter(F.pmod("row", F.lit(1 << 20)) / F.lit(float(1 << 20)) < rate)


def spread(text: str) -> Column:
    """The text, or windows spread evenly over a long one."""
    n = F.length(text)
    places = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda i: F.substr(
        text, F.floor(i * (n - WINDOW_CHARS) / F.lit(WINDOWS - 1)).cast("int") + 1, F.lit(WINDOW_CHARS)))
    return F.when(n <= WINDOWS * WINDOW_CHARS, F.col(text)).otherwise(F.array_join(places, " "))


def _train(model: Crf, got, counts: np.ndarray, batches: int, length: int, seed: int) -> None:
    k, rng, totals = len(model.langs), np.random.default_rng(seed), counts.sum(axis=0)
    affix, word, grams, sizes, spans, at = [], [], [], [], [[] for _ in range(k)], 0
    code = {x: j for j, x in enumerate(model.langs)}
    ys = [code[x] for x in got["lang"].to_pylist()]
    for lo, hi, w in word_batches(lower(got["text"]), NOT_LETTER):
        f = Features(w)
        affix.append(f.affix.astype(np.uint16))
        word.append(f.word.astype(np.int32))
        lens = f.end - f.start
        take = np.repeat(f.start - np.r_[0, np.cumsum(lens)[:-1]], lens) + np.arange(int(lens.sum()))
        grams.append(f.gram[take].astype(np.uint16))
        sizes.append(lens)
        for d in range(hi - lo):
            if w.count[d]:
                spans[ys[lo + d]].append((at + int(w.first[d]), int(w.count[d])))
        at += len(w)
    used = [j for j in range(k) if spans[j]]
    if not used:
        return
    affix, word, grams = np.concatenate(affix), np.concatenate(word), np.concatenate(grams)
    gram_at = np.r_[0, np.cumsum(np.concatenate(sizes))]

    def sequence() -> tuple[np.ndarray, np.ndarray]:
        idx, y = [], []
        lang = int(rng.choice(used))
        mixed = rng.random() < 0.4
        while len(idx) < length:
            s, n = spans[lang][rng.integers(len(spans[lang]))]
            size = min(n, int(rng.integers(6, 33)) if mixed else length, length - len(idx))
            lo = s + int(rng.integers(0, n - size + 1))
            idx.extend(range(lo, lo + size))
            y.extend([lang] * size)
            if mixed:
                lang = int(rng.choice(used))
        return np.array(idx), np.array(y)

    state = {name: np.full_like(getattr(model, name), 1e-6, dtype=np.float64) for name in ("affix", "gram", "scale", "bias", "transition")}

    def step(name: str, grad: np.ndarray, rate: float) -> None:  # Adagrad, a small pull to nought
        value = getattr(model, name)
        grad = grad + 1e-6 * value
        state[name] += grad * grad
        value -= (rate * grad / np.sqrt(state[name])).astype(value.dtype)

    for _ in range(batches):
        pairs = [sequence() for _ in range(48)]
        idx, y = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        own = counts[word[idx]].copy()
        own[np.arange(len(y)), y] -= 1  # what the lexicon would say without this document
        lex = _rates(np.maximum(own, 0), totals)
        n_grams = gram_at[idx + 1] - gram_at[idx]
        take = np.repeat(gram_at[idx] - np.r_[0, np.cumsum(n_grams)[:-1]], n_grams) + np.arange(int(n_grams.sum()))
        g, owner = grams[take], np.repeat(np.arange(len(idx)), n_grams)
        em = model.affix[affix[idx]].sum(axis=1) + lex * model.scale + model.bias
        em = em + np.add.reduceat(model.gram[g], np.cumsum(n_grams) - n_grams, axis=0)
        node, pair = pair_expectations(em.astype(np.float64), model.transition, length)
        node[np.arange(len(y)), y] -= 1
        node /= len(y)
        yy = y.reshape(-1, length)
        seen = np.zeros((k, k))
        np.add.at(seen, (yy[:, :-1].ravel(), yy[:, 1:].ravel()), 1)
        ga, gg = np.empty((AFFIX, k)), np.empty((GRAMS, k))
        flat = affix[idx].ravel()
        for j in range(k):
            ga[:, j] = np.bincount(flat, np.repeat(node[:, j], 6), AFFIX)
            gg[:, j] = np.bincount(g, node[owner, j], GRAMS)
        step("affix", ga, 0.1)
        step("gram", gg, 0.05)
        step("scale", (node * lex).sum(axis=0), 0.02)
        step("bias", node.sum(axis=0), 0.02)
        step("transition", (pair - seen) / len(y), 0.05)


class Labels:
    """Per text of a batch: language, mean probability, runs of words."""

    def __init__(self, model: Crf, column: pa.Array, runs: bool = True):
        raw, texts, k = texts_of(column), lower(column), len(model.langs)
        n = len(texts)
        self.lang, self.score, self.runs = [NONE] * n, np.zeros(n), [[] for _ in range(n)]
        if not k:
            return
        for lo, hi, w in word_batches(texts, NOT_LETTER):
            p = marginals(model.emissions(Features(w)), w.count, model.transition)
            mean = np.stack([np.bincount(w.doc, p[:, j], hi - lo) for j in range(k)], 1) / np.maximum(w.count, 1)[:, None]
            best = mean.argmax(axis=1)
            ascii_letter = ~NOT_LETTER.copy()
            ascii_letter[128:] = False
            letters = np.add.reduceat(np.r_[ascii_letter[w.data], False].astype(np.int64), w.offsets[:-1]) * (np.diff(w.offsets) > 0)
            for d in range(hi - lo):
                if w.count[d] and (letters[d] or has_letter(raw[lo + d].as_py())):
                    self.lang[lo + d], self.score[lo + d] = model.langs[best[d]], mean[d, best[d]]
            if runs and len(w):
                label = p.argmax(axis=1)
                cut = np.r_[True, (label[1:] != label[:-1]) | (w.doc[1:] != w.doc[:-1])]
                s = np.flatnonzero(cut)
                e = np.r_[s[1:], len(w)] - 1
                for d, a, b, j in zip(w.doc[s].tolist(), w.start[s].tolist(), w.end[e].tolist(), label[s].tolist()):
                    base = int(w.offsets[d])
                    self.runs[lo + d].append({"start": a - base, "end": b - base, "lang": model.langs[j]})


def identify(docs: DataFrame, model: Crf, runs: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, lang_pred, score, runs)``, a row
    per row.  ``lang_pred`` is the language with the largest mean posterior
    over the words and ``score`` that mean; ``und`` with score 0 where the text
    is null, empty or has no letter, or nothing was learned.  ``runs`` lists
    stretches of words of one language (bytes of the lower-cased text)."""
    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed-size tables per language
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = Labels(shared.value, batch.column(1), runs)
            yield pa.record_batch([batch.column(0), pa.array(got.lang, pa.string()), pa.array(got.score),
                                   pa.array(got.runs, pa.list_(item))], names=["doc_id", "lang_pred", "score", "runs"])

    return map_arrow(src, run, f"doc_id {kind}, lang_pred string, score double, "
                               "runs array<struct<start:bigint,end:bigint,lang:string>>")


def keep_identified(docs: DataFrame, model: Crf, threshold: float = 0.5) -> DataFrame:
    """``docs`` (all its columns) without texts that have no language or whose
    best one stays below ``threshold``."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = Labels(shared.value, batch.column(at), runs=False)
            good = (got.score >= threshold) & np.array([x != NONE for x in got.lang], bool)
            yield batch.filter(pa.array(good))

    return map_arrow(docs, run, docs.schema)
