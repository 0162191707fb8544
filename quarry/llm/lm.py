"""Language-model scoring with a causal self-attention model (operator 4).

Texts are words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) and one end.  The
model works on subword ids of the words joined by blanks.  The probability of
an id is that of its group, predicted by the model, times that of the id in
its group after the id before, from counts.  Group logits add up the log
bigram rate and one layer of causal self-attention, trained with
hand-written gradients: first on a bounded sample by one task, then from
there by every task of a pass over a fixed share of all training documents,
whose weights are averaged; so what is learned grows with the corpus.

Ids that begin a word have groups of their own, so the model also gives the
probability that a word ends, and with it that of each whole word.  A word's
probability is a mixture of that, of the word's share in the corpus and of its
share among the words before it in its text (a copy head: uniform causal
attention over whole words).  The weights depend on how many words are before.

Texts are scored in windows of two blocks with a stride of one: each id is
scored once, in the later block of its window, with at least a block of
context; a batch of windows is one masked attention.

Both scores need every word's count over all training documents.  The
commonest words (a bounded table) are scored in the task that reads the text;
the others are joined, with the model's log probability, to the counted
vocabulary."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.byte_bpe import byte_bpe
from quarry.llm.common import collected, fold, map_arrow, shuffle_partitions, stable, texts_of
from quarry.llm.onnx_graph import Graph, session
from quarry.llm.word_batch import Words, mix, stable_order, word_batches

IDS, PREV, GROUPS, DIM, BLOCK = 4096, 1024, 64, 16, 16
STARTS = GROUPS // 2  # groups 0 .. STARTS - 1 hold the ids that begin a word; 0 is the end alone
END_KEY = 0x656E64  # the vocabulary key of the end
HEAD = 1 << 18
SLICE = 1 << 18  # bytes of text at a time: their arrays stay in the processor's cache
SCORE_STEPS = 1 << 40
RATIO_STEPS, NO_SHARE = 8, 1 << 20  # log ratios are counted in steps; that of words without a share
DEPTHS = 12  # weights of the mixture, by the logarithm of the number of words before


class Vocabulary:
    """Subword ids -> 0 (end), 1 .. IDS-3 (by frequency), IDS-2 (any other id
    inside a word), IDS-1 (any other id that begins one)."""

    def __init__(self, path: str, counts: np.ndarray):
        self.path = path
        begins = byte_bpe(path).begins
        top = np.argsort(-counts, kind="stable")[:IDS - 3]
        top = top[counts[top] > 0]
        self.number = np.where(begins, IDS - 1, IDS - 2).astype(np.int32)
        self.number[top] = np.arange(1, len(top) + 1)
        self.begins = np.zeros(IDS, bool)
        self.begins[1:len(top) + 1] = begins[top]
        self.begins[[0, IDS - 1]] = True
        self.others = np.bincount(self.number, minlength=IDS)[IDS - 2:]  # how many ids the last two stand for

    @staticmethod
    def distinct_ids(path: str, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Subword ids of the different words of the batch, where each word's
        begin, and which of them each word is."""
        return word_ids(path).of(w)

    def encode(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words' ids in order, and how many each word has."""
        if not len(w):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        ids, begin, which = self.distinct_ids(self.path, w)
        size = np.diff(np.r_[begin, len(ids)])
        per, at = size[which], begin[which]
        take = np.repeat(at - (np.cumsum(per) - per), per) + np.arange(int(per.sum()))
        return self.number[ids][take], per


class WordIds:
    """Ids of words in lower case, each tokenized behind a blank and kept for
    the batches to come: a bounded table, begun anew when it is full.

    Words are tokenized together.  The tokenizer joins two of them only over
    white space that is no separator here (such as U+00A0); words with such
    characters are tokenized one by one."""

    OTHER_SPACE = re.compile(r"[\s\x1c-\x1f\x85\u180e\u200b\ufeff]").search
    MOST, RECENT = 1_000_000, 100_000

    def __init__(self, path: str):
        self.path = path
        self.clear()

    def clear(self) -> None:
        """No words: one sorted table of all, and one of the most recent."""
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))] * 2  # key, start, size
        self.ids = np.zeros(1 << 20, np.uint32)
        self.filled = 0

    def keep(self, more: np.ndarray) -> int:
        """Append ids; where they begin."""
        at, self.filled = self.filled, self.filled + len(more)
        if self.filled > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(more)), np.uint32)])
        self.ids[at:self.filled] = more
        return at

    def tokenize(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in order, and how many each has."""
        bpe = byte_bpe(self.path)
        odd = [bool(self.OTHER_SPACE(x)) for x in words] if self.OTHER_SPACE("".join(words)) else [False] * len(words)
        ids = bpe("".join(" " + x for x, o in zip(words, odd) if not o))
        begin = np.flatnonzero(bpe.begins[ids])
        if any(odd):
            parts = iter(np.split(ids, begin[1:]))
            each = [bpe(" " + x) if o else next(parts) for x, o in zip(words, odd)]
            return np.concatenate(each), np.array([len(e) for e in each])
        return ids, np.diff(np.r_[begin, len(ids)])

    def of(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """See :meth:`Vocabulary.distinct_ids`."""
        keys, first, which = w.distinct()
        start, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        known = np.zeros(len(keys), bool)
        for of, begin, length in self.tables:
            if len(of):
                place = np.minimum(np.searchsorted(of, keys), len(of) - 1)
                hit = of[place] == keys
                known |= hit
                start[hit], size[hit] = begin[place[hit]], length[place[hit]]
        new = np.flatnonzero(~known)
        if len(new):
            data = w.lower.tobytes()
            more, size[new] = self.tokenize([data[a:b].decode() for a, b in zip(w.start[first[new]].tolist(), w.end[first[new]].tolist())])
            start[new] = self.keep(more) + np.cumsum(size[new]) - size[new]
        begin = np.cumsum(size) - size
        ids = self.ids[np.repeat(start - begin, size) + np.arange(int(size.sum()))]
        if len(new):
            self.tables[1] = _merged(self.tables[1], (keys[new], start[new], size[new]))
            if len(self.tables[1][0]) > self.RECENT:
                self.tables = [_merged(*self.tables), self.tables[1]]
                self.tables[1] = tuple(c[:0] for c in self.tables[1])
            if len(self.tables[0][0]) > self.MOST:
                self.clear()
        return ids, begin, which


def _merged(a: tuple, b: tuple) -> tuple:
    both = [np.concatenate(c) for c in zip(a, b)]
    order = np.argsort(both[0], kind="stable")
    return tuple(c[order] for c in both)


_word_ids: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's table for the vocabulary at ``path``."""
    if path not in _word_ids:
        _word_ids[path] = WordIds(path)
    return _word_ids[path]


class Stream(NamedTuple):
    """Texts as inputs and targets: a text of n ids has inputs end, 1 .. n and
    targets 1 .. n, end.  Every text begins a block, so its windows and scores
    don't depend on the texts around it; ``valid`` leaves out the padding."""

    x: np.ndarray
    y: np.ndarray
    valid: np.ndarray
    opens: np.ndarray  # per block: whether a text begins there


def stream(vocabulary: Vocabulary, w: Words) -> Stream:
    numbers, per = vocabulary.encode(w)
    size = np.bincount(w.doc, per, len(w.count)).astype(np.int64) + 1
    blocks = -(-size // BLOCK)
    first = (np.cumsum(blocks) - blocks) * BLOCK
    place = np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)
    n = int(blocks.sum()) * BLOCK
    valid, opens = np.zeros(n, bool), np.zeros(n // BLOCK, bool)
    valid[place], opens[first // BLOCK] = True, True
    inside = np.ones(len(place), bool)
    inside[np.cumsum(size) - size] = False
    x, y = np.zeros(n, np.int32), np.zeros(n, np.int32)
    x[place[inside]] = numbers
    y[place[:-1]] = x[place[1:]]  # the next text starts with the end: it is this one's last target
    return Stream(x, y, valid, opens)


#: For queries and keys of a window: their distance, and which bias they have (the last: none); see Attention.biases.
DISTANCES = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :]
BIASES = np.stack([np.where(DISTANCES < 0, 2 * BLOCK, DISTANCES)] * 2)
BIASES[1, :, :BLOCK] = 2 * BLOCK


class Attention:
    """One causal head over the last BLOCK .. 2 BLOCK - 1 inputs, with a
    learned bias per distance; its mean of values shifts the group logits.
    The sums over windows are graphs that onnxruntime runs in one thread."""

    NAMES = ("embed", "query", "key", "value", "out", "distance")

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.embed = rng.standard_normal((IDS, DIM)).astype(np.float32) * np.float32(0.5)
        self.query, self.key, self.value = init(DIM, DIM), init(DIM, DIM), init(DIM, DIM)
        self.out = init(DIM, GROUPS) * np.float32(0.1)
        self.distance = -0.05 * np.arange(2 * BLOCK, dtype=np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> "Attention":
        at = 0
        for n in self.NAMES:
            v = getattr(self, n)
            setattr(self, n, flat[at:at + v.size].reshape(v.shape).astype(np.float32))
            at += v.size
        return self

    def bias(self) -> np.ndarray:
        """[BLOCK, 2 BLOCK]: distance bias, minus infinity ahead of the query."""
        return self.biases()[0]

    def biases(self) -> np.ndarray:
        """[2, BLOCK, 2 BLOCK]: as :meth:`bias`; minus infinity also before a
        text that begins with the later block."""
        return np.append(self.distance, np.float32(-1e9))[BIASES]


def windows(texts: Stream) -> np.ndarray:
    """[blocks, 2 BLOCK]: the ids of each block behind those of the block before."""
    x = texts.x.reshape(-1, BLOCK)
    both = np.zeros((len(x), 2 * BLOCK), np.int32)
    both[:, BLOCK:], both[1:, :BLOCK] = x, x[:-1]
    return both


def _group_logits(g: Graph, q: str, k: str, v: str) -> tuple[str, str, str]:
    """Shares of the keys, the means of their values, and the group logits."""
    s = g.node("Add", g.product(q, k, transB=1), g.node("Gather", g.input("bias", "float32", 3), g.input("opens", "int32", 1)))
    p = g.node("Softmax", s, axis=-1)
    o = g.product(p, v)
    before = g.node("Gather", g.input("base", "float32", 2), g.input("prev", "int32", 2))
    return p, o, g.node("Add", g.product(o, g.input("out", "float32", 2)), before)


@cache
def scorer():
    """Of windows and the tables of projected ids: the group logits [n, BLOCK,
    GROUPS], and the sums of their exponentials: all, and those that begin words."""
    g = Graph()
    both, now = g.input("both", "int32", 2), g.input("now", "int32", 2)
    q, k, v = (g.node("Gather", g.input(name, "float32", 2), at) for name, at in (("q", now), ("k", both), ("v", both)))
    logits = _group_logits(g, q, k, v)[2]
    g.output(logits, "float32", 3)
    sums = np.zeros((GROUPS, 2), np.float32)
    sums[:, 0] = sums[:STARTS, 1] = 1
    g.output(g.product(g.node("Exp", logits), g.constant(sums)), "float32", 3)
    return session(g.model())


@cache
def learner():
    """Of windows, their targets' groups and the weight of each position: the
    gradients by the windows' ids (as keys and values [n, 2 BLOCK, DIM], and as
    queries [n, BLOCK, DIM]), by key and value side by side, query, out, and by
    the bias [BLOCK, 2 BLOCK]."""
    g = Graph()
    embed, both, now = g.input("embed", "float32", 2), g.input("both", "int32", 2), g.input("now", "int32", 2)
    query, key, value = (g.input(name, "float32", 2) for name in ("query", "key", "value"))
    e, mine = g.node("Gather", embed, both), g.node("Gather", embed, now)
    q, k, v = g.product(mine, query), g.product(e, key), g.product(e, value)
    p, o, logits = _group_logits(g, q, k, v)
    hit = g.node("Gather", g.constant(np.eye(GROUPS, dtype=np.float32)), g.input("target", "int32", 2))
    dl, share = g.node("Sub", g.node("Softmax", logits, axis=-1), hit), g.input("share", "float32", 3)
    do = g.node("Mul", g.product(dl, "out", transB=1), share)
    dot = g.node("ReduceSum", g.node("Mul", do, o), g.constant(np.array([2])), keepdims=1)  # as much as sum(p * ds): o is p @ v
    ds = g.node("Mul", g.node("Sub", g.product(do, v, transB=1), dot), p)
    dq, dkv = g.product(ds, k), g.node("Concat", g.product(ds, q, transA=1), g.product(p, do, transA=1), axis=2)
    g.output(g.product(dkv, g.node("Concat", key, value, axis=1), transB=1), "float32", 3)
    g.output(g.product(dq, query, transB=1), "float32", 3)
    rows = lambda v, n: g.node("Reshape", v, g.constant(np.array([-1, n])))
    for a, b, n in ((e, dkv, 2 * DIM), (mine, dq, DIM), (g.node("Mul", o, share), dl, GROUPS)):
        g.output(g.product(rows(a, DIM), rows(b, n), transA=1), "float32", 2)
    g.output(g.node("ReduceSum", ds, g.constant(np.array([0])), keepdims=0), "float32", 2)
    return session(g.model())


class Model:
    def __init__(self, vocabulary: Vocabulary, group: np.ndarray, base: np.ndarray, inner: np.ndarray, net: Attention):
        self.vocabulary, self.group, self.net = vocabulary, group, net
        self.base, self.inner = base.astype(np.float32), inner.astype(np.float32)

    def log_probs(self, texts: Stream, step: int = 128) -> tuple[np.ndarray, np.ndarray]:
        """For each position: natural log probability of the target, and of
        any id that begins a word (or the end).  Equal texts have equal results
        wherever they stand."""
        both, x, y = windows(texts), texts.x.reshape(-1, BLOCK), texts.y
        net, opens = self.net, texts.opens.astype(np.int32)
        tables = {"q": (net.embed @ net.query) * np.float32(1 / np.sqrt(DIM)), "k": net.embed @ net.key, "v": net.embed @ net.value,
                  "bias": net.biases(), "base": self.base, "out": net.out}
        out, word_next, row = np.empty(x.size, np.float32), np.empty(x.size, np.float32), np.arange(step * BLOCK) * GROUPS
        for lo in range(0, len(x), step):
            now = x[lo:lo + step]
            part = slice(lo * BLOCK, lo * BLOCK + now.size)
            prev, target = np.minimum(now, PREV - 1), y[part]
            logits, norm = scorer().run(None, tables | {"both": both[lo:lo + step], "now": now, "prev": prev, "opens": opens[lo:lo + step]})
            logs = np.log(norm).reshape(-1, 2)
            out[part] = logits.reshape(-1)[row[:now.size] + self.group[target]] - logs[:, 0] + self.inner[prev.ravel(), target]
            word_next[part] = logs[:, 1] - logs[:, 0]
        return out.astype(float), word_next.astype(float)

    def word_log_probs(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probability of every word, ends included, given what is
        before it, and the text each belongs to."""
        texts = stream(self.vocabulary, w)
        lp, word_next = (v[texts.valid] for v in self.log_probs(texts))
        y = texts.y[texts.valid]
        start = np.flatnonzero(self.vocabulary.begins[y])  # targets that begin a word; ends too
        total = np.add.reduceat(lp, start)
        after = np.zeros(len(start))
        after[:-1] = word_next[start[1:]]
        end = y[start] == 0
        after[end] = 0.0  # nothing follows an end
        return total - word_next[start] + after, np.cumsum(end) - end


def train(net: Attention, base: np.ndarray, group: np.ndarray, texts: Stream, every: int = 1, batch: int = 64,
          rate: float = 0.02, seed: int = 2, most: int | None = None) -> int:
    """Adagrad on windows (one of ``every``, at most ``most`` batches); the
    number of ids seen."""
    x, y, valid, opens = texts
    blocks = len(opens)
    if not blocks:
        return 0
    both, y, valid = windows(texts), y.reshape(-1, BLOCK), valid.reshape(-1, BLOCK)
    chosen = np.random.default_rng(seed).permutation(blocks)[: max(1, blocks // every)]
    if most:
        chosen = chosen[:most * batch]
    state = {name: np.full(getattr(net, name).shape, 1e-4, np.float32) for name in net.NAMES}
    distance, scale = np.maximum(DISTANCES, 0).ravel(), np.float32(1 / np.sqrt(DIM))
    targets, opens, valid = group.astype(np.int32)[y], opens.astype(np.int32), valid[:, :, None].astype(np.float32)
    met, slot, pairs = np.zeros(IDS, bool), np.zeros(IDS, np.int32), np.arange(IDS * DIM // 2).reshape(IDS, DIM // 2)
    for lo in range(0, len(chosen), batch):
        at = chosen[lo:lo + batch]
        ids = both[at]
        now = ids[:, BLOCK:].copy()
        de, mine, key_value, query, out, ds = learner().run(None, {
            "embed": net.embed, "both": ids, "now": now, "prev": np.minimum(now, PREV - 1), "opens": opens[at], "target": targets[at],
            "share": valid[at] / np.float32(now.size), "bias": net.biases(), "base": base, "query": net.query * scale, "key": net.key,
            "value": net.value, "out": net.out})
        de[:, BLOCK:] += mine
        met[ids] = True  # ids that aren't in the batch have no gradient
        some = np.flatnonzero(met)
        met[some], slot[some] = False, np.arange(len(some))
        g = np.zeros((len(some), DIM), np.float32)  # added up two numbers at a time, as the parts of a complex one
        np.add.at(g.view(np.complex64).reshape(-1), pairs[slot[ids]].ravel(), de.reshape(-1).view(np.complex64))
        squares = state["embed"][some] + g * g
        state["embed"][some] = squares
        net.embed[some] -= np.float32(rate) * g / np.sqrt(squares)
        grads = {"out": out, "query": query * scale, "key": key_value[:, :DIM], "value": key_value[:, DIM:],
                 "distance": np.bincount(distance, ds.ravel(), 2 * BLOCK).astype(np.float32)}
        for name, g in grads.items():
            state[name] += g * g
            getattr(net, name)[...] -= np.float32(rate) * g / np.sqrt(state[name])
    return len(chosen) * BLOCK


def group_ids(bigrams: np.ndarray, begins: np.ndarray, rounds: int = 12, seed: int = 4) -> np.ndarray:
    """Group of each id by k-means over what stands before it, apart for ids
    that begin a word and others; the end has group 0.  ``bigrams`` [PREV, IDS]
    counts -> [IDS]."""
    total = bigrams.sum(axis=0)
    x = bigrams[:256] + np.float32(1e-3)
    x = np.sqrt(x / x.sum(axis=0)).T  # rows of unit length
    rng, out = np.random.default_rng(seed), np.zeros(IDS, np.int64)
    for members, lo, hi in ((np.flatnonzero(begins[1:]) + 1, 1, STARTS), (np.flatnonzero(~begins), STARTS, GROUPS)):
        xs, w = x[members], np.sqrt(total[members] + 1)
        common = np.argsort(-total[members], kind="stable")[:hi - lo]
        centre = xs[common] + 1e-6 * rng.standard_normal((len(common), xs.shape[1]))
        for _ in range(rounds):
            own = (xs @ centre.T).argmax(axis=1)
            sums = np.zeros_like(centre)
            np.add.at(sums, own, xs * w[:, None])
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            centre = np.where(norm > 0, sums / np.maximum(norm, 1e-12), centre)
        out[members] = (xs @ centre.T).argmax(axis=1) + lo
    return out


def tables(bigrams: np.ndarray, group: np.ndarray, others: np.ndarray, pull: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """Log rates of groups after an id [PREV, GROUPS] and of an id in its
    group after an id [PREV, IDS], both drawn towards the unigram rates.  The
    last two ids stand for ``others`` equally likely ones."""
    uni = bigrams.sum(axis=0, dtype=float) + 0.5
    in_group = np.bincount(group, uni, GROUPS)
    alone = uni / in_group[group]
    by_group = np.zeros((len(bigrams), GROUPS))
    for g in range(GROUPS):
        by_group[:, g] = bigrams[:, group == g].sum(axis=1)
    rate = (in_group + 1e-3) / (in_group + 1e-3).sum()
    base = np.log((by_group + pull * rate) / (by_group.sum(axis=1, keepdims=True) + pull))
    inner = bigrams + (pull * alone).astype(np.float32)
    inner /= (by_group + pull).astype(np.float32)[:, group]
    np.log(inner, out=inner)
    inner[:, -2:] -= np.log(np.maximum(others, 1)).astype(np.float32)
    return base, inner


def with_ends(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all words in order, each text's end behind its last word, and
    the text of each."""
    size = w.count + 1
    keys = np.empty(int(size.sum()), np.int64)
    end = np.zeros(len(keys), bool)
    end[np.cumsum(size) - 1] = True
    keys[end], keys[~end] = END_KEY, word_keys(w)
    return keys, np.repeat(np.arange(n), size)


def word_keys(w: Words) -> np.ndarray:
    return w.hashes().view(np.int64)


def _words(texts: list[str]) -> Words:
    return Words(pa.array(texts, pa.large_string()))


def _bigrams(vocabulary: Vocabulary, w: Words) -> np.ndarray:
    """Places in a table [PREV * IDS] of each id after the id before; an end
    stands before and behind every text."""
    numbers, per = vocabulary.encode(w)
    ends = np.cumsum(np.bincount(w.doc, per, len(w.count)).astype(np.int64) + 1)
    ids = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
    inside = np.ones(len(ids), bool)
    inside[0] = inside[ends] = False
    ids[inside] = numbers
    return np.minimum(ids[:-1], PREV - 1) * IDS + ids[1:]


def count_ids(docs: DataFrame, tokenizer: str) -> np.ndarray:
    """How often each subword id occurs in all ``docs(text)``."""
    size = byte_bpe(tokenizer).size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for _, _, w in word_batches(texts_of(batch.column(0)), limit=SLICE):
                if len(w):
                    ids, begin, which = Vocabulary.distinct_ids(tokenizer, w)
                    times = np.repeat(np.bincount(which, minlength=len(begin)), np.diff(np.r_[begin, len(ids)]))
                    counts += np.bincount(ids, times, size).astype(np.int64)
        found = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array(counts[found])], names=["id", "n"])

    i, n = collected(map_arrow(docs.select("text"), run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")))
    counts = np.zeros(size, np.int64)
    counts[i] = n  # at most a row for each id of the tokenizer
    return counts


def count_corpus(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(kind, key, n)`` over all ``docs(text)``: word counts (kind 0) with
    the end under END_KEY, and subword bigram counts (kind 1).  Tasks add up
    first."""
    names = ["kind", "key", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, held, ends = [], [], 0, 0
        bigrams = np.zeros(PREV * IDS, np.int64)

        def rows(kind: int, k: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(k), 50_000):
                part = slice(at, at + 50_000)
                yield pa.record_batch([pa.array(np.full(len(k[part]), kind, np.int32)), pa.array(k[part]), pa.array(n[part])], names=names)

        def flush() -> Iterator[pa.RecordBatch]:
            if keys:
                k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
                yield from rows(0, k, np.bincount(inverse, np.concatenate(sums)).astype(np.int64))

        for batch in batches:
            for lo, hi, w in word_batches(texts_of(batch.column(0)), limit=SLICE):
                k, _, which = w.distinct()
                keys.append(k.view(np.int64))
                sums.append(np.bincount(which, minlength=len(k)))
                held += len(k)
                ends += hi - lo
                np.add.at(bigrams, _bigrams(vocabulary, w), 1)
                if held > 2_000_000:  # bounded memory however many words a task meets
                    yield from flush()
                    keys, sums, held = [], [], 0
        if ends:
            keys.append(np.array([END_KEY]))
            sums.append(np.array([ends]))
        yield from flush()
        k = np.flatnonzero(bigrams)
        yield from rows(1, k, bigrams[k])

    return map_arrow(docs.select("text"), run, "kind int, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def warmed(texts: DataFrame, base: np.ndarray, group: np.ndarray, vocabulary: Vocabulary) -> Attention | None:
    """Weights learned from scratch by one task from a bounded number of
    ``texts(text)`` in their order; None if there are none."""
    shared = texts.sparkSession.sparkContext.broadcast((base.astype(np.float32), group, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [text for batch in batches for text in texts_of(batch.column(0)).to_pylist()]
        if held:
            (b, g, vocab), net = shared.value, Attention()
            encoded = stream(vocab, _words(held))
            per_epoch = max(1, min(1200, len(encoded.opens) // 64))
            epochs = min(8, -(-2400 // per_epoch))  # a small sample is gone over more often
            for epoch in range(epochs):
                train(net, b, g, encoded, rate=0.03 / (epoch + 1), seed=epoch, most=1200)
            yield pa.record_batch([pa.array(net.flat())], names=["x"])

    flat, = collected(map_arrow(texts, run, "x float"))  # as many as there are weights
    return Attention().load(flat) if len(flat) else None


SHARD_DOCS = 2000  # documents that one task trains on, at any size of the corpus
WEIGHT_STEPS = 1 << 22  # weights are added up as whole numbers of steps, so their order doesn't matter


def refine(net: Attention, base: np.ndarray, group: np.ndarray, vocabulary: Vocabulary, docs: DataFrame) -> Attention:
    """Average of the weights that passes over all windows of the shards of
    ``docs(doc_id, text)`` reach from ``net``, by the ids each has seen.  Shards
    are dealt by a hash of the row and sorted, so the layout of the table
    doesn't matter."""
    shared = docs.sparkSession.sparkContext.broadcast((net.flat(), base.astype(np.float32), group, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, b, g, vocab = shared.value
        mine, seen, shard, held, size = Attention(), 0, None, [], 0

        def learn() -> None:
            nonlocal seen, held, size
            if held:
                seen += train(mine, b, g, stream(vocab, _words(held)), rate=0.005)
            held, size = [], 0

        def done() -> Iterator[pa.RecordBatch]:
            learn()
            if seen:
                steps = np.rint(mine.flat().astype(float) * WEIGHT_STEPS).astype(np.int64) * seen
                yield pa.record_batch([pa.array([seen]), pa.array([steps], pa.list_(pa.int64()))], names=["seen", "flat"])

        for batch in batches:
            for s, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)).to_pylist()):
                if s != shard:
                    yield from done()
                    shard, seen = s, 0
                    mine.load(flat)
                held.append(text)
                size += len(text)
                if size > 1 << 20:  # as many texts at a time wherever batches end
                    learn()
        yield from done()

    shards = -(-docs.count() // SHARD_DOCS)
    if not shards:
        return net
    row = F.xxhash64(F.lit(59), "doc_id", "text")
    dealt = docs.select(F.pmod(row, F.lit(shards)).cast("int").alias("shard"), "text", row.alias("row")).repartition(
        min(shards, shuffle_partitions(docs)), "shard").sortWithinPartitions("shard", "row", "text")
    got = map_arrow(dealt.select("shard", "text"), run, "seen bigint, flat array<bigint>")
    # weights are added up by position, so no task holds more than one copy of them for each it reads
    total = got.select("seen", F.posexplode("flat").alias("i", "x")).groupBy("i").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("seen").alias("seen")).select(
        "i", (F.col("x").cast("double") / F.col("seen") / WEIGHT_STEPS).alias("x"))
    i, x = collected(total)
    if not len(i):
        return net
    flat = net.flat()
    flat[i] = x
    return Attention().load(flat)


class Trained:
    """The model, the common words' counts, the corpus totals, and the weights
    of the mixture."""

    def __init__(self, model: Model, keys: np.ndarray, counts: np.ndarray, tokens: int, types: int):
        order = np.argsort(keys)
        self.model, self.keys, self.counts = model, keys[order], counts[order]
        self.tokens, self.types = tokens, types
        self.weights = np.full((DEPTHS, 3), 1 / 3)  # by depth: corpus share, model, copy share

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word key in the table of common words, and whether it
        is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def without_share(self, model_log: np.ndarray, copies: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Probabilities of the mixture's parts but the corpus share."""
        w = self.weights[depth]
        return w[:, 1] * np.exp(model_log) + w[:, 2] * copies

    def tune(self, depth: np.ndarray, share: np.ndarray, copies: np.ndarray, n: np.ndarray, rounds: int = 60) -> None:
        """The weights by expectation maximization over ``n`` words of a depth
        whose corpus share and copy share stand ``share`` and ``copies`` steps
        under the model's probability; see :func:`ratios`."""
        if not n.sum():
            return
        order = np.lexsort((copies, share, depth))  # rows come in any order; sums of floats must not
        depth, share, copies, n = depth[order], share[order], copies[order], n[order]
        over = lambda steps: np.where(steps == NO_SHARE, 0, np.exp(np.clip(-steps / RATIO_STEPS, -300, 300)))
        odds = np.stack([over(share), np.ones(len(n)), over(copies)], axis=1)
        for _ in range(rounds):
            own = self.weights[depth] * odds
            own *= (n / own.sum(axis=1))[:, None]
            total = np.stack([np.bincount(depth, own[:, j], DEPTHS) for j in range(3)], axis=1) + 0.01 * own.sum(axis=0) / n.sum()
            self.weights = np.maximum(total / total.sum(axis=1, keepdims=True), 1e-4)
            self.weights /= self.weights.sum(axis=1, keepdims=True)

    def log10_rate(self, count):
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def drawn(docs: DataFrame, seed: int, rate: float) -> DataFrame:
    """About ``rate`` of the rows of ``docs(doc_id, text)`` by a hash of the
    row: copies of a text under different ids are drawn one by one."""
    dice = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 20))
    return docs.filter(dice < F.lit(round(rate * (1 << 20))))


def copy_shares(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word in order: its share among the words before it in its text,
    and the depth that their number falls in."""
    n = len(keys)
    both = mix(keys.view(np.uint64) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))  # keys are hashes too
    order = stable_order(both)
    place = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = both[order[1:]] != both[order[:-1]]
    times = np.empty(n, np.int64)
    times[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    opens = np.ones(n, bool)
    opens[1:] = doc[1:] != doc[:-1]
    before = place - np.maximum.accumulate(np.where(opens, place, 0))
    return times / np.maximum(before, 1), np.minimum(np.log2(before + 1), DEPTHS - 1).astype(np.int64)


def cell_counts(depth: np.ndarray, share: np.ndarray, copies: np.ndarray,
                times: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The different cells ``(depth, share, copies)`` and how often each occurs
    (each given one ``times``, or once), a cell packed into one whole number.  Steps of 2^28 and more, of words of
    megabytes, stop there: shares that far apart weigh as nothing."""
    half = 1 << 28
    share, copies = (np.clip(v, 1 - half, half - 1).astype(np.int64) + half for v in (share, copies))
    packed = (depth.astype(np.int64) << 58) + (share << 29) + copies
    if times is None:
        packed, n = np.unique(packed, return_counts=True)
    else:
        order = np.argsort(packed)
        packed, first = np.unique(packed[order], return_index=True)
        n = np.add.reduceat(times[order], first)
    low = (1 << 29) - 1
    return [packed >> 58, (packed >> 29 & low) - half, (packed & low) - half], n


def ratios(docs: DataFrame, trained: Trained, words: DataFrame) -> DataFrame:
    """``(depth, share, copies, n)``: how many words of ``docs(text)`` at a depth
    have their corpus share and copy share how many steps under the model's
    probability, the corpus share taken without the occurrence at hand.  Whole
    texts; rare words meet the counted vocabulary.  The steps bound the rows."""
    shared = docs.sparkSession.sparkContext.broadcast(trained)
    names = ["depth", "share", "copies", "key", "log", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        held, size = [], 0  # cells and how often they occur, so far

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                cells, n = cell_counts(*(np.concatenate(c) for c in zip(*held)))
                for lo in range(0, len(n), 50_000):
                    *part, times = (pa.array(c[lo:lo + 50_000].astype(kind)) for c, kind in zip((*cells, n), (np.int32, np.int32, np.int32, np.int64)))
                    yield pa.record_batch([*part, pa.nulls(len(times), pa.int64()), pa.nulls(len(times), pa.int32()), times], names=names)

        def under(logs: np.ndarray, share: np.ndarray) -> np.ndarray:
            steps = np.full(len(logs), NO_SHARE, np.int32)
            some = share > 0
            steps[some] = np.rint((logs[some] - np.log(share[some])) * RATIO_STEPS)
            return steps

        for batch in batches:
            for lo, hi, w in word_batches(texts_of(batch.column(0)), limit=SLICE):
                keys, doc = with_ends(w, hi - lo)
                logs = t.model.word_log_probs(w)[0]
                again, depth = copy_shares(keys, doc)
                copies = under(logs, again)
                at, found = t.find(keys)
                share = under(logs[found], (t.counts[at[found]] - 1) / max(t.tokens, 1))
                cells, n = cell_counts(depth[found], share, copies[found])
                held.append((*cells, n))
                size += len(n)
                if size > 1_000_000:  # bounded memory however many cells a task meets
                    yield from flush()
                    held, size = [], 0
                rest = np.flatnonzero(~found)
                for lo_ in range(0, len(rest), 50_000):
                    r = rest[lo_:lo_ + 50_000]
                    yield pa.record_batch([pa.array(depth[r].astype(np.int32)), pa.nulls(len(r), pa.int32()), pa.array(copies[r]),
                                           pa.array(keys[r]), pa.array(np.rint(logs[r] * 64).astype(np.int32)),
                                           pa.array(np.ones(len(r), np.int64))], names=names)
        yield from flush()

    rows = map_arrow(docs.select("text"), run, "depth int, share int, copies int, key bigint, log int, n bigint").groupBy(
        "depth", "share", "copies", "key", "log").agg(F.sum("n").alias("n"))
    rows = stable(rows)
    share = (F.col("total") - 1) / F.lit(float(max(trained.tokens, 1)))
    rare = rows.filter("key IS NOT NULL").join(words.select("key", F.col("n").alias("total")), "key", "left").select(
        "depth", F.when(share > 0, F.rint((F.col("log") / 64 - F.log(share)) * RATIO_STEPS).cast("int")).otherwise(NO_SHARE).alias("share"),
        "copies", "n")
    return rows.filter("key IS NULL").select("depth", "share", "copies", "n").unionAll(rare).groupBy(
        "depth", "share", "copies").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, tokenizer: str, sample: int = 1000, pass_share: int = 1) -> tuple[Trained, DataFrame]:
    """Learn from ``docs(doc_id, text)``: the trained model and the counted
    vocabulary ``(key, n)``.  Counts of words, of subword ids and of subword
    bigrams, the averaged pass over all windows and the weights of the mixture
    cover every document.  The pass starts from weights that about ``sample``
    documents, chosen by a hash of the row, have warmed up; a caller can have it
    made over one of ``pass_share``."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n_docs = docs.count()
    few = drawn(docs, 43, min(1.0, (sample + 1) / max(n_docs, 1)))
    vocabulary = Vocabulary(tokenizer, count_ids(docs, tokenizer))
    counted = stable(count_corpus(docs, vocabulary))
    bigrams = np.zeros(PREV * IDS, np.float32)
    key, n = collected(counted.filter("kind = 1").select(F.col("key").cast("int"), F.col("n").cast("float")))
    bigrams[key] = n  # at most PREV x IDS rows
    bigrams = bigrams.reshape(PREV, IDS)
    group = group_ids(bigrams, vocabulary.begins)
    base, inner = tables(bigrams, group, vocabulary.others)
    net = warmed(few.orderBy(F.xxhash64(F.lit(43), "doc_id", "text"), "text").limit(2 * sample).select("text"), base, group, vocabulary)
    if net is None:
        net = Attention()
    else:
        net = refine(net, base, group, vocabulary, drawn(docs, 47, 1 / pass_share) if pass_share > 1 else docs)
    words = counted.filter("kind = 0").select("key", "n")
    tokens, types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    keys, counts = collected(words.orderBy(F.col("n").desc(), "key").limit(HEAD))
    trained = Trained(Model(vocabulary, group, base, inner, net), keys, counts, int(tokens), int(types))
    trained.tune(*collected(ratios(docs, trained, words)))  # rows bounded by depths and steps
    return trained, words


def score(docs: DataFrame, trained: Trained, words: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_tokens, n_known, train_tokens,
    base_score, score``, a row per row; null and empty texts are the end
    alone.  Scores are log10 probabilities; nothing learned means every count
    is 0."""
    src = docs.select("doc_id", "text")
    kind = src.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(trained)  # tables of fixed size
    names = ["doc_id", "n_tokens", "known", "base", "score", "key", "part", "depth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        rates, tokens = t.log10_rate(t.counts), max(t.tokens, 1)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi, w in word_batches(texts, limit=SLICE):
                keys, doc = with_ends(w, hi - lo)
                at, found = t.find(keys)
                base = np.bincount(doc[found], rates[at[found]], hi - lo)
                known = np.bincount(doc[found], minlength=hi - lo)
                rest = np.flatnonzero(~found)
                cuts = np.searchsorted(doc[rest], np.arange(hi - lo + 1)).astype(np.int32)
                again, depth = copy_shares(keys, doc)
                part = t.without_share(t.model.word_log_probs(w)[0], again, depth)  # in the order of the keys
                lists = (pa.ListArray.from_arrays(pa.array(cuts), pa.array(v[rest])) for v in (keys, part, depth.astype(np.int8)))
                share = t.weights[depth[found], 0] * t.counts[at[found]] / tokens
                head = np.bincount(doc[found], np.log10(part[found] + share + 1e-300), hi - lo)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(w.count + 1), pa.array(known),
                                       pa.array(base), pa.array(head), *lists], names=names)

    rows = map_arrow(src, run, f"doc_id {kind}, n_tokens bigint, known bigint, base double, score double, "
                               "key array<bigint>, part array<double>, depth array<tinyint>")
    rows = stable(rows.withColumn("rid", F.monotonically_increasing_id()))
    rare = rows.select("rid", F.inline(F.arrays_zip("key", "part", "depth"))).join(words, "key", "left")
    count = F.coalesce("n", F.lit(0))
    total = F.lit(trained.tokens + 0.5 * (trained.types + 1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in trained.weights[:, 0]]), F.col("depth") + 1)
    mixed = weight * count / F.lit(float(max(trained.tokens, 1))) + F.col("part") + F.lit(1e-300)
    added = lambda x: F.sum(F.rint(x * SCORE_STEPS).cast("bigint")) / SCORE_STEPS  # whole numbers: in any order
    rare = rare.groupBy("rid").agg(added(F.log10((count + 0.5) / total)).alias("more"), added(F.log10(mixed)).alias("tail"),
                                   F.sum((count > 0).cast("bigint")).alias("also"))
    out = rows.drop("key", "part", "depth").join(rare, "rid", "left")
    return out.select("doc_id", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"),
                      F.lit(trained.tokens).cast("bigint").alias("train_tokens"),
                      (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
                      (F.col("score") + F.coalesce("tail", F.lit(0.0))).alias("score"))


def lm_scores(docs: DataFrame, tokenizer: str, held: tuple[int, int] = (5, 1), **how) -> DataFrame:
    """Learn from the rows of ``docs(doc_id, text)`` whose crc32 fold is not
    ``held`` and score all of them; see :func:`score`.  Repeated rows are
    learned from and scored as often as they occur; an empty table gives no
    rows."""
    trained, words = fit(docs.filter(fold(F.col("doc_id"), held[0]) != held[1]), tokenizer, **how)
    return score(docs, trained, words)
