"""Operators against brute force, round trips and held-out labels."""

import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from quarry.llm import cap_filters, fingerprints, langid, lm, mixing, packing, quality, simhash, token_counts, toxicity
from quarry.llm import queries as registered
from quarry.llm.byte_bpe import byte_bpe
from quarry.llm.components import connected_components
from quarry.llm.word_batch import stable_order

SF = "/root/testdata/sf0.001"


def held(doc_id, parts, part):
    return zlib.crc32(str(doc_id).encode()) % parts == part


def roots(n, links):
    p = list(range(n))

    def top(i):
        while p[i] != i:
            i = p[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        p[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registered.queries()[name](spark, SF)
    want = con.execute(registered.oracle_sql()[name]).df()
    got = df.toPandas()
    key = list(got.columns)
    got, want = (x.sort_values(key, ignore_index=True)[sorted(got.columns)] for x in (got, want))
    for c in got:
        assert (got[c] == want[c]).all() or np.allclose(got[c], want[c], rtol=1e-9), c


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(0, i) for i in range(1, 60)] + [(100 + i, 101 + i) for i in range(80)] + [
        tuple(map(int, rng.integers(200, 400, 2))) for _ in range(150)] + [(7, 7), (1, 0)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = roots(400, links)
    assert all(want[k] == v for k, v in got.items())
    assert set(got) == {x for a, b in links if a != b for x in (a, b)}


def test_merkle_edits(spark):
    text = "\n".join(f"Paragraph {i} says this, and that." for i in range(200))
    other = text.replace("Paragraph 77 ", "Paragraph seventy-seven ")
    a, b, c = fingerprints.document_trees(spark.createDataFrame([(1, text), (2, other), (3, text)], "doc_id bigint, text string")).collect()
    assert a["fingerprint"] == c["fingerprint"] != b["fingerprint"]
    assert [i for i, (x, y) in enumerate(zip(a["paragraphs"], b["paragraphs"])) if x != y] == [77]
    assert 1 <= len(set(a["sections"]) - set(b["sections"])) <= 2


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    y = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in registered.op2_quality(spark, sf).collect() if r["held_out"] and r["doc_id"] in y]
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) for r in got)
    assert np.mean([r["predicted"] == y[r["doc_id"]] for r in got]) > 0.95


def test_dual_coordinate_descent():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((60, 5))
    y = np.sign(x @ np.array([1.0, -2, 0, 0.5, 0]) + 0.3 * rng.standard_normal(60))
    idx = np.arange(5)
    w = quality.dual_coordinate_descent([(idx, r) for r in x], y, 5, np.full(60, 0.7), epochs=2000)
    loss = lambda v: v @ v / 2 + 0.7 * np.maximum(0, 1 - y * (x @ v)).sum()
    assert all(loss(w) <= loss(w + 0.05 * rng.standard_normal(5)) + 1e-3 for _ in range(200))


def test_mixing_targets(spark):
    sizes = {"a": 10, "b": 500, None: 40, "c": 3, "d": 0}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    order = sorted((k for k in sizes if k is not None)) + [None]
    w = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
    left, open_, want = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        level = left / sum(w[k] for k in open_)
        over = {k for k in open_ if level * w[k] >= 2 * sizes[k]}
        if not over:
            break
        for k in over:
            want[k] = 2.0 * sizes[k]
            left -= want[k]
        open_ -= over
    want |= {k: level * w[k] for k in open_}
    assert got == pytest.approx(want)


def test_mixing_takes(spark, docs):
    got = mixing.mix(docs).collect()
    taken, size = Counter(), defaultdict(int)
    for r in got:
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"]
        size[r["source"]] = max(size[r["source"]], r["size"])
    assert all(abs(taken[r["source"]] - r["target"]) <= size[r["source"]] for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs).collect()))


def test_lm_base(spark, docs, tokenizer):
    got = {r["doc_id"]: r for r in lm.lm_scores(docs, tokenizer).collect()}
    tokens = {r["doc_id"]: [*(r["text"] or "").encode().translate(simhash.LOWER).split(), None] for r in docs.collect()}
    c = Counter(w for i, ws in tokens.items() if not held(i, 5, 1) for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["train_tokens"], r["n_tokens"], r["n_known"]) == (n, len(ws), sum(c[w] > 0 for w in ws))
        assert r["base_score"] == pytest.approx(sum(np.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert r["score"] < 0


def _tiny(tokenizer, rng):
    big = rng.integers(0, 5, (lm.PREV, lm.IDS)).astype(np.float32)
    vocab = lm.Vocabulary(tokenizer, np.bincount(rng.integers(0, 300, 5000), minlength=byte_bpe(tokenizer).size))
    group = lm.group_ids(big, vocab.begins)
    base, inner = lm.tables(big, group, vocab.others)
    return lm.Model(vocab, group, base, inner, lm.Attention())


def test_lm_attention_brute(tokenizer):
    """Windows score each id once as a plain masked attention would, and
    group probabilities add up to one."""
    rng = np.random.default_rng(3)
    m = _tiny(tokenizer, rng)
    texts = lm.stream(m.vocabulary, lm._words(["a b c the", "", "word " * 60, "x" * 90 + " end"]))
    x, y, valid, opens = texts
    lp, word_next = m.log_probs(texts)
    for i in np.flatnonzero(valid):
        block = i // lm.BLOCK
        lo = (block - (not opens[block])) * lm.BLOCK
        e = m.net.embed[x[lo:i + 1]]
        s = (m.net.embed[x[i]] @ m.net.query) @ (e @ m.net.key).T / np.sqrt(lm.DIM) + m.net.distance[i - np.arange(lo, i + 1)]
        a = np.exp(s) / np.exp(s).sum()
        z = (a @ (e @ m.net.value)) @ m.net.out + m.base[min(x[i], lm.PREV - 1)]
        z -= np.log(np.exp(z).sum())
        assert lp[i] == pytest.approx(z[m.group[y[i]]] + m.inner[min(x[i], lm.PREV - 1), y[i]], abs=1e-3)
        assert word_next[i] == pytest.approx(np.log(np.exp(z[:lm.STARTS]).sum()), abs=1e-3)


def test_lm_learns(tokenizer):
    rng = np.random.default_rng(5)
    m = _tiny(tokenizer, rng)
    texts = lm.stream(m.vocabulary, lm._words(["one two three four five six seven " * 40] * 20))
    before = m.log_probs(texts)[0][texts.valid].mean()
    lm.train(m.net, m.base, m.group, texts)
    assert m.log_probs(texts)[0][texts.valid].mean() > before + 0.2


def test_lm_pass_takes_rows_not_texts(spark, tokenizer, monkeypatch):
    """A group of copies is drawn at its share of the rows."""
    passed = []
    monkeypatch.setattr(lm, "refine", lambda net, base, group, vocabulary, docs: passed.append(docs) or net)
    rows = [(i, "one text that many rows hold" if i % 2 else f"text {i}") for i in range(1600)]
    lm.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), tokenizer, sample=50, pass_share=16)
    copies = passed[0].filter("text LIKE 'one%'").count()
    assert 25 <= copies <= 100 and 25 <= passed[0].count() - copies <= 100


def test_lm_pass_uses_all_windows(spark, tokenizer):
    text = " ".join(f"word{i % 37} and" for i in range(400))
    m = _tiny(tokenizer, np.random.default_rng(1))
    vocabulary, group, base = m.vocabulary, m.group, m.base
    got = lm.refine(lm.Attention(), base, group, vocabulary, spark.createDataFrame([(1, text)], "doc_id bigint, text string").coalesce(1))
    want = lm.Attention()
    lm.train(want, base.astype(np.float32), group, lm.stream(vocabulary, lm._words([text])), rate=0.005)
    assert np.allclose(got.flat(), want.flat(), atol=1e-5)


def softmax(s):
    s = np.exp(s - s.max(axis=-1, keepdims=True))
    return s / s.sum(axis=-1, keepdims=True)


def plain_train(net, base, group, texts, batch, rate, seed):
    """The pass of ``lm.train`` as one reads it: no buffers, every embedding in every step."""
    x, y, valid, opens = texts
    xp = np.r_[np.zeros(lm.BLOCK, np.int32), x].reshape(-1, lm.BLOCK)
    x, y, valid = (v.reshape(-1, lm.BLOCK) for v in (x, y, valid))
    chosen = np.random.default_rng(seed).permutation(len(opens))
    state = {name: np.full(getattr(net, name).shape, 1e-4, np.float32) for name in net.NAMES}
    d = np.arange(lm.BLOCK)[:, None] + lm.BLOCK - np.arange(2 * lm.BLOCK)[None, :]
    scale = np.float32(1 / np.sqrt(lm.DIM))
    for lo in range(0, len(chosen), batch):
        at = chosen[lo:lo + batch]
        c = len(at)
        both = np.concatenate([xp[at], x[at]], axis=1)
        e = net.embed[both]
        q, k, v = e[:, lm.BLOCK:] @ net.query, e @ net.key, e @ net.value
        s = np.matmul(q, k.transpose(0, 2, 1)) * scale + net.bias()
        s[opens[at], :, :lm.BLOCK] = -1e9
        p = softmax(s)
        o = np.matmul(p, v)
        logits = o @ net.out + base[np.minimum(x[at], lm.PREV - 1)]
        dl = softmax(logits)
        target = group[y[at]][:, :, None]
        np.put_along_axis(dl, target, np.take_along_axis(dl, target, 2) - 1, 2)
        dl *= valid[at][:, :, None] / np.float32(c * lm.BLOCK)
        do = dl @ net.out.T
        dp = np.matmul(do, v.transpose(0, 2, 1))
        dv = np.matmul(p.transpose(0, 2, 1), do)
        ds = p * (dp - (p * dp).sum(axis=2, keepdims=True))
        dq, dk = np.matmul(ds, k) * scale, np.matmul(ds.transpose(0, 2, 1), q) * scale
        de = dk @ net.key.T + dv @ net.value.T
        de[:, lm.BLOCK:] += dq @ net.query.T
        flat_e, flat = e.reshape(-1, lm.DIM), both.ravel()
        grads = {
            "out": o.reshape(-1, lm.DIM).T @ dl.reshape(-1, lm.GROUPS),
            "query": e[:, lm.BLOCK:].reshape(-1, lm.DIM).T @ dq.reshape(-1, lm.DIM),
            "key": flat_e.T @ dk.reshape(-1, lm.DIM), "value": flat_e.T @ dv.reshape(-1, lm.DIM),
            "embed": np.stack([np.bincount(flat, de[:, :, j].ravel(), lm.IDS) for j in range(lm.DIM)], 1).astype(np.float32),
            "distance": np.bincount(np.clip(d, 0, 2 * lm.BLOCK - 1).ravel(), (ds.sum(axis=0) * (d >= 0)).ravel(),
                                    2 * lm.BLOCK).astype(np.float32)}
        for name, g in grads.items():
            state[name] += g * g
            getattr(net, name)[...] -= np.float32(rate) * g / np.sqrt(state[name])


def test_lm_pass_learns_the_same_for_less(tokenizer):
    """The same weights as the plain steps, the last batch a short one, for under 85 % of their CPU seconds."""
    rng = np.random.default_rng(9)
    m = _tiny(tokenizer, rng)
    words = [f"w{i}" for i in range(400)]
    texts = lm.stream(m.vocabulary, lm._words([" ".join(rng.choice(words, rng.integers(0, 300))) for _ in range(200)]))
    assert len(texts.opens) % 64
    spent, nets = {"plain": [], "lm": []}, {}
    for _ in range(3):
        for name, run in (("plain", plain_train), ("lm", lm.train)):
            nets[name] = lm.Attention()
            begun = time.process_time()
            run(nets[name], m.base, m.group, texts, batch=64, rate=0.005, seed=2)
            spent[name].append(time.process_time() - begun)
    assert np.allclose(nets["plain"].flat(), nets["lm"].flat(), atol=1e-5)
    assert min(spent["lm"]) < 0.85 * min(spent["plain"])


def test_lm_cell_counts_by_brute_force():
    rng = np.random.default_rng(10)
    depth, share, copies = rng.integers(0, lm.DEPTHS, 2000), rng.integers(-3000, 3000, 2000) // 900, rng.integers(-2, 2, 2000)
    share[::7], copies[::5], share[::11], copies[::13] = lm.NO_SHARE, lm.NO_SHARE, -30_000_000, -30_000_000  # a word of 1 MB
    cells, n = lm.cell_counts(depth, share.astype(np.int32), copies.astype(np.int32))
    assert dict(zip(zip(*(c.tolist() for c in cells)), n.tolist())) == Counter(zip(depth.tolist(), share.tolist(), copies.tolist()))


def test_lm_cells_are_added_up():
    rng = np.random.default_rng(11)
    cells = [rng.integers(0, 3, 500) for _ in range(3)]
    times = rng.integers(1, 9, 500)
    want = Counter()
    for cell, n in zip(zip(*(c.tolist() for c in cells)), times.tolist()):
        want[cell] += n
    got, n = lm.cell_counts(*cells, times)
    assert dict(zip(zip(*(c.tolist() for c in got)), n.tolist())) == want


def test_lm_cells_leave_a_task_once(spark, tokenizer, monkeypatch):
    """However many slices a task reads."""
    vocabulary = lm.Vocabulary(tokenizer, np.bincount(np.arange(300), minlength=byte_bpe(tokenizer).size))
    base, inner = lm.tables(np.ones((lm.PREV, lm.IDS), np.float32), np.arange(lm.IDS) % lm.GROUPS, vocabulary.others)
    model = lm.Model(vocabulary, np.arange(lm.IDS) % lm.GROUPS, base, inner, lm.Attention())
    keys = lm.word_keys(lm._words(["a b c d"]))
    trained = lm.Trained(model, np.append(keys, lm.END_KEY), np.full(5, 40), 200, 5)
    seen = []
    monkeypatch.setattr(lm, "map_arrow", lambda df, run, schema: seen.append(run) or df)
    monkeypatch.setattr(lm, "SLICE", 16)
    with pytest.raises(Exception, match="depth"):  # no task is run here
        lm.ratios(spark.createDataFrame([("a",)], "text string"), trained, None)
    rows = list(seen[0](iter([pa.record_batch([pa.array(["a b c d a b"] * 40)], names=["text"])])))
    assert len(rows) == 1 and sum(rows[0].column(5).to_pylist()) == 40 * 7 and rows[0].num_rows <= 7


def test_lm_trains_in_tasks(spark, tokenizer, docs, monkeypatch):
    """The driver, which has the least memory, runs no model."""
    def no(*a, **b):
        raise AssertionError("trained at the driver")
    monkeypatch.setattr(lm, "learner", no)  # the tasks have their own
    trained, _ = lm.fit(docs.limit(40), tokenizer, sample=20)
    assert np.abs(trained.model.net.flat() - lm.Attention().flat()).max() > 0


def test_stable_order_of_hashes():
    rng = np.random.default_rng(12)
    low = rng.integers(0, 4, 3000).astype(np.uint64)  # differ only in bits that aren't sorted by
    for h in (low, low << np.uint64(60), rng.integers(0, 1 << 63, 3000).astype(np.uint64)[rng.integers(0, 90, 3000)], low[:1], low[:0]):
        assert (stable_order(h) == np.argsort(h, kind="stable")).all()
    w = lm._words(["b a b", "", "a c"])
    keys, first, which = w.distinct()
    assert all((a == b).all() for a, b in zip((keys, first, which), np.unique(w.hashes(), return_index=True, return_inverse=True)))


def brute_copies(keys):
    """Of one text: each word's share among those before it, and its depth."""
    again = [keys[:i].count(k) / i if i else 0.0 for i, k in enumerate(keys)]
    return np.array(again), np.array([min(int(np.log2(i + 1)), lm.DEPTHS - 1) for i in range(len(keys))])


def test_copy_shares_by_brute_force():
    texts = ["a b a a c b", "", "b b b", "x " * 50 + "y"]
    keys, doc = lm.with_ends(lm._words(texts), len(texts))
    got = lm.copy_shares(keys, doc)
    want = [brute_copies(keys[doc == i].tolist()) for i in range(len(texts))]
    assert np.allclose(got[0], np.concatenate([w[0] for w in want])) and (got[1] == np.concatenate([w[1] for w in want])).all()


def test_lm_scores_whatever_the_layout(spark, tokenizer, docs):
    """The same rows in other partitions learn and score alike, words of other
    white space included."""
    odd = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(["\u00a0 \u00a0\u00a0 x", "a\u3000b \u2003 \u2003 c"] * 3)],
                                "doc_id bigint, text string")
    some = docs.select("doc_id", "text").unionByName(odd)
    one, seven = ({r["doc_id"]: r for r in lm.lm_scores(some.repartition(n), tokenizer).collect()} for n in (1, 7))
    assert one == seven and len(one) == some.count()


def test_lm_held_out_above_word_counts(spark):
    rows = registered.op4_lm_scoring(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.05 * sum(r["n_tokens"] for r in rows)


def test_word_ids_of_other_white_space(tokenizer):
    table, bpe = lm.WordIds(tokenizer), lm.byte_bpe(tokenizer)
    rng = np.random.default_rng(6)
    for _ in range(60):
        words = ["".join(rng.choice(["\u00a0", "\u2003", "a", "b'", "é", "\x85"], rng.integers(1, 5))) for _ in range(30)]
        w = lm._words([" ".join(words)])
        ids, begin, which = table.of(w)
        parts = np.split(ids, begin[1:])
        for word, k in zip(words, which):
            assert (parts[k] == bpe(" " + word)).all()


def test_lm_score_mixes_the_share_of_every_word(spark, tokenizer, docs, monkeypatch):
    """Rare words keep their counts: the table of common words changes no score."""
    some = docs.select("doc_id", "text").orderBy("doc_id").limit(60)
    trained, words = lm.fit(some, tokenizer, sample=30)
    count = {r["key"]: r["n"] for r in words.collect()}
    order = np.argsort(-trained.counts, kind="stable")[:20]
    short = lm.Trained(trained.model, trained.keys[order], trained.counts[order], trained.tokens, trained.types)
    short.weights = trained.weights = np.random.default_rng(8).dirichlet([1, 1, 1], lm.DEPTHS)
    for t in (trained, short):
        got = {r["doc_id"]: r["score"] for r in lm.score(some, t, words).collect()}
        for r in some.collect():
            w = lm._words([r["text"]])
            share = np.array([count.get(k, 0) for k in lm.with_ends(w, 1)[0].tolist()]) / trained.tokens
            again, depth = brute_copies(lm.with_ends(w, 1)[0].tolist())
            of = trained.weights[depth]
            want = np.log10(of[:, 0] * share + of[:, 1] * np.exp(trained.model.word_log_probs(w)[0]) + of[:, 2] * again).sum()
            assert abs(got[r["doc_id"]] - want) < 1e-4 * abs(want)


def test_lm_ids_and_weight_from_all_documents(spark, tokenizer, docs):
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(40).collect()] + ["rare zebras graze " * 8000]
    some = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    trained, words = lm.fit(some, tokenizer, sample=2)
    vocabulary = lm.Vocabulary(tokenizer, np.bincount(np.concatenate(
        [lm.byte_bpe(tokenizer)(" " + " ".join(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))))
         for t in texts]), minlength=lm.byte_bpe(tokenizer).size))
    assert (trained.model.vocabulary.number == vocabulary.number).all()
    count = {r["key"]: r["n"] for r in words.collect()}
    w = lm._words(texts)
    share = np.array([count[k] - 1 for k in lm.with_ends(w, len(texts))[0].tolist()]) / trained.tokens
    keys, doc = lm.with_ends(w, len(texts))
    again, depth = lm.copy_shares(keys, doc)
    parts = np.stack([share, np.exp(trained.model.word_log_probs(w)[0]), again], axis=1)
    weights = np.full((lm.DEPTHS, 3), 1 / 3)
    for _ in range(60):
        own = weights[depth] * parts
        own /= own.sum(axis=1, keepdims=True)
        for d in range(lm.DEPTHS):
            if (depth == d).any():
                weights[d] = own[depth == d].mean(axis=0)
    some = np.bincount(depth, minlength=lm.DEPTHS) > 200
    assert some.any() and np.abs(trained.weights - weights)[some].max() < 0.02


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    y = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in registered.op5_toxicity(spark, sf).collect() if r["doc_id"] in y]
    assert np.mean([r["predicted"] == y[r["doc_id"]] for r in got]) > 0.9


def test_maximal_segments():
    """Against the definition: maximal among the segments all of whose proper
    parts score less."""
    rng = np.random.default_rng(2)
    for _ in range(60):
        s = rng.integers(-4, 4, 14).astype(float)
        total = np.r_[0, np.cumsum(s)]
        good = {(i, j) for i in range(14) for j in range(i + 1, 15)
                if all(total[k] > total[i] for k in range(i + 1, j + 1)) and all(total[k] < total[j] for k in range(i, j))}
        want = {a for a in good if not any(b != a and b[0] <= a[0] and a[1] <= b[1] for b in good)}
        got = toxicity.maximal_segments(s, np.flatnonzero(s > 0), total)
        assert {(a, b) for a, b, _ in got} == want


def test_simhash_brute(spark, docs):
    def plain(text):
        words = (text or "").encode().translate(simhash.LOWER).split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = docs.limit(60).collect()
    close = [(1000 + i, " ".join(r["text"].split()[:-1])) for i, r in enumerate(rows)] + [(2000, rows[0]["text"]), (2001, None)]
    df = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows] + close, "doc_id bigint, text string")
    items = df.collect()
    fp = [plain(r["text"]) for r in items]
    top = roots(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 2])
    low = defaultdict(lambda: 1 << 60)
    for r, t in zip(items, top):
        low[t] = min(low[t], r["doc_id"])
    got = {r["doc_id"]: r for r in simhash.simhash_groups(df).collect()}
    for r, f, t in zip(items, fp, top):
        assert (got[r["doc_id"]]["fingerprint"], got[r["doc_id"]]["component_id"]) == (f"{f:016x}", low[t])


def test_bit_neighbours(spark):
    """Every pair within two bits is linked, whichever bits differ."""
    rng = np.random.default_rng(8)
    base = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    near = [b ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 64, (6, 2))]
    values = list(dict.fromkeys(base + near))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect()
    at = {v: i for i, v in enumerate(signed)}
    want = roots(len(values), [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2])
    assert roots(len(values), [(at[r["a"]], at[r["b"]]) for r in links]) == want


def test_longest_match():
    rng = np.random.default_rng(4)
    for _ in range(30):
        pieces = {"".join(rng.choice(list("abc▁"), rng.integers(1, 5))) for _ in range(12)}
        auto = token_counts.LongestMatch(pieces)
        for _ in range(20):
            word = "".join(rng.choice(list("abcdé"), rng.integers(0, 12)))
            s, n = "▁" + word, 0
            while s:
                k = next((k for k in range(len(s), 0, -1) if s[:k] in pieces), 0)
                n += 1 if k else len(s[0].encode())
                s = s[k or 1:]
            assert auto.scan("▁" + word) == n


def test_cap_filters_brute(spark):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal((30, 24))
    x = np.concatenate([centre + 0.12 * rng.standard_normal((30, 24)) for _ in range(12)] + [rng.standard_normal((200, 24))]).astype(np.float32)
    label = rng.integers(0, 2, len(x))
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))],
                               "vec_id bigint, embedding array<float>, label int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = (u @ u.T >= 0.98) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    want = link.sum(axis=1)
    for chunk in (1024, 4):  # full filters are cut into chunks without loss
        got = {r["vec_id"]: r for r in cap_filters.near_vectors(df, chunk=chunk).collect()}
        found = np.array([got[i]["n_links"] for i in range(len(x))])
        assert (found <= want).all() and found.sum() >= 0.99 * want.sum()


@pytest.mark.parametrize("size, words", [(1_000_000, 46), (10_000_000, 100)])
def test_cap_filters_recall_at_scale(spark, monkeypatch, size, words):
    """Filters as for ``size`` vectors find the pairs that brute force finds."""
    whole = cap_filters.code_size
    monkeypatch.setattr(cap_filters, "code_size", lambda n, *how: whole(size, *how))
    assert cap_filters.code_size(1)[0] == words
    rng = np.random.default_rng(12)
    a, b = rng.standard_normal((2, 600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cosine = rng.uniform(0.9801, 0.985, (600, 1))
    x = np.concatenate([a, cosine * a + np.sqrt(1 - cosine ** 2) * b]).astype(np.float32)
    reps = spark.createDataFrame([(i, 0, 64, v.tolist(), 1) for i, v in enumerate(x)],
                                 "rid bigint, label int, dim int, vec array<float>, mult bigint")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = {(int(i), int(j)) for i, j in np.argwhere(np.triu(u @ u.T >= 0.98, 1))}
    assert len(want) >= 600
    assert {(r["a"], r["b"]) for r in cap_filters.vector_links(reps).collect()} == want


def test_marginals():
    rng = np.random.default_rng(0)
    count = np.array([5, 0, 200, 64, 65, 1, 130])
    em, tr = rng.normal(size=(count.sum(), 3)) * 2, rng.normal(size=(3, 3))
    got, at = langid.marginals(em, count, tr), 0
    for c in count:
        f, b = [np.exp(em[at])] if c else [], [np.ones(3)]
        for t in range(1, c):
            f.append((f[-1] @ np.exp(tr)) * np.exp(em[at + t]))
            f[-1] /= f[-1].sum()
        for t in range(c - 2, -1, -1):
            b.insert(0, np.exp(tr) @ (np.exp(em[at + t + 1]) * b[0]))
            b[0] /= b[0].sum()
        if c:
            p = np.array(f) * np.array(b)
            assert np.allclose(p / p.sum(axis=1, keepdims=True), got[at:at + c])
        at += c


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs)
    got = langid.identify(docs, model).collect()
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in got if held(r["doc_id"], 4, 2)]) > 0.97
    mixed = spark.createDataFrame([(1, "The that and with of the ered onnd " * 4 + "der die und einer verlich schung " * 4)], "doc_id bigint, text string")
    assert {r["lang"] for r in langid.identify(mixed, model).first()["runs"]} >= {"en", "de"}


def test_packing_round_trip(spark, docs, tokenizer):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer)
    odd = [(90_000, "<|endoftext|> 日本   x\u0085y it's 12,5 ½"), (90_001, "ab " * 5000)]
    d = docs.select("doc_id", "text").unionAll(spark.createDataFrame(odd, "doc_id bigint, text string"))
    ids = {r["doc_id"]: [*slow.encode(r["text"], add_special_tokens=False).ids, 0] for r in d.collect()}
    got = packing.pack(d, tokenizer).collect()
    sequences, at = defaultdict(list), defaultdict(int)
    for r in sorted(got, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == at[r["doc_id"]]
        at[r["doc_id"]] += r["length"]
        piece = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r["ids_crc32"]
        assert len(ids[r["doc_id"]]) > 2048 or r["piece"] == 0
        assert r["piece"] == 0 or r["length"] == 2048
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all(at[k] == len(v) for k, v in ids.items())
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 2048
    assert len(sequences) <= 1.02 * -(-sum(map(len, ids.values())) // 2048) + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_capacities(rule):
    rng = np.random.default_rng(9)
    lengths = rng.integers(1, 100, 400)
    where, offset = packing.best_fit(lengths, (100, 3, 4000), rule=rule) if (lengths ** 2 <= 4000).all() else packing.best_fit(
        np.minimum(lengths, 60), (100, 3, 4000), rule=rule)
    lengths = np.minimum(lengths, 60) if (lengths ** 2 > 4000).any() else lengths
    assert np.bincount(where, lengths).max() <= 100 and np.bincount(where).max() <= 3
    assert np.bincount(where, lengths ** 2).max() <= 4000
    with pytest.raises(ValueError):
        packing.best_fit(np.array([101]), (100, 3, 40_000))


def test_queries_cover_their_tables(spark):
    rows = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "embeddings")}
    for name, q in registered.queries().items():
        if name in ("op6_simhash", "op9_language"):
            assert q(spark, SF).count() == rows["documents"]
