"""Hard negatives, repeated word sequences, subvector clustering."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import residues, substrings, subvectors

# ------------------------------------------------------------ hard negatives


@pytest.mark.parametrize("size", [200, 1 << 20, 1 << 27])
def test_residue_products_are_exact(size):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-size, size, (40, 150)), rng.integers(-size, size, (30, 150))
    bound = int(max((a.astype(object) ** 2).sum(1).max(), (b.astype(object) ** 2).sum(1).max()))
    primes = residues.primes_for(bound)
    assert np.prod([float(p) for p in primes]) > 2 * bound
    got = residues.products(residues.Residues(a, primes)[:], residues.Residues(b, primes)[:], primes)
    assert (got == a.astype(object) @ b.T.astype(object)).all()


def test_best_breaks_ties_by_column():
    s = np.array([[5, 7, 7, residues.NONE, 7, 5], [residues.NONE] * 6, [1, 2, 3, 3, 3, 3]])
    row, col = residues.best(s, 2)
    assert list(zip(row, col)) == [(0, 1), (0, 2), (2, 2), (2, 3)]


def brute_negatives(rows, is_anchor, positives=5, negatives=10, scale=256, low=30, high=90):
    good = [(i, v, lab, [int(np.floor(scale * float(x))) for x in e]) for i, (v, e, lab) in enumerate(rows)
            if lab is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    key = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for i, v, lab, q in good:
        if not is_anchor(v):
            continue
        score = [(sum(a * b for a, b in zip(q, p)), w, m == lab) for j, w, m, p in good if j != i and len(p) == len(q)]
        for s, w, _ in sorted((t for t in score if t[2]), key=key)[:positives]:
            picked = sorted((t for t in score if not t[2] and low * s <= 100 * t[0] <= high * s), key=key)[:negatives]
            out += [(v, w, r, t[1], s, t[0]) for r, t in enumerate(picked, 1)]
    return sorted(out, key=str)


def run_negatives(spark, rows, label="string", **how):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<double>, label {label}")
    df = df.selectExpr("*", "1 AS rid", "2 AS dim", "3 AS q")  # names of the operator's own columns
    got = residues.hard_negatives(df, F.col("vec_id") % 3 == 0, **how).collect()
    return sorted(map(tuple, got), key=str)


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        e = rng.normal(size=12) + np.eye(12)[0] * 2
        rows.append((i, e.tolist(), "abc"[i % 3]))
    rows += [rows[6], rows[7], (6, rows[8][1], "a")]  # repeated rows, and an id again
    rows += [(None, rows[3][1], "b"), (200, None, "a"), (201, rows[0][1], None), (202, [float("nan")] * 12, "a"),
             (203, [None] * 12, "a"), (204, [1.0, 2.0], "a"), (207, [1.0, 1.9], "b"), (210, [0.9, 1.0], "a"), (213, [], "a"),
             (216, [], "b"), (219, [], "a")]
    want = brute_negatives(rows, lambda v: v is not None and v % 3 == 0)
    assert run_negatives(spark, rows) == want and len(want) > 500
    # many small blocks find the same
    assert run_negatives(spark, rows, cell_values=1) == want


def test_hard_negatives_odd(spark):
    big = [(0, [1e300, 1.0], "a"), (3, [1e6, 2.0], "a"), (6, [1e6, 1.0], "a"), (9, [5e5, 0.0], "b")]
    got = run_negatives(spark, big)  # 1e300 has no 64-bit score and takes no part
    assert got == brute_negatives(big[1:], lambda v: v % 3 == 0) and got
    assert run_negatives(spark, []) == []
    assert run_negatives(spark, [(0, [1.0], "a"), (1, [1.0], "b")]) == []  # no positive
    same = [(i, [1.0, 0.0], "a" if i < 8 else "b") for i in range(20)] + [(30 + i, [0.5, 0.1], "b") for i in range(9)]
    assert run_negatives(spark, same) == brute_negatives(same, lambda v: v % 3 == 0)


# ---------------------------------------------------- repeated word sequences


@pytest.mark.parametrize("period", substrings.COVERS)
def test_covers(period):
    d = substrings.COVERS[period]
    assert all(any((i + k) % period in d and (j + k) % period in d for k in range(period))
               for i in range(period) for j in range(period))


def brute_removal(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = {}
    for i, w in enumerate(words):
        for s in range(len(w) - window + 1):
            seen.setdefault(tuple(w[s:s + window]), []).append((i, s))
    gone = [set() for _ in words]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i].update(range(s, s + window))
    return [(len(w), len(g), " ".join(x for k, x in enumerate(w) if k not in g)) for w, g in zip(words, gone)]


def check_removal(spark, texts, window):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, h1 string, at int")
    got = {r["doc_id"]: r for r in substrings.remove_repeats(df.repartition(3), window).collect()}
    for i, (n, gone, kept) in enumerate(brute_removal(texts, window)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == (n, gone, kept), i
        assert sum(s["end"] - s["start"] for s in got[i]["spans"]) == gone
    return got


@pytest.mark.parametrize("window", [1, 2, 5, 12, 35])
def test_removal_equals_brute_force(spark, window):
    rng = np.random.default_rng(window)
    word = [f"w{i}" for i in range(400)]
    some = lambda n: " ".join(rng.choice(word, n))
    passage, boiler = some(3 * window), some(window)
    texts = [some(80) + " " + passage[k * 3:] + "\n" + some(50) for k in range(6)] + [some(7) + "  " + boiler for _ in range(30)]
    texts += [None, "", " \t\n", "one", passage, passage, passage.upper(), boiler, some(window - 1 or 1)]
    texts += ["é x " * 60, "ab " * 200, some(300)]  # repeats within one document; white space beyond ASCII is no separator
    got = check_removal(spark, texts, window)
    assert any(r["n_removed"] for r in got.values())


def test_removal_of_copies_and_long_texts(spark):
    rng = np.random.default_rng(5)
    word = [f"w{i}" for i in range(5000)]
    long = " ".join(rng.choice(word, 300_000))  # over a megabyte: hashed in pieces
    inner = " ".join(long.split()[200_000:200_050])
    texts = [long, "start " + inner + " end"] + ["a copy of a short text"] * 40 + [" ".join(word[:60])] * 40 + [" ".join(word[10:50]) + " z"]
    got = check_removal(spark, texts, 35)
    assert got[0]["n_removed"] == got[1]["n_removed"] == 50


def test_removal_odd(spark, odd, empty):
    rows = substrings.remove_repeats(odd).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in odd.collect())
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[5]["kept"] == "" and by_id[5]["n_words"] == 80_000
    assert (by_id[3]["n_words"], by_id[3]["kept"], by_id[3]["spans"]) == (0, "", [])
    assert substrings.remove_repeats(empty).collect() == []


# ------------------------------------------------------- subvector clustering


def test_blocks_are_lossless_and_merge(spark):
    rng = np.random.default_rng(2)
    x = np.repeat(rng.integers(-9, 9, (5, 10)), 40, axis=0)
    blocks = subvectors.encode(x)
    assert len(blocks) == 1 and len(blocks[0].entries) == 5  # whole vectors repeat
    for y in (x, rng.integers(-9, 9, (300, 7)), rng.integers(-9, 9, (1, 3))):
        blocks = subvectors.encode(y)
        assert (np.concatenate([b.entries[b.codes] for b in blocks], axis=1) == y).all()
        c = rng.integers(-9, 9, (4, y.shape[1]))
        assert (subvectors.distances(blocks, c) == ((y[:, None] - c[None]) ** 2).sum(2)).all()
        own = rng.integers(0, 4, len(y))
        assert (subvectors.cluster_sums(blocks, own, 4) == [y[own == k].sum(0) for k in range(4)]).all()


def brute_clusters(rows, k, rounds, dims, scale=1024):
    kept = [(v, [int(np.floor(scale * float(x))) for x in e]) for v, e in rows
            if e is not None and len(e) == dims and all(x is not None and np.isfinite(x) for x in e)]
    first = lambda t: (t[0] is None, "" if t[0] is None else hashlib.sha256(f"3:{t[0]}".encode()).hexdigest(), t[1])
    centroids = [x for _, x in sorted(kept, key=first)[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(x)[1] for _, x in kept]
        for i in range(len(centroids)):
            mine = [x for (_, x), o in zip(kept, own) if o == i]
            if mine:
                centroids[i] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [near(x) for _, x in kept]
    inertia = [sum(d for d, o in found if o == i) for i in range(len(centroids))]
    return sorted(((v, o, d, inertia[o], sum(inertia), centroids[o]) for (v, _), (d, o) in zip(kept, found)), key=str)


def run_clusters(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "'f' AS first", "1 AS x", "2 AS cluster")
    first = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    return sorted((tuple(r) for r in subvectors.cluster(df, first, **how).collect()), key=str)


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=6) + 3 * rng.normal(size=6).round()).tolist()) for i in range(150)]
    rows += [rows[3]] * 30 + [(None, rows[5][1]), (200, None), (201, [1.0]), (202, [float("inf")] * 6), (203, [None] * 6),
                              (204, [-1e-9] * 6)]
    for chunk in (8192, 16):
        assert run_clusters(spark, rows, k=8, rounds=4, dims=6, chunk=chunk) == brute_clusters(rows, 8, 4, 6)


def test_clusters_odd(spark):
    two = [(1, [0.5, 0.5]), (2, [0.25, 0.5])]
    assert run_clusters(spark, two, k=8, rounds=3, dims=2) == brute_clusters(two, 8, 3, 2)
    assert run_clusters(spark, [], dims=2) == []
    ties = [(i, [float(i % 2), 0.0]) for i in range(40)]  # centroids that coincide keep no rows
    assert run_clusters(spark, ties, k=4, rounds=3, dims=2) == brute_clusters(ties, 4, 3, 2)
    assert run_clusters(spark, two + [(3, [1e9, 0.0])], k=2, rounds=1, dims=2) == brute_clusters(two, 2, 1, 2)
    with pytest.raises(ValueError):
        subvectors.cluster(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), F.lit(1), dims=65)


# --------------------------------------------------- likeness of fingerprints


def brute_leaves(text):
    from collections import Counter
    found = []
    for c in re.sub(r"([.,;:!?|]) ", r"\1\n", text).split("\n"):
        if len(c) <= 96:
            found.append(c)
            continue
        for d in re.sub("([048DHLPTXdhlptx]) ", r"\1\n", c).split("\n"):
            if len(d) <= 64:
                found.append(d)
                continue
            lo = 0
            for i in range(1, len(d) + 1):
                if i == len(d) or ord(d[i - 1]) % 8 == 0:
                    found += [d[k:min(k + 64, i)] for k in range(lo, i, 64)]
                    lo = i
    return Counter(found)


def test_likeness_counts_leaves_and_cuts_any_script(spark):
    from quarry.llm import fingerprints

    rng = np.random.default_rng(7)
    kanji = [chr(0x4E00 + i) for i in rng.integers(0, 6000, 4000)]
    plain = " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(600))
    texts = ["".join(kanji), plain, "x" * 3000, "same line\n" * 500 + "other", "a. " * 3000, "", "word " * 9, "😀é" * 500, plain + "\n" + "tail " * 30]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(df).collect()}
    for i, t in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        q = len(t) // 4
        edited = t[:len(t) - q] + following[:q]
        for name, other in (("near_edited", edited), ("near_next", following)):
            a, b = brute_leaves(t), brute_leaves(other)
            size = lambda c: sum((len(x) + 1) * n for x, n in c.items())
            assert abs(got[i][name] - 2 * size(a & b) / (size(a) + size(b))) < 1e-12
    assert 0.65 < got[0]["near_edited"] < 0.85 and 0.65 < got[1]["near_edited"] < 0.85  # no punctuation: three quarters are left
    assert got[3]["near_edited"] < 0.9  # a line said often counts often


# ------------------------------------------------- language samples, one pass


def test_twenty_languages_in_one_pass(spark):
    from quarry.llm import langid

    rng = np.random.default_rng(11)
    syllables = ["".join(p) for p in zip(rng.choice(list("bdfgklmnprstvz"), 400), rng.choice(list("aeiouy"), 400), rng.choice(list("lmnrst "), 400))]
    rows = []
    for i in range(800):
        lang = i % 20
        own = syllables[lang * 20:lang * 20 + 20]
        text = " ".join("".join(rng.choice(own, rng.integers(1, 4))).strip() or "a" for _ in range(40))
        rows.append((i, text, f"l{lang:02d}"))
    rows += [(1000 + i, rows[0][1], "l00") for i in range(400)]  # a large group of copies is drawn row by row
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    drawn = langid.drawn(docs, {f"l{j:02d}": 0.5 for j in range(20)}, 9)
    copies = drawn.filter(F.col("text") == rows[0][1]).count()
    assert 140 < copies < 260
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, langid.fit(docs, sample=20)).collect()}
    assert np.mean([got[i] == lang for i, _, lang in rows]) > 0.9


def test_windows_cover_a_long_text(spark):
    from quarry.llm import langid

    texts = ["short", "".join(chr(97 + i // 5000) for i in range(100_000))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(langid.spread("text")).collect()]
    assert got[0] == "short" and len(got[1]) == langid.WINDOWS * langid.WINDOW_CHARS + langid.WINDOWS - 1
    assert got[1][0] == "a" and got[1][-1] == "t" and len(set(got[1])) > 4
