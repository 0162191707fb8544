"""Places in the index, phrases and distances, best covers of headlines."""

import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.functions import text as T
from quarry.operators import index as IX
from quarry.operators import search as S


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, 1, "red car red car red"),
        (1, 2, "car"),
        (2, 1, "red the car"),
        (2, 2, "red blue car and red cars"),
        (3, 1, "ends with red"),
        (3, 2, "car begins the next page"),
        (4, 1, None),
        (5, 1, "red car"), (5, 1, "red car"),  # a repeated row
    ]
    return spark.createDataFrame(rows, "id long, page long, text string")


def brute(text, phrase):
    toks = T.py_tokens(text or "")
    terms = {i: T.py_stem(t) for i, t in enumerate(toks) if not T.py_is_stop_word(t)}
    test = lambda want, have: have.startswith(want[:-1]) if want.endswith("*") else have == want
    return sum(all(i + d in terms and test(t, terms[i + d]) for t, d in phrase) for i in range(len(toks)))


def test_phrase_clauses():
    kinds = [(c.kind, c.terms, c.phrases) for c in S.parse_query("red<->cars a<->the cat<->on<->mats x<3>y:* !p<->q")]
    assert kinds == [
        ("phrase", ("red", "car"), ((("red", 0), ("car", 1)),)),
        ("phrase", ("cat", "mat"), ((("cat", 0), ("mat", 2)),)),  # "on" keeps its place
        ("phrase", ("x", "y*"), ((("x", 0), ("y*", 3)),)),
        ("not", ("p", "q"), ((("p", 0), ("q", 1)),)),
    ]
    assert S.parse_query("the<->car") == [S.Clause("term", ("car",))]
    assert S.parse_query("the<->a") == []


@pytest.mark.parametrize("query", ["red<->car", "red<2>car", "car<->red", "red<->car<->red", "red<->ca:*", "red<4>car",
                                   "red|blue<->car", "red !red<->car"])
def test_phrases_on_scan_and_index_agree_with_definition(spark, pages, query):
    found = {(r.id, r.page): r.score for r in S.fts_match(pages, "text", query).collect()}
    want = {}
    for r in pages.collect():
        counts = []
        for c in S.parse_query(query):
            alts = c.phrases or tuple(((t, 0),) for t in c.terms)
            n = sum(brute(r.text, p) for p in alts)
            if not c.positive:
                if n:
                    break
            else:
                counts.append(n)
        else:
            if all(counts):
                want[(r.id, r.page)] = round(sum(n / (n + 1.2) for n in counts) / len(counts), 6)
    assert found == want
    idx = IX.index_rows(pages, "t", "id", "text", "page", positions=True)
    hits = {(int(r.entity_id), r.page): r.score for r in IX.search_index(idx, query).collect()}
    assert hits.keys() == want.keys()  # phrases don't span pages, repeated rows are one hit
    assert all(hits[k] == v for k, v in want.items() if k != (5, 1))


def test_phrase_needs_positions(pages):
    with pytest.raises(ValueError, match="positions"):
        IX.search_index(IX.index_rows(pages, "t", "id", "text", "page"), "red<->car")


def test_positions_of_postings(pages):
    idx = IX.index_rows(pages, "t", "id", "text", "page", positions=True)
    got = {(r.entity_id, r.page, r.term): (r.tf, r.positions) for r in IX.postings(idx).collect()}
    assert got["1", 1, "red"] == (3, [0, 2, 4]) and got["2", 1, "car"] == (1, [2])
    assert got["5", 1, "car"] == (2, [1])  # equal rows add up in tf and share their places
    known = {(r.entity_id, r.page): r.copies for r in IX.page_rows(idx).collect()}
    assert known["5", 1] == 2 and known["4", 1] == 1 and len(known) == 8


def test_increment_counts_repeated_rows(spark, pages):
    first = IX.index_rows(pages, "t", "id", "text", "page", positions=True)
    second = pages.dropDuplicates().filter("id <> 3 OR page <> 1").unionByName(
        spark.createDataFrame([(6, 1, "red new"), (1, 2, "car")], pages.schema))
    inc = IX.index_increment(first, second, "t", "id", "text", "page")
    full = IX.index_rows(second, "t", "id", "text", "page", positions=True)
    assert sorted(map(str, inc.collect())) == sorted(map(str, full.select(inc.columns).collect()))


def best_fragments(words, hits, width, frags, lead):
    """The rule of headlines by comparing all runs."""
    n = len(words)

    def best(lo, hi):
        runs = []
        at = [i for i in range(lo, hi) if hits[i]]
        for i, j in itertools.product(at, at):
            if i <= j < i + width:
                runs.append((-len(set().union(*(hits[k] for k in at if i <= k <= j))), j - i, i, j))
        if not runs:
            return None
        *_, i, j = min(runs)
        return max(lo, min(i - min(lead, width - (j - i + 1)), hi - width)), min(runs)[:3]

    one = best(0, n)
    if one is None:
        return None
    spans = [(one[0], min(one[0] + width, n))]
    if frags > 1:
        sides = [(best(0, one[0]), one[0]), (best(one[0] + width, n), n)]
        sides = [(b[1], b[0], end) for b, end in sides if b]
        if sides:
            _, s, end = min(sides)
            spans.append((s, min(s + width, end)))
    show = lambda a, b: " ".join(f"<b>{w}</b>" if h else w for w, h in zip(words[a:b], hits[a:b]))
    return " ... ".join(show(a, b) for a, b in sorted(spans))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["red", "cars", "lid-red", "x", "y", "z", "w"]), max_size=40), min_size=1, max_size=6))
def test_best_cover_equals_definition(spark, texts):
    query = "red car li:*"
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "id long, text string")
    for frags in (1, 2):
        got = {r.id: r.snippet for r in S.with_headline(df, "text", query, max_words=6, min_words=3, max_fragments=frags,
                                                       lead=2).collect()}
        for i, words in enumerate(texts):
            hits = [{h for t in T.py_analyze(w) for h in ("red", "car", "li*")
                     if (t.startswith("li") if h == "li*" else t == h)} for w in words]
            want = best_fragments(words, hits, 6, frags, 2)
            assert got[i] == (" ".join(words[:3]) if want is None else want)


def test_cover_prefers_different_terms(spark):
    text = "lantern lantern lantern " + "x " * 40 + "harbor y lantern " + "z " * 40
    df = spark.createDataFrame([(1, text)], "id long, text string")
    snip = S.with_headline(df, "text", "harbor lantern", max_words=10).first().snippet
    assert "<b>harbor</b> y <b>lantern</b>" in snip
