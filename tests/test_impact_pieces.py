"""Ranked reading from the top; families in bounded pieces."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import impact as IM
from quarry.operators import index as IX
from quarry.operators import pieces as PC
from quarry.operators.entities import assemble_children, ordered_text_agg


@pytest.fixture(scope="module")
def stored(spark):
    rng = random.Random(9)
    rows = []
    for i in range(900):
        words = ["hot"] * (min(int(rng.paretovariate(0.7)), 200) if i % 3 == 0 else 0)  # a term in a third of the pages
        words += ["warm"] * (rng.randrange(1, 9) if i % 5 == 0 else 0) + ["rare"] * (i % 211 == 0) + ["other"] * rng.randrange(4)
        rng.shuffle(words)
        rows.append((i // 2, i % 2, " ".join(words)))
    df = spark.createDataFrame(rows, "id long, page long, text string")
    index = IX.index_rows(df, "t", "id", "text", "page").cache()
    path = tempfile.mkdtemp(prefix="quarry-test-") + "/impacts"
    IM.write_impacts(index, path)
    return index, path


@pytest.mark.parametrize("query", ["hot", "warm", "hot warm", "rare hot", "rare", "hot warm other", "nothing", "hot nothing"])
@pytest.mark.parametrize("limit", [1, 7, 20, 1000])
def test_top_k_equals_full_ranking(spark, stored, query, limit):
    index, path = stored
    want = IX.search_index(index, query, "t").orderBy(F.col("score").desc(), "entity_id", "page").limit(limit)
    got = IM.top_k(spark, path, query, "t", limit)
    assert [tuple(r) for r in got.hits.collect()] == [tuple(r)[1:] for r in want.collect()]
    assert got.read <= got.total
    if query == "hot" and limit == 7:  # a term in a third of the pages
        assert got.read < got.total / 2


def test_top_k_filters_reach_the_scan(spark, stored):
    with pytest.raises(ValueError):
        IM.top_k(spark, stored[1], "hot !warm", "t")
    rows = spark.read.parquet(f"{stored[1]}/postings").filter("entity_type = 't' AND term = 'hot' AND level >= 3")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,hot)" in plan and "GreaterThanOrEqual(level,3)" in plan


@pytest.fixture(scope="module")
def family(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, None, 3]), rng.choice([None, rng.randrange(9)]), rng.choice(["é" * rng.randrange(30), "x", "", None]))
            for _ in range(600)]
    return spark.createDataFrame(rows + [(7, 1, None), (8, 1, None), (8, 2, "a"), (8, 3, None), (8, 4, "y" * 500)], "k int, o int, t string")


@pytest.mark.parametrize("limit", [1, 40, 10_000])
@pytest.mark.parametrize("sep", ["\n", "", " - "])
def test_text_pieces_join_to_the_whole(family, limit, sep):
    whole = {r.k: (r.full_text, r.n_parts) for r in ordered_text_agg(family, "k", ["o", "t"], "t", sep).collect()}
    rows = PC.text_pieces(family, "k", ["o", "t"], "t", sep, limit).collect()
    for k, (text, n) in whole.items():
        mine = sorted((r for r in rows if r.k == k), key=lambda r: r.piece)
        assert "".join(r.text for r in mine) == text and sum(r.n_parts for r in mine) == n
        assert all(len(r.text.encode()) < limit + 500 + 2 * len(sep) for r in mine)
    assert {r.k for r in rows} == whole.keys()


@pytest.mark.parametrize("limit", [1, 100, 10_000])
def test_children_pieces_join_to_the_whole(spark, family, limit):
    parents = spark.createDataFrame([(1, "p"), (2, "p"), (4, "none"), (None, "n")], "id int, name string")
    want = {r.id: [tuple(c) for c in r.children] for r in
            assemble_children(parents, family, "id", "k", ["o", "t"], ["o", "t"]).collect()}
    rows = PC.children_pieces(parents, family, "id", "k", ["o", "t"], ["o", "t"], limit).collect()
    for k, children in want.items():
        mine = sorted((r for r in rows if r.id == k), key=lambda r: r.piece)
        assert [tuple(c) for r in mine for c in r.children] == children
        assert limit > 1 or not children or len(mine) == len(children)
    assert {r.id for r in rows} == want.keys()
