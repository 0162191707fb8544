
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import merge as MG
from quarry.operators.recipients import normalize_recipients

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 20), st.integers(0, 5)),
                   min_size=1, max_size=30)


@settings(max_examples=15, deadline=None)
@given(rows_st)
def test_keep_first_is_unique_and_minimal(spark, rows):
    df = spark.createDataFrame(rows, "k string, o int, v int")
    out = {r.k: (r.o, r.v) for r in MG.dedupe_first(df, "k", [F.col("o"), F.col("v")]).collect()}
    expected = {}
    for k, o, v in rows:
        expected[k] = min(expected.get(k, (o, v)), (o, v))
    assert out == expected


@settings(max_examples=10, deadline=None)
@given(rows_st)
def test_insert_if_absent_replay_is_idempotent(spark, rows):
    target = spark.createDataFrame([("a", 100, 0)], "k string, o int, v int")
    batch = spark.createDataFrame(rows, "k string, o int, v int")
    once = MG.insert_if_absent(target, batch, "k", [F.col("o"), F.col("v")])
    twice = MG.insert_if_absent(once, batch, "k", [F.col("o"), F.col("v")])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.select("k").distinct().count() == once.count()


elem_st = st.one_of(
    st.none(), st.integers(-3, 3), st.text(alphabet="ab@.", max_size=4),
    st.fixed_dictionaries({"email": st.text(alphabet="xy@", max_size=3)}, optional={"name": st.text(max_size=3)}),
)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(elem_st, max_size=4), st.just("junk")), min_size=1, max_size=8))
def test_recipient_rows_equal_sum_of_array_lengths(spark, cells):
    data = [(f"e{i}", None if c is None else (c if isinstance(c, str) else json.dumps(c))) for i, c in enumerate(cells)]
    df = spark.createDataFrame(data, "id string, recipients string")
    expected = sum(len(c) for c in cells if isinstance(c, list))
    assert normalize_recipients(df).count() == expected
