"""Steps that grew faster than their input: what they now do once, and that
the results stand."""

import random
import tempfile

from pyspark.sql import functions as F

from quarry.functions.text import py_analyze, py_tokens
from quarry.functions.trigram import py_trigrams
from quarry.operators import grams as GR
from quarry.operators import impact as IM
from quarry.operators import index as IX
from quarry.operators import segments as SG
from quarry.plans.ingest import load_table

WORDS = ["red", "cars", "car", "running", "licenses", "the", "agreed", "flies", "sadly", "being", "Straße", "x9", "use", "bus"]


def folder() -> str:
    return tempfile.mkdtemp(prefix="quarry-steps-") + "/out"


def texts(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(0, 12)))) for i in range(60)]
    rows += rows[:7] + rows[:3] + [(90, None), (90, ""), (None, "red cars"), (None, "red car"), (91, "the the")]
    return spark.createDataFrame(rows, "id long, text string")


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def by_hand(df) -> dict:
    want: dict = {}
    for r in df.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect():
        for term in [IX.PAGE, *py_analyze(r.text or "")]:
            where = (None if r.id is None else str(r.id), term, r.h)
            want[where] = want.get(where, 0) + 1
    return want


def test_terms_are_counted_inside_their_row(spark):
    df = texts(spark)
    rows = IX.index_rows(df, "t", "id", "text")
    assert {(r.entity_id, r.term, r.content_hash): r.tf for r in rows.collect()} == by_hand(df)
    assert plan_of(rows).count("Aggregate [") == 1  # of texts, none of postings


def test_places_inside_their_row(spark):
    df = texts(spark)
    rows = IX.index_rows(df, "t", "id", "text", positions=True)
    assert {(r.entity_id, r.term, r.content_hash): r.tf for r in rows.collect()} == by_hand(df)
    for r in rows.filter("entity_id = '4'").collect():
        text = df.filter("id = 4").first().text
        assert r.positions == [i for i, t in enumerate(py_tokens(text)) if py_analyze(t) == [r.term]]


def test_stored_forms_compute_their_rows_once(spark):
    """A range exchange would run all before it a second time, for a sample."""
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    df = texts(spark)
    n = df.count()
    once = df.mapInArrow(counted, df.schema)
    index = IX.index_rows(df, "t", "id", "text")
    m = index.count()
    for write, rows, size in ((lambda r: IX.write_index(r, folder()), index, m),
                              (lambda r: IX.write_index(r, folder(), files=3), index, m),
                              (lambda r: SG.create(r, folder()), index, m),
                              (lambda r: IM.write_impacts(r, folder()), index, m),
                              (lambda r: GR.write_grams(GR.gram_rows(r, "id", ["text"]), folder()), once, n)):
        calls.value = 0
        write(rows if rows is once else rows.mapInArrow(counted, rows.schema))
        assert calls.value == size


def test_segments_keep_their_page_table(spark):
    df, path = texts(spark), folder()
    index = IX.index_rows(df, "t", "id", "text")
    SG.create(index, path)
    known = sorted(map(str, SG.read_pages(spark, path).collect()))
    assert known == sorted(map(str, IX.page_rows(index).collect()))
    assert SG.read_index(spark, path).filter(F.col("term") == IX.PAGE).count() == 0


def test_increment_of_odd_rows_equals_a_rebuild(spark):
    df = texts(spark)
    first = df.filter("id is null or id % 3 <> 1").unionByName(spark.createDataFrame([(500, "gone")], df.schema))
    got = IX.index_increment(IX.index_rows(first, "t", "id", "text"), df, "t", "id", "text")
    assert sorted(map(str, got.collect())) == sorted(map(str, IX.index_rows(df, "t", "id", "text").select(*got.columns).collect()))


def test_trigrams_of_repeated_words(spark):
    df = spark.createDataFrame([(1, "red red Red ring x ring"), (2, None), (3, "--")], "id long, text string")
    got: dict = {}
    for r in GR.gram_rows(df, "id", ["text"]).collect():
        got.setdefault(r.id, []).append((r.gram, r.n_grams))
    want = py_trigrams("red red Red ring x ring")
    assert got == {1: [(g, len(want)) for g in want]}


def test_keyed_load_maps_only_rows_that_stay(spark):
    src, out = folder(), folder()
    rows = [(k, i, f"v{i}") for i, k in enumerate([3, 1, None, 3, 1, None, 2])]
    spark.createDataFrame(rows, "k long, i long, `a b` string").coalesce(1).write.parquet(src)
    df = spark.read.parquet(src)
    asked = []
    real = type(df).groupBy

    def grouped(self, *cols):
        asked.append(self.columns)
        return real(self, *cols)

    type(df).groupBy = grouped
    try:
        got = load_table(spark, df, out, [("k", "str"), ("i", "int"), ("a b", "str")], "k")
    finally:
        type(df).groupBy = real
    assert got == (7, 5) and asked and all("raw_json" not in c for c in asked)
    stored = {(r.k, r.i, r["a b"], r.raw_json) for r in spark.read.parquet(out).collect()}
    kept = [rows[0], rows[1], rows[2], rows[5], rows[6]]
    assert {(k, i, v) for k, i, v, _ in stored} == {(None if k is None else str(k), i, v) for k, i, v in kept}
    assert all(f'"i":{i},"a b":"v{i}"' in js for _, i, _, js in stored)


def test_the_language_model_learns_from_every_document(spark, monkeypatch):
    from quarry.llm import lm
    from quarry.llm.queries import tokenizer_path

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(WORDS, k=9))) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = {}
    for name in ("refine", "ratios"):
        def asked(*args, real=getattr(lm, name), name=name):
            seen[name] = next(a for a in args if hasattr(a, "sparkSession") and "doc_id" in a.columns).count()
            return real(*args)
        monkeypatch.setattr(lm, name, asked)
    lm.fit(docs, tokenizer_path("byte_bpe_50k.json"), sample=20)
    assert seen == {"refine": 700, "ratios": 700}
