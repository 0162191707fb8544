"""Index segments with tombstones; the trigram index."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import grams as GR
from quarry.operators import index as IX
from quarry.operators import segments as SG
from quarry.operators.entities import ilike_any
from quarry.operators.fuzzy import fuzzy_match
from quarry.sources.tables import table_path

from conftest import SF_SMALL


def rows_of(df):
    return sorted(map(str, df.collect()))


def folder(name):
    return tempfile.mkdtemp(prefix="quarry-test-") + "/" + name


def check_live(spark, path, snapshot):
    full = IX.index_rows(snapshot, "t", "id", "text", "page", positions=True)
    live = SG.read_index(spark, path)
    assert rows_of(live.select(*full.columns)) == rows_of(IX.postings(full))
    pages = IX.page_rows(full)
    assert rows_of(SG.read_pages(spark, path).select(*pages.columns)) == rows_of(pages)


def test_refreshes_equal_rebuilds(spark):
    rng = random.Random(4)
    words = ["red", "car", "cars", "harbor", "lantern", "run", "running", "the"]
    state = {(i, p): [" ".join(rng.choices(words, k=rng.randrange(0, 9)))] * rng.choice([1, 1, 2])
             for i in range(12) for p in (1, 2, None)}
    df = lambda: spark.createDataFrame([(i, p, t) for (i, p), ts in state.items() for t in ts], "id long, page long, text string")
    path = folder("index")
    SG.create(IX.index_rows(df(), "t", "id", "text", "page", positions=True), path)
    check_live(spark, path, df())
    for step in range(4):
        for key in rng.sample(sorted(state, key=str), 6):
            kind = rng.randrange(4)
            if kind == 0:
                del state[key]
            elif kind == 1:  # one row more or less of the same text
                state[key] = state[key][:1] * rng.choice([1, 2, 3])
            else:  # edited, perhaps back to an earlier text
                state[key] = [rng.choice(["red car", "car red", "lantern"])] * rng.choice([1, 2])
        state[100 + step, 1] = [None]
        before = SG.live_segments(spark, path)
        assert SG.refresh(spark, path, df(), "t", "id", "text", "page") == before[-1] + 1
        check_live(spark, path, df())
        if step == 2:
            assert SG.live_segments(spark, path) == [1, 2, 3, 4]
            seg = SG.compact(spark, path)
            assert SG.live_segments(spark, path) == [seg]
            check_live(spark, path, df())
    last = SG.live_segments(spark, path)[-1]
    assert SG.refresh(spark, path, df(), "t", "id", "text", "page") == last  # nothing changed, nothing written
    hits = {(int(r.entity_id), r.page) for r in IX.search_index(SG.read_index(spark, path), "red<->car").collect()}
    assert hits == {(i, p) for (i, p), ts in state.items() if any(IX and t and "red car" in t.replace("cars", "car") for t in ts)}


def test_refresh_writes_only_the_change(spark):
    d = spark.read.parquet(table_path(SF_SMALL, "documents")).select("doc_id", "text")
    path = folder("index")
    SG.create(IX.index_rows(d, "document", "doc_id", "text"), path)
    second = d.withColumn("text", F.when(F.col("doc_id") == 3, F.lit("new words")).otherwise(F.col("text"))).filter("doc_id <> 5")
    SG.refresh(spark, path, second, "document", "doc_id", "text")
    seg = spark.read.option("basePath", f"{path}/postings").parquet(f"{path}/postings/seg=2")
    assert {r.term for r in seg.collect()} == {"new", "word"}
    assert {r.entity_id for r in spark.read.parquet(f"{path}/dead/seg=2").collect()} == {"3", "5"}
    plan = IX.search_index(SG.read_index(spark, path), "tion")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(term,tion)") >= 1 and "LeftAnti" in plan


def test_refresh_that_was_cut_off_is_invisible(spark):
    path = folder("index")
    first = spark.createDataFrame([(1, "red")], "id long, text string")
    SG.create(IX.index_rows(first, "t", "id", "text"), path)
    orphan = IX.postings(IX.index_rows(spark.createDataFrame([(9, "lost")], first.schema), "t", "id", "text"))
    SG._write_postings(orphan, path, 2)  # no page rows, no tombstones, no line in the log
    assert [r.term for r in SG.read_index(spark, path).collect()] == ["red"]
    SG.refresh(spark, path, spark.createDataFrame([(2, "blue")], first.schema), "t", "id", "text")
    assert [r.term for r in SG.read_index(spark, path).collect()] == ["blue"]


def test_types_and_fresh_types_keep_apart(spark):
    path = folder("index")
    a = spark.createDataFrame([(1, "red")], "id long, text string")
    SG.create(IX.index_rows(a, "a", "id", "text"), path)
    SG.refresh(spark, path, spark.createDataFrame([(1, "blue")], a.schema), "b", "id", "text")
    assert sorted((r.entity_type, r.term) for r in SG.read_index(spark, path).collect()) == [("a", "red"), ("b", "blue")]


# ------------------------------------------------------------- trigram index


@pytest.fixture(scope="module")
def names(spark):
    rng = random.Random(2)
    parts = ["Jon", "John", "Jöhn", "son", "sen", "Ann", "A", "of", "Van der", "O'Neil", "x", "red ring", "%", "_", ""]
    rows = [(i, " ".join(rng.choices(parts, k=rng.randrange(0, 4))), rng.choice(parts + [None])) for i in range(400)]
    return spark.createDataFrame(rows + [(500, None, None), (501, "100% sure_thing", "back\\slash")], "id long, name string, note string")


@pytest.fixture(scope="module")
def stored(spark, names):
    path = folder("grams")
    GR.write_grams(GR.gram_rows(names, "id", ["name", "note"]), path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("query", ["John", "jonson", "red rings", "Van der Jon", "zzz", "", "a"])
@pytest.mark.parametrize("threshold", [0.3, 0.5, 1.0])
def test_fuzzy_from_index_equals_scan(names, stored, query, threshold):
    want = [tuple(r) for r in fuzzy_match(names, "id", "name", query, threshold, 10).collect()]
    assert [tuple(r) for r in GR.fuzzy_indexed(stored, names, "id", "name", query, threshold, 10).collect()] == want


@pytest.mark.parametrize("text", ["john", "ohn", "son", "n s", "Van der", "d%r", "red_ring", "0% s", "x", "", "oh", "O'Neil",
                                  "back\\", "JÖHN", "ring red", "jon son"])
def test_contains_from_index_equals_scan(names, stored, text):
    want = {r.id for r in names.filter(ilike_any(names, ["name", "note"], text)).collect()}
    assert {r.id for r in GR.ilike_indexed(stored, names, "id", ["name", "note"], text).collect()} == want


def test_index_reads_its_grams_only(names, stored):
    plan = GR.fuzzy_scores(stored, "name", "johnson", 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(gram" in plan and "GreaterThanOrEqual(n_grams" in plan
    tested = GR.contains_candidates(stored, ["name"], "red ring").count()
    assert 0 < tested < names.count() / 2  # rows that are tested for the whole pattern
    assert GR.contains_candidates(stored, ["name"], "x%") is None
    with pytest.raises(ValueError):
        GR.fuzzy_scores(stored, "name", "x", 0.0)
