from pyspark.sql import functions as F

from quarry.operators import entities as EN


def test_assemble_children_edge_cases(spark):
    docs = spark.createDataFrame([("d1", "Doc one"), ("d2", "No pages")], "id string, title string")
    pages = spark.createDataFrame(
        [("d1", 2, "second"), ("d1", None, "unnumbered"), ("d1", 1, "first"), ("orphan", 1, "lost")],
        "doc_id string, page_number int, text string")
    out = {r.id: r for r in EN.assemble_children(docs, pages, "id", "doc_id", ["page_number"],
                                                 ["page_number", "text"], "pages").collect()}
    assert set(out) == {"d1", "d2"}  # children without a parent give no row
    assert [p.text for p in out["d1"].pages] == ["first", "second", "unnumbered"]  # NULLS LAST
    assert out["d2"].pages == []


def test_ordered_text_agg_nulls_last(spark):
    pages = spark.createDataFrame([("d", 2, "b"), ("d", None, "z"), ("d", 1, "a"), ("d", 3, None)],
                                  "doc_id string, page_number int, text string")
    r = EN.ordered_text_agg(pages, "doc_id", ["page_number"], "text").first()
    assert r.full_text == "a\nb\nz" and r.n_parts == 4


def test_children_rows_streams_sorted(spark):
    docs = spark.createDataFrame([("d1",)], "id string")
    pages = spark.createDataFrame([("d1", 2), ("d1", 1)], "doc_id string, page_number int")
    rows = EN.children_rows(docs, pages, "id", "doc_id", ["page_number"]).collect()
    assert [r.page_number for r in rows] == [1, 2]


def test_lookup_with_key_frame_and_ilike_paging(spark):
    df = spark.createDataFrame([(i, f"name{i}") for i in range(10)], "id long, name string")
    keys = spark.createDataFrame([(3,), (5,), (3,)], "k long")
    assert sorted(r.id for r in EN.lookup_keys(df, "id", keys).collect()) == [3, 5]
    page = EN.ilike_search(df, "id", ["name"], "NAME", limit=3, offset=2).collect()
    assert [r.id for r in page] == [2, 3, 4]
    assert EN.filter_composite(df, id=4, name="name4").count() == 1
