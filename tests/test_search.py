from pyspark.sql import functions as F

from quarry.operators import search as S
from quarry.plans.search_all import SearchTables, check_paging, search_all

import pytest


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "Harbors lantern about records"),
        (2, "lanterns lanterns lanterns with harbor"),
        (3, "nothing relevant here"),
        (4, None),
        (5, "harbor only"),
        (6, " ".join(["filler"] * 40) + " harbor lantern " + " ".join(["tail"] * 40)),
        (7, "short harbor lantern"),
    ]
    return spark.createDataFrame(rows, "id long, text string")


def test_parse_query_operators():
    cl = S.parse_query("cats !dogs lic:* a|bees the")  # "a" is a stop word; "bees" keeps its "ees"
    kinds = [(c.kind, c.terms) for c in cl]
    assert kinds == [("term", ("cat",)), ("not", ("dog",)), ("prefix", ("lic",)), ("any", ("bees",))]


def test_all_terms_required_and_plural_matches_singular(docs):
    got = sorted(r.id for r in S.fts_match(docs, "text", "harbor lantern").collect())
    assert got == [1, 2, 6, 7]


def test_stop_word_only_query_matches_nothing(docs):
    assert S.fts_match(docs, "text", "the and").count() == 0
    assert S.fts_match(docs, "text", "").count() == 0


def test_rank_rewards_repetition_and_ties_break_by_id(docs):
    top = S.fts_rank(docs, "id", "text", "lantern", limit=10).collect()
    assert top[0].id == 2  # three occurrences
    assert [r.id for r in top[1:]] == [1, 6, 7]  # equal scores, id order
    assert top[0].score == round(3 / 4.2, 6)


def test_rank_offset(docs):
    assert [r.id for r in S.fts_rank(docs, "id", "text", "lantern", limit=2, offset=1).collect()] == [1, 6]


def test_boolean_operators(docs):
    ids = lambda q: sorted(r.id for r in S.fts_match(docs, "text", q).collect())
    assert ids("harbor !lantern") == [5]
    assert ids("lant:*") == [1, 2, 6, 7]
    assert ids("records|relevant") == [1, 3]


def test_headline_window_and_highlight(spark, docs):
    out = {r.id: r.snippet for r in S.with_headline(docs, "text", "harbor lantern").select("id", "snippet").collect()}
    assert out[7] == "short <b>harbor</b> <b>lantern</b>"
    words = out[6].split(" ")
    assert len(words) == 30 and words[10] == "<b>harbor</b>" and words[11] == "<b>lantern</b>"
    assert out[3] == "nothing relevant here"  # no match: first words
    assert out[4] == ""


def test_headline_two_fragments(spark):
    text = " ".join(["a1"] * 5 + ["hit"] + ["b1"] * 60 + ["hit"] + ["c1"] * 5)
    df = spark.createDataFrame([(1, text)], "id long, text string")
    snip = S.with_headline(df, "text", "hit", max_words=40, max_fragments=2).first().snippet
    first, second = snip.split(" ... ")
    assert first.split(" ")[5] == "<b>hit</b>" and len(first.split(" ")) == 40
    assert "<b>hit</b>" in second


def test_match_plan_has_no_shuffle_or_python(docs):
    plan = S.fts_rank(docs, "id", "text", "harbor lantern")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BatchEvalPython" not in plan


@pytest.fixture(scope="module")
def tables(spark):
    people = spark.createDataFrame([(1, "Ann 100% Smith", "x"), (2, "Bob_Jones", "desc harbor"), (3, "Cy", None)],
                                   "id long, name string, description string")
    photos = spark.createDataFrame([(10, "harbor photo", None, "a", None, "vol1"), (11, None, "harbor.jpg", None, None, "")],
                                   "id long, title string, filename string, description string, date_taken string, volume string")
    msgs = spark.createDataFrame([(5, None, "harbor are here", None, "slug")],
                                 "id long, sender string, body string, date string, conversation_slug string")
    emails = spark.createDataFrame([(1, "", "x@y", "talk about harbor", None, None),
                                    (2, "harbor subject", "harbor@corp", None, None, "b1")],
                                   "id long, subject string, sender string, body string, date string, release_batch string")
    return SearchTables(emails=emails, messages=msgs, people=people, photos=photos)


def test_search_all_merges_branches(spark, tables):
    rows = search_all(spark, tables, "harbor").collect()
    types = [r.entity_type for r in rows]
    # person/photo hits score 1.0 and rank first; ties keep branch order
    assert types[:3] == ["person", "photo", "photo"]
    emails = [r for r in rows if r.entity_type == "email"]
    assert {r.entity_id for r in emails} == {"1", "2"}
    assert [r.title for r in emails if r.entity_id == "1"] == ["(no subject)"]
    msg = [r for r in rows if r.entity_type == "message"][0]
    assert msg.title == "Message from unknown" and msg.source == "slug"


def test_search_all_guards(spark, tables):
    assert search_all(spark, tables, "   ").count() == 0
    assert search_all(spark, tables, "harbor", type="videos").count() == 0
    assert {r.entity_type for r in search_all(spark, tables, "harbor", type="people").collect()} == {"person"}


def test_like_wildcards_pass_through(spark, tables):
    assert [r.entity_id for r in search_all(spark, tables, "100%", type="people").collect()] == ["1"]
    assert [r.entity_id for r in search_all(spark, tables, "b_j", type="people").collect()] == ["2"]


def test_offset_applies_per_branch(spark, tables):
    rows = search_all(spark, tables, "harbor", type="all", offset=1).collect()
    assert [r.entity_type for r in rows].count("photo") == 1


def test_paging_policy():
    assert check_paging(None, None) == (20, 0)
    assert check_paging(500, 3) == (500, 3)
    with pytest.raises(ValueError):
        check_paging(-1, 0)


def test_sender_only_term_found_by_index_not_by_search(spark):
    from quarry.functions.text import null_safe_concat
    from quarry.operators import index as IX

    emails = spark.createDataFrame([(1, "hello", "lighthouse@corp", "plain body", None, None)],
                                   "id long, subject string, sender string, body string, date string, release_batch string")
    tables = SearchTables(emails=emails)
    assert search_all(spark, tables, "lighthouse").count() == 0  # search text = subject + body
    idx = IX.index_rows(emails.select("id", null_safe_concat(F.col("subject"), F.col("body"), F.col("sender")).alias("t")),
                        "email", "id", "t")
    assert IX.search_index(idx, "lighthouse").count() == 1  # stored vector includes the sender


def test_text_is_analysed_once_per_row(docs):
    plan = S.fts_match(docs, "text", "harbor lantern")._jdf.queryExecution().executedPlan().toString()
    # one candidate-token extraction over the text column; the match lives in the generator
    assert plan.count("regexp_extract_all(lower(coalesce(text") == 1
    assert "Generate" in plan
