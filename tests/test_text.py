from pyspark.sql import functions as F

from quarry.functions import text as T


ENGLISH = {
    "running": "run", "runs": "run", "run": "run", "hoping": "hope", "hopped": "hop", "hope": "hope", "licensing": "licens",
    "license": "licens", "licenses": "licens", "licensed": "licens", "meetings": "meet", "tried": "try", "tries": "try",
    "died": "died", "quickly": "quick", "family": "family", "fly": "fly", "agreed": "agreed", "agree": "agree",
    "thing": "thing", "string": "string", "strings": "strings", "red": "red", "adding": "add", "houses": "hous",
    "house": "hous", "names": "name", "name": "name", "classes": "class", "class": "class", "showed": "show",
    "planned": "plan", "spelling": "spell", "acting": "act", "ing": "ing", "ed": "ed", "ly": "ly", "e": "e",
    "étoile": "étoil", "prêted": "prêted",
}


def _analyze(spark, s):
    return spark.createDataFrame([(s,)], "t string").select(T.analyze(F.col("t")).alias("a")).first().a


def test_stemmer_rules_match_python(spark):
    words = ["flies", "aies", "eies", "ies", "boxes", "toes", "trees", "aes", "cats", "bus", "glass",
             "s", "es", "is", "licenses", "tion", "tions", "ties", "runs", "ss", "us", *ENGLISH]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.s for r in df.select("w", T.stem(F.col("w")).alias("s")).collect()}
    assert got == {w: T.py_stem(w) for w in words}
    assert got["flies"] == "fly" and got["eies"] == "eies" and got["boxes"] == "boxe"
    assert {w: got[w] for w in ENGLISH} == ENGLISH
    assert got["toes"] == "toes" and got["cats"] == "cat" and got["bus"] == "bus" and got["glass"] == "glass"


def test_analyze_drops_stop_words_and_lowercases(spark):
    assert _analyze(spark, "The Cats and THE dogs, über-Fließ 42x") == ["cat", "dog", "über", "fließ", "42x"]
    assert _analyze(spark, None) == []
    assert _analyze(spark, "the and of") == []


def test_python_and_spark_analysis_agree(spark):
    s = "Éléphants qui mangent des pommes; les Enfants rient. Licenses, LICENSE and licensing!"
    assert _analyze(spark, s) == T.py_analyze(s)


def test_null_safe_concat_keeps_separator(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), (None, None)], "x string, y string")
    got = [r.c for r in df.select(T.null_safe_concat(F.col("x"), F.col("y")).alias("c")).collect()]
    assert got == ["a ", " b", " "]


def test_split_query():
    assert T.split_query("  a \t b\n") == ["a", "b"]
    assert T.split_query("   ") == []
    assert T.split_query(None) == []


def test_sql_stemmer_equals_column_stemmer(spark):
    words = ["flies", "aies", "eies", "ies", "boxes", "toes", "trees", "aes", "cats", "bus", "glass",
             "s", "es", "is", "licenses", "tion", "tions", "ties", "runs", "ss", "us", "it's", "über", *ENGLISH]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.select(T.stem(F.col("w")).alias("a"), F.expr(T.spark_sql_stem("w")).alias("b"),
                     F.expr(T.spark_sql_is_stop_word("w")).alias("stop")).collect()
    assert all(r.a == r.b for r in rows)
    assert [r.stop for r in rows][words.index("it's")] is True and [r.stop for r in rows][words.index("is")] is True


def test_sql_analyze_equals_column_analyze(spark):
    s = "The Cats' toes and THE dogs, über-Fließ 42x it's licenses"
    df = spark.createDataFrame([(s,)], "t string")
    r = df.select(T.analyze(F.col("t")).alias("a"),
                  F.expr(T.spark_sql_analyze(f"regexp_extract_all(lower(t), r'{T.TOKEN_PATTERN}', 0)")).alias("b")).first()
    assert r.a == r.b == T.py_analyze(s)


def test_duckdb_stemmer_equals_python():
    import itertools

    import duckdb

    heads = ["", "a", "b", "e", "str", "run", "runn", "hop", "hopp", "lov", "cre", "été", "x1", "add", "tri", "agre"]
    tails = ["", "s", "es", "ies", "ied", "ing", "ings", "ed", "eed", "ly", "kly", "e", "ee", "ees", "ss", "us", "y"]
    words = sorted({h + t for h, t in itertools.product(heads, tails)} | set(ENGLISH))
    con = duckdb.connect()
    got = con.execute(f"SELECT w, {T.sql_stem('w')} FROM (SELECT unnest(?) AS w)", [words]).fetchall()
    assert {w: s for w, s in got} == {w: T.py_stem(w) for w in words}


def test_inflected_words_are_found(spark):
    from quarry.operators.search import fts_match

    df = spark.createDataFrame([(1, "a running dog"), (2, "dogs run"), (3, "rung"), (4, "she runs quickly")], "id int, t string")
    assert sorted(r.id for r in fts_match(df, "t", "run").collect()) == [1, 2, 4]
    assert sorted(r.id for r in fts_match(df, "t", "running quick").collect()) == [4]
