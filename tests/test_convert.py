import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import convert as C


def _conv(spark, fn, schema, values):
    df = spark.createDataFrame([(v,) for v in values], schema)
    dtype = df.schema[0].dataType
    return [r.o for r in df.select(fn(F.col("v"), dtype).alias("o")).collect()]


def test_safe_int(spark):
    assert _conv(spark, C.safe_int, "v string", [None, "12", "12.7", "x", "", " 7 ", "99999999999"]) == \
        [None, 12, None, None, None, 7, None]
    assert _conv(spark, C.safe_int, "v double", [12.7, -12.7, None]) == [12, -12, None]
    assert _conv(spark, C.safe_int, "v boolean", [True, False]) == [1, 0]


def test_safe_bool_truthiness(spark):
    assert _conv(spark, C.safe_bool, "v string", [None, "", "false", "0"]) == [None, False, True, True]
    assert _conv(spark, C.safe_bool, "v long", [0, 1, None]) == [False, True, None]
    assert _conv(spark, C.safe_bool, "v boolean", [True, False]) == [True, False]


def test_safe_str(spark):
    assert _conv(spark, C.safe_str, "v boolean", [True, False, None]) == ["True", "False", None]
    assert _conv(spark, C.safe_str, "v long", [5]) == ["5"]


def test_safe_timestamp(spark):
    got = _conv(spark, C.safe_timestamp, "v string", ["2024-01-02T03:04:05Z", "2024-01-02", "garbage", None])
    assert got[0] == dt.datetime(2024, 1, 2, 3, 4, 5) and got[1] == dt.datetime(2024, 1, 2)
    assert got[2] is None and got[3] is None


def test_safe_json(spark):
    got = _conv(spark, C.safe_json, "v string", [None, '{"a": 1}', "[1, 2]", "plain text", "5", '"q"'])
    assert got == [None, '{"a":1}', "[1,2]", '"plain text"', "5", '"q"']
    assert _conv(spark, C.safe_json, "v string", ['{"a": 1, "a": 2}']) == ['{"a":2}']  # last key wins
    assert _conv(spark, C.safe_json, "v long", [5]) == ['"5"']
    assert _conv(spark, C.safe_json, "v boolean", [True]) == ['"True"']
    assert _conv(spark, C.safe_json, "v array<long>", [[1, 2]]) == ["[1,2]"]
    assert _conv(spark, C.safe_json, "v struct<a:long>", [(1,)]) == ['{"a":1}']


def test_raw_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a long, b string")
    assert df.select(C.raw_json(df).alias("j")).first().j == '{"a":1,"b":null}'


def test_truthy_coalesce(spark):
    df = spark.createDataFrame([("", "d1", 0, 3, ""), ("i2", "d2", 0, None, "t")],
                               "id string, doc_id string, page_number int, page int, text string")
    out = df.select(C.truthy_coalesce(df, ["id", "doc_id", "document_id"]).alias("d"),
                    C.truthy_coalesce(df, ["page_number", "page"]).alias("p"),
                    C.truthy_coalesce(df, ["text", "content", "extracted_text"]).alias("t")).collect()
    assert [(r.d, r.p, r.t) for r in out] == [("d1", 3, None), ("i2", None, "t")]


def test_adaptive_select_missing_columns_are_typed_nulls(spark):
    df = spark.createDataFrame([(1, "x", "extra")], "id long, name string, other string")
    out = C.adaptive_select(df, {"id": ("id", "str"), "name": ("name", "str"), "n": ("absent", "int")},
                            with_raw_json=True)
    assert out.schema["n"].dataType == T.IntegerType()
    r = out.first()
    assert (r.id, r.name, r.n) == ("1", "x", None) and '"other":"extra"' in r.raw_json
