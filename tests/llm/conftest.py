import pytest
from pyspark.sql import Row

SF = "/root/testdata/sf0.001"


SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "score double, _part int, fingerprint string, uid string")  # the last four clash with operators' own names


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    texts = ["", "a", "The cat sat on the mat, and the dog sat too. " * 3, None, "1 2 3 ... !!",
             "long words " * 40_000, "the cat\tsat\non the mat", "É LE çà Straße 日本  x", "x" * 50_000]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3], None, 0.5, 3, "f", "u") for i, t in enumerate(texts)]
    rows += [rows[2]] * 3 + [rows[1]] * 2 + [(None, "no id here", "en", "a", 1, None, None, None, None)] * 2
    rows += [(None, None, None, None, None, None, None, None, None), (50, texts[2], "en", "b", 1, 0.1, 1, "g", "v")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([Row(doc_id=i, quality=i % 2, toxic=(i + 1) % 2, extra="x") for i in range(9)]
                                 + [Row(doc_id=2, quality=1, toxic=None, extra=None), Row(doc_id=None, quality=1, toxic=1, extra=None)])


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def tokenizer():
    from quarry.llm.queries import tokenizer_path

    return tokenizer_path("byte_bpe_50k.json")
