import pytest

from llm_helpers import words

SF = "/root/testdata/sf0.001"
#: extra columns whose names the operators use inside
CLASHES = ("score", "hits", "items", "row", "bucket", "a", "b", "key", "label", "node", "component", "range", "tail", "edges",
           "blob", "rep", "block", "length", "place", "part", "payload", "digest", "value", "formatted", "position", "n_words", "changed")
LONG = "Lorem ipsum dolor sit amet, " * 40_000


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    base = words(60)
    rows = [(1, base, "en", "s", 5), (2, base, None, "s", None), (3, base + " tail", "en", None, 1), (3, base + " tail", "en", None, 1),
            (4, None, None, None, None), (5, "", "en", "s", 0), (6, " \n\t ", "en", "s", 4), (None, base, "en", "s", 1), (None, None, None, None, None),
            (7, "x", "en", "s", 1), (8, "é日本😀\u0000 <|endoftext|> ok", "en", "s", 3), (9, LONG, "en", "s", 1),
            (10, words(300, 500), "en", "s", 1), (-11, "X", "en", "s", 1)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(c).alias(c) for c in CLASHES]).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    """All labels of a larger table, for training."""
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


@pytest.fixture(scope="session")
def labelled_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
