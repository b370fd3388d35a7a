import pytest
from pyspark.sql import functions as F

CLASHES = ("id", "row", "_row", "fp", "key", "num", "order", "size", "p", "n_words", "words", "votes", "spans", "items", "_doc", "removed", "copies")
LONG = "word " * 30000 + "x" * 100000


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank and very long texts, repeated rows, null and repeated ids, clashing columns."""
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, LONG, "b"), (5, "The Quick\nbrown fox", "b"), (5, "The Quick\nbrown fox", "b"),
        (None, "some more words here and there", None), (None, "some more words here and there", None), (6, None, None), (7, "ünï ß 中文 text", "a"), (7, "other text, same id", "a"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return table.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
