import pytest
from pyspark.sql import types as T

from clientlens.llm.common import ship_package

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) pairs, with extra columns whose names clash with working names."""

    def build(*pairs, lang="en"):
        rows = [(i, t, lang, "s", len(t or "")) for i, t in pairs]
        frame = spark.createDataFrame(rows, DOCS)
        clashing = ("kept", "keep", "n_lines", "rep", "row", "hash", "nth", "root", "value", "score", "label")
        return frame.selectExpr("*", *(f"'x' AS {c}" for c in clashing))

    return build


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
