import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs."""

    def make(pairs):
        rows = [(i, t, "en", "s", len(t) if t else 0) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """Null and empty texts, a missing id, repeated rows, ties, one very long text."""
    long = " ".join(f"w{i % 997}x{i % 13}." for i in range(30_000))
    return docs_of([(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (5, "one two"), (None, "a b c d e f g h i j k l."), (6, long), (7, "é ß 日本 🙂 **|")])
