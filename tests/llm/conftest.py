import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: documents with extra columns whose names clash with those the operators make
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n", LongType()), StructField("th", StringType()),
                   StructField("key", StringType()), StructField("language", StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """DataFrame of (doc_id, text[, lang]) rows with clashing extra columns."""
    def make(rows):
        full = [(*r, *([None] * (3 - len(r))), "s", 7, "th", "key", "x") for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empties, ties, repeated rows and a very long text."""
    long_text = " ".join(f"wort{i % 977} alpha{i % 13}" for i in range(60_000))
    return [(1, None, None), (2, "", "en"), (None, "null id with some words in it here", "en"), (3, "   \t\n ", None),
            (4, "same words again and again in here", "en"), (4, "same words again and again in here", "en"),
            (4, "other words under the same id number", "de"), (5, "12345 !!! 678", "fr"), (6, long_text, "de"),
            (7, long_text, "de"), (8, "ü", "de"), (None, None, None)]
