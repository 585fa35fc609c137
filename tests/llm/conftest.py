"""Fixtures of the training-data operators: small tables with awkward rows."""

import pytest
from llm_texts import words
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, non-ASCII and one very long text."""
    plain = " ".join(words(120, 1)) + ".\n" + " ".join(words(60, 2))
    return [
        (1, plain, "en", "a", None), (2, plain, "en", "a", 5), (2, plain, "en", "a", 5), (3, None, None, None, None),
        (4, "", "de", "b", 0), (5, " \t\n ", None, "b", 3), (6, "é ß 漢字  x", "fr", None, 1),
        (7, " ".join(words(30_000, 3)), "en", "a", 9), (None, "some text without an id", "en", "c", 2),
        (8, plain.replace(plain.split()[3], "changed"), "en", "c", 7), (9, "one", "es", "b", 3),
    ]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return spark.createDataFrame(awkward_rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(awkward):
    """Extra columns with the names that operators add."""
    from pyspark.sql import functions as F

    extra = ("score", "size", "kept", "key", "node", "id", "q_n_words", "m_size", "k0", "x0", "held_out", "redacted", "row", "spans")
    return awkward.withColumns({c: F.lit("extra") for c in extra})
