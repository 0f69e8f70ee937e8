import pytest
from pyspark.sql import types as T

# a documents table's columns and two that clash with names the operators use
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()),
                       T.StructField("score", T.StringType()), T.StructField("rep", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs or texts."""
    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x", "y", "z")
                                      for i, t in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def empty(make_docs):
    return make_docs([])


def gibberish(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(n))
