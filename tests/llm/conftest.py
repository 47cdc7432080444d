import os

import pytest
from pyspark.sql import types as T

LONG = "word other thing " * 9000

#: Nulls, empty and blank texts, ties, repeated rows and a very long text.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. Again and again."),
    (2, "The quick brown fox jumps over the lazy dog. Again and again."),
    (3, ""),
    (4, None),
    (5, " \n\t "),
    (6, "one two"),
    (7, "Élan ça naïve 가각 Straße ΣΑΣ 'tis it's <|endoftext|> x́"),
    (8, LONG),
    (8, LONG),
    (None, "a text without id, not to be lost"),
    (-9, "THE QUICK brown fox jumps over the lazy dog. again and again."),
]


@pytest.fixture(scope="session")
def texts():
    return list(TEXTS)


@pytest.fixture(scope="session")
def make_docs(spark):
    """DataFrame of (doc_id, text) with columns whose names clash with results."""

    def make(rows):
        schema = T.StructType(
            [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
            + [T.StructField(n, T.StringType()) for n in ("id", "score", "n", "part", "ids", "block", "key", "hash", "bytes", "rest", "row")]
        )
        return spark.createDataFrame([(d, t, *["x"] * 11) for d, t in rows], schema).repartition(3)

    return make


@pytest.fixture(scope="session")
def shared_texts():
    """(doc_id, text) of the test documents, whole."""
    import pyarrow.parquet as pq

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    table = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
