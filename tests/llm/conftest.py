import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture()
def frame(spark, tmp_path):
    """Rows as a frame that is read from files, like a table."""
    made = []

    def make(rows, schema):
        made.append(1)
        path = f"{tmp_path}/t{len(made)}"
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture()
def documents(frame):
    """(doc_id, text) pairs as a table of documents."""

    def make(pairs, lang="en", source="s"):
        return frame([(i, t, lang, source, None if t is None else len(t)) for i, t in pairs], DOCS)

    return make


@pytest.fixture()
def speak():
    """Random words from a vocabulary of a given size."""
    rng = random.Random(7)

    def words(n, vocabulary=5000):
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    return words
