import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def table(spark):
    """A documents table of (doc_id, text[, lang[, source]]) rows."""

    def of(rows):
        full = [(*r, *("en", "src0")[len(r) - 2 :], len(r[1]) if r[1] else None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return of


@pytest.fixture
def prose():
    """Random words of a small invented vocabulary."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(900)]

    def of(n, seed):
        own = random.Random(seed)
        return [own.choice(vocabulary) for _ in range(n)]

    return of


@pytest.fixture
def edge_rows(prose):
    """Nulls, empty, blank, very long and repeated texts, ties."""
    long = " ".join(prose(30000, 5))
    return [
        (1, None, None, None),
        (2, "", "en", "src0"),
        (3, " \n\t ", "en", None),
        (None, "some words without an id", "en", "src0"),
        (4, long, "en", "src1"),
        (5, long, None, "src1"),
        (6, "tie", "de", "src0"),
        (6, "tie", "de", "src0"),
        (6, "another text under one id", "de", "src0"),
    ]
