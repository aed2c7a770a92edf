import os

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

PROSE = "the quick brown fox jumps over a lazy dog while seven grey owls watch from old oak trees near cold water"


def story(seed: int, words: int = 120) -> str:
    """Words of which no five in a row repeat."""
    base = PROSE.split()
    return " ".join(f"{base[i % len(base)]}{(i * 7919 + seed * 31) % 10007}" for i in range(words))


@pytest.fixture(scope="session")
def awkward(spark):
    """Null, empty, blank, short, repeated, tied and very long documents; repeated rows and null ids."""
    long_text = story(1, 20_000)
    rows = [
        (1, story(2), "en", "a", 5),
        (1, story(2), "en", "a", 5),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t ", "en", "", 4),
        (5, "one two", "en", "b", 7),
        (6, "one two", "en", "b", 7),
        (None, story(3), "en", "b", 1),
        (None, story(3), "en", "b", 1),
        (7, "word " * 200, "en", "a", 1000),
        (8, "same line here\n" * 60, "en", "a", 900),
        (9, long_text, "fr", "c", len(long_text)),
        (10, "été 日本語 \U0001f600 ünïcode " + story(4), "ja", "c", 3),
        (11, story(2), "en", "c", 5),
        (13, "an end <|endoftext|> in the text " + story(6, 40), "en", "b", 9),
        (14, " " * 2_000_000, "en", "c", 2_000_000),
        (12, story(5, 60) + "\n" + story(5, 60), "en", "a", -3),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def tiny():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
