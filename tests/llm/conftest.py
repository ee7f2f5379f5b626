import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, id string, q int, count int"


#: Further columns with names that operators might use for themselves.
CLASHING = ["p", "n_tokens", "n", "__m", "__drop", "__fp", "fp", "__copies", "__copy", "__key", "hits", "rate", "copies", "__found", "row_id", "range", "shard", "__QUALITY", "root"]


def clashing(df):
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def words(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus():
    """Unique texts, exact copies, near copies, shared passages, blanks and one very long text."""
    rng = random.Random(5)
    texts = [words(rng, rng.randrange(5, 120)) for _ in range(30)]
    passage = words(rng, 60, 1000)
    texts += [texts[0], texts[1], texts[1], "", None, "  \n\t ", "a" * 200, "a" * 120, "Ünï cödé " * 20, words(rng, 20) + " " + passage + " " + words(rng, 20), passage, passage + " tail", words(rng, 6000)]
    near = words(rng, 100, 5000).split()
    for k in range(4):
        copy = list(near)
        copy[k * 7] = "changed"
        texts.append(" ".join(copy))
    return dict(enumerate(texts))


@pytest.fixture(scope="session")
def texts():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The corpus with further columns whose names operators use themselves."""
    rows = [(i, t, "en", "s", 0 if t is None else len(t), 7, "x", 1, 2) for i, t in texts.items()]
    return clashing(spark.createDataFrame(rows, SCHEMA).repartition(5))


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids, repeated rows, nulls in every column."""
    t = "some words that repeat " * 30
    rows = [(1, t, "en", "s", 1, 1, "x", 1, 1), (1, t, "en", "s", 1, 1, "x", 1, 1), (None, None, None, None, None, None, None, None, None), (None, t, None, None, None, None, None, None, None), (3, "", "de", "s", 0, 1, "x", 1, 1), (4, t + "more", "en", None, 1, 1, "x", 1, 1)]
    return clashing(spark.createDataFrame(rows, SCHEMA))


@pytest.fixture(scope="session")
def nothing(spark):
    return clashing(spark.createDataFrame([], SCHEMA))
