from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int, base: str = "w") -> list[str]:
    r = random.Random(seed)
    return [f"{base}{r.randrange(10**6)}" for _ in range(n)]


def frame(spark, texts, lang="en", source="s", start=0):
    """Documents of the texts; a text may be (text, lang, source)."""
    rows = []
    for k, t in enumerate(texts):
        text, la, so = t if isinstance(t, tuple) else (t, lang, source)
        rows.append((start + k, text, la, so, len(text) if text is not None else None))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def make(spark):
    return lambda texts, **how: frame(spark, texts, **how)


#: Null, empty and blank texts, repeated rows, null ids and columns whose names clash with those of the operators.
def odd(spark):
    long = " ".join(words(60, 1))
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (3, " \n\t ", "en", "s", 4), (4, long, "en", "s", 1), (4, long, "en", "s", 1), (5, long, None, "t", 1), (None, long, "de", "t", 1), (6, "one", "en", "t", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "1 AS row", "'x' AS rest", "2 AS label", "3 AS kept", "4 AS block", "5 AS key", "6 AS size", "7 AS score", "8 AS starts", "9 AS n", "10 AS id")
