from __future__ import annotations

import os

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
CLASHES = "ids INT, kind INT, class INT, mark INT, spans INT, row INT, label INT, _counts INT, _found INT, _matches INT"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = REPO


@pytest.fixture(scope="session")
def docs(spark):
    """Rows to a table of documents, with columns of names that the operators might use themselves."""

    def make(rows):
        wide = [(i, t, "en", "s", None, *[7] * len(CLASHES.split(", "))) for i, t in rows]
        return spark.createDataFrame(wide, f"{SCHEMA}, {CLASHES}")

    return make


def words(n, seed=0, kinds=400):
    import random

    rng = random.Random(seed)
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


# Nulls, empty and blank texts, ties, rows that repeat, a text of many words, unusual characters.
def odd_rows():
    long = " ".join(words(20_000, 1, 5000))
    one = " ".join(words(120, 2))
    return [
        (1, one),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, one),
        (5, one),
        (6, one + " and a few more words"),
        (None, one),
        (None, None),
        (7, long),
        (8, "x"),
        (9, "日本語 текст \x00 İ ' 'll"),
        (10, "a b a b a b a b " * 40),
    ]
