"""Small documents with every awkward case: nulls, empties, ties, repeated rows, long texts, clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd, n, words=400):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


def near(rnd, text, changes=2):
    w = text.split(" ")
    for _ in range(changes):
        w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="session")
def edge_rows():
    rnd = random.Random(1)
    base = prose(rnd, 120, 5000)
    passage = ". ".join(prose(rnd, 12, 5000) for _ in range(5)) + "."
    rows = [
        (0, None, None, None), (1, "", "en", "a"), (2, " \n\t ", "en", "a"), (3, "one two", "en", "b"), (4, "one two", "fr", None),
        (5, base, "en", "a"), (6, base, "en", "a"), (6, base, "en", "a"), (7, near(rnd, base), "en", "b"), (8, near(rnd, base, 60), "en", "b"),
        (None, base, "en", "c"), (9, "line\n" + prose(rnd, 30, 5000) + "\n" + base, "en", "c"),
        (10, prose(rnd, 25, 5000) + " " + passage + " " + prose(rnd, 10, 5000), "en", "a"), (11, prose(rnd, 25, 5000) + " " + passage + " " + prose(rnd, 14, 5000), "en", "a"),
        (12, "ÄÖÜ straße – naïve 😀 " * 30, "de", "b"), (13, "again " * 700, "en", "b"), (14, prose(rnd, 30000, 9000), "en", "a"), (15, "12 34 !!", None, "a"),
    ]
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    df = spark.createDataFrame(edge_rows, SCHEMA)
    clash = ("size", "key", "th", "component", "label", "score", "rank", "unit", "words", "copies", "sig", "place", "bucket", "first", "start", "length", "held_out", "places", "kept", "doc_", "th_", "th__", "once__", "tk__", "bytes", "kind", "mark")
    return df.withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
