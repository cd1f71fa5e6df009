import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use inside.
CLASHES = ["score", "size", "part", "guest", "name", "block", "token", "grp", "set", "root", "txt", "at",
           "host", "words", "label", "component_id", "start", "taken", "pieces"]


def words(rng, n, size=4000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def awkward_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(1)
    long = " ".join(words(rng, 30_000))
    same = " ".join(words(rng, 80))
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "one", "en", "a", 3),
        (5, same, "en", "a", len(same)), (6, same, "de", "b", len(same)), (6, same, "de", "b", len(same)),
        (7, long, "en", "b", len(long)), (None, same, "en", None, len(same)), (None, None, None, None, None),
        (8, "ünïcode 日本語 ▁ <s> \u0000 x", "xx", "ü", 22), (9, "a " * 300, "en", "a", 600),
        (10, "no spaces" + "x" * 5000, "en", "a", 5009)]


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows(), DOCS)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
