import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASH = ["size", "key", "digest", "shard", "_n", "_w", "start", "end", "first", "last", "fingerprint", "score", "items"]


def prose(seed, words, vocabulary=400):
    draw = random.Random(seed)
    bank = ["the", "of", "and", "is", "a"] + [f"word{chr(97 + i % 26)}{i}" for i in range(vocabulary)]
    return " ".join(draw.choice(bank) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    base = prose(1, 120)
    return [
        (1, base, "en", "a", 3),
        (2, base, "en", "b", 3),
        (3, None, "en", "b", None),
        (4, "", None, None, 0),
        (5, prose(5, 3000), "en", "a", 1),
        (6, "one", "en", "c", 3),
        (7, prose(7, 90) + "\nçà et là: été 💡 " + prose(8, 20), "fr", "a", 3),
        (7, prose(7, 90) + "\nçà et là: été 💡 " + prose(8, 20), "fr", "a", 3),
        (None, prose(9, 40), None, None, None),
        (None, None, None, None, None),
        (10, "  \t\n ", "en", "b", 5),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clashing():
    """Adds columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return lambda docs: docs.select("*", *[F.lit("x").alias(c) for c in CLASH if c not in docs.columns])


@pytest.fixture(scope="session")
def docs_dir():
    return "/root/testdata/sf0.001"
