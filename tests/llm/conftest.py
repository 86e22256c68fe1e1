import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """Seeded invented prose: a function from a number of words to a text."""
    rng = random.Random(5)
    syllables = ["an", "th", "er", "on", "re", "ti", "ed", "sh", "wh", "in", "ou", "ble"]

    def make(n: int) -> str:
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Null, empty, repeated and very long rows, with columns named like the operators' own."""
    schema = "doc_id long, text string, source string, lang string, n_chars long, kept boolean, spans string, fp long"
    long = prose(30_000)
    rows = [(1, prose(80)), (2, None), (3, ""), (4, " \n\t"), (5, "a"), (None, "b c"), (None, None), (6, long), (7, prose(80)), (7, "x y")]
    rows += [rows[0], rows[0], (8, rows[0][1]), (9, "word " * 500)]
    made = [(i, t, None if i is None else f"s{i % 3}", "en", 0, None, "x", 1) for i, t in rows]
    return spark.createDataFrame(made, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
