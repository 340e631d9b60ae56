"""Small documents with the cases every operator must bear."""

import random

import pytest

HARD = [
    (None, None, "en", "a", 0),
    (None, "a null id, but a text", "en", "a", 21),
    (901, None, None, None, None),
    (902, "", "en", "a", 0),
    (903, " \t\n ", "en", None, 4),
    (904, "one", "en", "a", 3),
    (905, "the same row twice, id and text", "en", "a", 31),
    (905, "the same row twice, id and text", "en", "a", 31),
    (906, "the same id, another text", "en", "a", 25),
    (906, "and here is that other text", "en", "b", 27),
    (907, "é́ 中文 it's <|endoftext|> 12.5% … x y", "fr", "b", 30),
    (908, "word " * 30000, "en", "a", 150000),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(n)]


@pytest.fixture()
def rng():
    return random.Random(11)


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns whose names operators use themselves."""
    clash = "node long, row_key string, rank int, whole string, `a.b` int"
    return spark.createDataFrame([(*r, 1, "k", 2, "w", 3) for r in HARD], f"{SCHEMA}, {clash}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, rows):
    """Documents of (id, text)."""
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], SCHEMA)
