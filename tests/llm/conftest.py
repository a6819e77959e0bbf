import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, taken string, fp string, size string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source); more columns have names that operators use."""

    def documents(rows):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or ""), "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return documents


@pytest.fixture(scope="session")
def prose():
    """Invented texts of a few words."""

    def write(seed, n, low=3, high=40):
        r = random.Random(seed)
        words = ["".join(r.choice("aeioustrn") for _ in range(r.randint(2, 7))) for _ in range(60)]
        return [" ".join(r.choice(words) for _ in range(r.randint(low, high))) for _ in range(n)]

    return write


@pytest.fixture(scope="session")
def odd():
    """Rows that every operator must stand: nulls, empties, blanks, repeats, long and odd texts."""
    return [
        (1, "one two three four five six", "en", "a"),
        (2, None, None, None),
        (None, "null id here and there", "en", None),
        (3, "", "en", "b"),
        (4, " \t\n ", "en", "b"),
        (5, "one two three four five six", "en", "a"),
        (5, "one two three four five six", "en", "a"),
        (6, "word " * 9000, "de", "c"),
        (7, "x" * 30000, "de", "c"),
        (8, "Ünïcödé 😀 text with odd\x1cspaces é", "fr", "b"),
    ]
