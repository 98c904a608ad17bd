"""Small tables with the awkward cases, shared by the operators' tests."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, found string,"
          " token int, component string, kept string, n_words string, hits int, score string, place int")
ALPHABET = ["alpha", "beta", "gamma", "delta", "zeta", "eta", "theta", "iota", "été", "naïve", "42", "x,"]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(ALPHABET) + str(rng.randrange(200)) for _ in range(n))


def documents(spark, texts, first=0):
    """One document a text, with columns whose names clash with those of the operators."""
    rows = [(first + i, x, "en", "s", None, "a", "b", 1, "c", "d", "e", 2, "f", 3) for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """Null id, null text, empty text, blanks, repeated rows, an id of two texts, a long text."""
    rng = random.Random(5)
    long = sentence(rng, 12_000)
    rows = [(None, "no id here at all"), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, long), (6, long),
            (7, "same row again"), (7, "same row again"), (8, "this text"), (8, "another text"),
            (None, None), (9, "ends with a null \x00 and \x1f \u2028 \U0001f600 signs")]
    frame = spark.createDataFrame(
        [(i, x, None, None, None, "a", "b", 1, "c", "d", "e", 2, "f", 3) for i, x in rows], SCHEMA)
    return frame


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
