from __future__ import annotations

import random

import pytest

WORDS = [a + b for a in ("tha", "ner", "ión", "über", "que", "lo") for b in ("tion", "ing", "re", "ñas", "e", "")]
CLASHING = "fp long, size long, key string, name string, doc string, trigger string, found string, score string, words string"


def prose(seed: int, count: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(count))


LONG = prose(1, 260_000)  # over a megabyte: longer than any stretch that is read at once

EDGE_ROWS = [
    (None, prose(2, 60), "en", "a"),
    (None, prose(2, 60), "en", "a"),
    (None, None, None, None),
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \t\n\r ", "de", "a"),
    (4, LONG, "en", "a"),
    (5, prose(3, 80), "en", "b"),
    (5, prose(3, 80), "en", "b"),
    (6, prose(3, 80), "en", "b"),
    (5, prose(4, 80), "fr", "b"),
    (7, "one", "fr", "b"),
    (8, "Ünïcode – “quotes” 漢字 12 \U0001f600 end", "fr", "c"),
    (9, prose(3, 40) + " " + prose(5, 40), "es", "c"),
    (10, "x" * 300, "es", "c"),
    (11, "!!! 123 ???", "es", "c"),
]


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source) rows, with columns that clash with what operators might add."""

    def frame(rows):
        docs = spark.createDataFrame(
            [(i, t, lang, source, len(t or ""), *[None] * 9) for i, t, lang, source in rows],
            "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING,
        )
        return docs.repartition(3) if rows else docs

    return frame


@pytest.fixture(scope="session")
def edge(make):
    return make(EDGE_ROWS).cache()


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE_ROWS
