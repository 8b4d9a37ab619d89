"""Text: brand prefix removal and whole-word cue search."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# What does not belong to a word: anything but letters and their marks, in any script.
NO_LETTER = r"[^\p{L}\p{M}]+"


def strip_brand(c: Column, brand: str) -> Column:
    """Remove the brand and a following dash, wherever and in whatever case it appears."""
    words = r"\s*".join(re.escape(word) for word in brand.split())
    return F.trim(F.regexp_replace(c, rf"(?i){words}\s*[-–—]?\s*", ""))


def spaced_words(c: Column) -> Column:
    """The text's words in lower case with one space around each, for whole-word searches."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(c), NO_LETTER, " "), F.lit(" "))


def words_present(words: Column, cues: Iterable[str]) -> Column:
    """Which of the words that cues consist of occur in spaced words: one pass, however many cues."""
    vocabulary = sorted({word for cue in cues for word in cue.split()})
    return F.array_intersect(F.split(words, " "), F.array(*[F.lit(word) for word in vocabulary]))


def has_cue(words: Column, present: Column, cue: str) -> Column:
    """Whether the cue occurs as whole words; the text is searched only if all its words occur."""
    parts = cue.split()
    hit = reduce(and_, (F.array_contains(present, part) for part in parts))
    return hit if len(parts) == 1 else hit & F.contains(words, F.lit(f" {cue} "))


def has_any_cue(words: Column, present: Column, cues: Iterable[str]) -> Column:
    return reduce(or_, (has_cue(words, present, cue) for cue in cues))
