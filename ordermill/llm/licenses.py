"""License scans by a positional index of rare words.

Document frequencies of the templates' words, counted over all files, decide which words are rare. The
index holds each template's rarest words with their positions. A file's words that are in the index give
postings; those of one template that agree on where it would start, give or take a few words added or left
out, are intersected. Where enough agree, the template is aligned with that stretch of the file: enough of its
words have to stand there in its order, and its key phrases have to stand there unbroken.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ordermill.llm.common import byte_table, utf8

#: A-Z lower-cased, words of ASCII letters, digits and everything above 0x7F.
TABLE = byte_table(r"0-9A-Za-z\x80-\xff", lower=True)

# Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]  # phrases that a match has to hold


# Opening words and notices of common public licences, and the phrases no variant lacks.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "without restriction")),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ("except in compliance with the license", "apache org licenses")),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license",)),
    Template("gpl", "licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    Template("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation", ("affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc0", "released under cc0 1 0 universal", ("cc0",)),
)
RARE, AGREE, COVERED = 4, 2, 0.8
SHIFT = 6  # words added or left out between two postings that still agree


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def stands(words: list[bytes], phrase: list[bytes], at: int) -> bool:
    return at >= 0 and words[at : at + len(phrase)] == phrase


def aligned(words: list[bytes], places: dict[bytes, int], size: int) -> int:
    """How many of a template's ``size`` words stand in ``words`` in its order (their longest common subsequence).

    ``places``: of each template word, the bits of its positions. Zero bits of ``row`` count the words found.
    """
    full = (1 << size) - 1
    row = full
    for word in words:
        met = row & places.get(word, 0)
        if met:
            row = (row + met | row - met) & full
    return size - row.bit_count()


class Index:
    """Postings of each template's ``rare`` rarest words; ``counts``: documents that hold a word."""

    def __init__(
        self, counts: dict[str, int], total: int, phrases=PHRASES, templates=TEMPLATES,
        rare: int = RARE, agree: int = AGREE, covered: float = COVERED, shift: int = SHIFT,
    ):
        idf = lambda word: math.log((total + 1) / (counts.get(word.decode(), 0) + 1))
        self.covered, self.shift = covered, shift
        self.templates = [(t.label, t.text.encode().split(), [k.encode().split() for k in t.keys]) for t in templates]
        self.phrases = [(p.encode().split(), label) for p, label in phrases]
        self.postings = defaultdict(list)
        self.needed, self.places = [], []
        for number, (_, words, _) in enumerate(self.templates):
            bits: dict[bytes, int] = defaultdict(int)
            for at, word in enumerate(words):
                bits[word] |= 1 << at
            self.places.append(dict(bits))
            rarest = set(sorted(set(words), key=lambda w: (-idf(w), w))[:rare])
            self.needed.append(min(agree, len(rarest)))
            for at, word in enumerate(words):
                if word in rarest:
                    self.postings[word].append((number, at))
        # A phrase is looked up by its rarest word.
        self.anchors = defaultdict(list)
        for number, (phrase, _) in enumerate(self.phrases):
            at = max(range(len(phrase)), key=lambda k: (idf(phrase[k]), -k))
            self.anchors[phrase[at]].append((number, at))
        self.wanted = frozenset(self.postings) | frozenset(self.anchors)

    def _agreeing(self, number: int, starts: list[tuple[int, bytes]]) -> Iterator[tuple[int, int]]:
        """First and last start of each widest group of starts within ``shift`` words that has enough rare words."""
        if len(starts) < self.needed[number]:
            return
        starts = sorted(starts)
        held: dict[bytes, int] = defaultdict(int)
        stop = 0
        for k, (first, word) in enumerate(starts):
            grown = stop
            while stop < len(starts) and starts[stop][0] <= first + self.shift:
                held[starts[stop][1]] += 1
                stop += 1
            if stop > grown and len(held) >= self.needed[number]:
                yield first, starts[stop - 1][0]
            held[word] -= 1
            if not held[word]:
                del held[word]

    def scan(self, text: bytes) -> tuple:
        """(words, base places, first, last, base labels, labels, score) of one text."""
        words, wanted = words_of(text), self.wanted
        hits = [(at, word) for at, word in enumerate(words) if word in wanted]
        places, base, labels, score = [], set(), set(), 0.0
        votes: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for at, word in hits:
            for number, offset in self.anchors.get(word, ()):
                phrase, label = self.phrases[number]
                if stands(words, phrase, at - offset):
                    places.append(at - offset)
                    base.add(label)
            for number, offset in self.postings.get(word, ()):
                votes[number].append((at - offset, word))
        for number, starts in votes.items():
            label, template, keys = self.templates[number]
            for first, last in self._agreeing(number, starts):
                inside = words[max(0, first - self.shift) : max(0, last + len(template) + self.shift)]
                share = aligned(inside, self.places[number], len(template)) / len(template)
                if share >= self.covered and all(any(stands(inside, key, k) for k in range(len(inside))) for key in keys):
                    labels.add(label)
                    score = max(score, share)
        return (
            len(words),
            len(places),
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(base | labels)),
            1.0 if base else score,
        )


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: frozenset[bytes]) -> tuple[dict[str, int], int]:
    """In how many documents each word of the templates occurs, and the number of documents.

    What reaches the driver has a row per word of the templates.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, int] = defaultdict(int)
        for batch in batches:
            held[""] += len(batch)
            for text in batch["text"]:
                for word in vocabulary.intersection(words_of(text)):
                    held[word.decode()] += 1
        yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = docs.select(utf8(text_col).alias("text")).mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r["word"]: r["n"] for r in rows.collect()}
    return counts, counts.pop("", 0)


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES,
    rare: int = RARE, agree: int = AGREE, covered: float = COVERED, shift: int = SHIFT,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score``: 1 where a base phrase stands, else the share of its words that the best accepted template
    has there in its order; 0 without one. NULL and empty texts have no words, NULL first and last words and
    empty labels. Every row is judged by itself: ids may be NULL or repeat, other columns are ignored.
    """
    vocabulary = frozenset(w for t in templates for w in t.text.encode().split()) | frozenset(
        w for p, _ in phrases for w in p.encode().split()
    )
    counts, total = document_frequencies(docs, text_col, vocabulary)

    @pandas_udf("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = Index(counts, total, phrases, templates, rare, agree, covered, shift)
        for batch in batches:
            out = pd.DataFrame(
                [index.scan(x) for x in batch],
                columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select(F.col(id_col).alias("doc_id"), scanned(utf8(text_col)).alias("found")).select("doc_id", "found.*")
