"""Language identification with word-first backoff.

A known word scores by its log frequency in each language. An unknown word falls back to its character
4-grams, those unknown to 3-grams and so on, each by log frequency among the n-grams of that length. The
model is fitted on a bounded sample per language and keeps a bounded number of words and n-grams, so it
can be sent to every task; every document is scored over its whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ordermill.llm.common import byte_table, utf8, word_runs
from ordermill.session import discard, materialise

ASCII_LETTERS = byte_table(r"A-Za-z\x80-\xff", lower=True)
# Above ASCII: neither letter nor mark, or a mark that stands on no letter.
OTHER_SIGN = regex.compile(r"[^\x00-\x7F\p{L}\p{M}]|(?<![\p{L}\p{M}])[^\x00-\x7F\P{M}]+")
SAMPLE_ROWS = 2_000  # labelled documents per language that the fit reads at least, if there are so many
DRAW_BITS, DRAW_STEPS = 40, 16  # a row's draw, and the steps in which a language's greatest draw may double
MODEL_ENTRIES = 300_000  # words and n-grams of all languages together
LONGEST = 4
UNKNOWN = "und"
CACHED = 1 << 17


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Lower-case runs of letters with the marks on them, in lists of some MB of text each."""
    if not text.isascii():
        lowered = text.decode("utf-8", "replace").lower()
        text = (OTHER_SIGN.sub(" ", lowered) if OTHER_SIGN.search(lowered) else lowered).encode("utf-8", "replace")
    return word_runs(text.translate(ASCII_LETTERS))


def grams(word: bytes, length: int) -> list[str]:
    padded = f"_{word.decode()}_"
    return [padded[k : k + length] for k in range(len(padded) - length + 1)] or [padded]


@dataclass
class Model:
    """Log frequencies: ``words`` and, per length, ``grams`` map to a row of one value per language."""

    languages: list[str]
    words: dict[bytes, np.ndarray]
    grams: list[dict[str, np.ndarray]]  # of length 1, 2, ...


class Scorer:
    """A model as one matrix, with room for rows of unknown words met on the way."""

    def __init__(self, model: Model, cached: int = CACHED):
        self.languages, width = model.languages, len(model.languages)
        self.known = {word: k for k, word in enumerate(model.words)}
        self.rows = np.zeros((width, len(self.known) + cached))
        if self.known:
            self.rows[:, : len(self.known)] = np.array(list(model.words.values())).T
        self.base, self.grams = len(self.known), []
        self.met: list[bytes] = []
        for table in reversed(model.grams):
            matrix = np.array(list(table.values())) if table else np.zeros((0, width))
            self.grams.append(({gram: k for k, gram in enumerate(table)}, matrix))

    def learn(self, words: list[bytes]) -> None:
        """Rows for unknown words: the mean over their known n-grams of the greatest length that has any; else zero."""
        if len(self.met) + len(words) > self.rows.shape[1] - self.base:
            for word in self.met:
                del self.known[word]
            self.met = []
        at = self.base + len(self.met)
        rows = np.zeros((len(words), len(self.languages)))
        left, length = list(range(len(words))), len(self.grams)
        for table, matrix in self.grams:
            flat, sizes, done, rest = [], [], [], []
            for k in left:
                found = [g for g in map(table.get, grams(words[k], length)) if g is not None]
                if found:
                    flat += found
                    sizes.append(len(found))
                    done.append(k)
                else:
                    rest.append(k)
            if done:
                starts = np.cumsum([0, *sizes[:-1]])
                rows[done] = np.add.reduceat(matrix[flat], starts) / np.array(sizes)[:, None]
            left, length = rest, length - 1
        self.rows[:, at : at + len(words)] = rows.T
        self.known.update(zip(words, range(at, at + len(words))))
        self.met += words

    def predict(self, text: bytes) -> tuple[str, float]:
        """The likeliest language (the first by name among equals) and its share of the likelihood."""
        if not self.languages:
            return UNKNOWN, 0.0
        total, any_word = np.zeros(len(self.languages)), False
        for words in words_of(text):
            for first in range(0, len(words), CACHED // 2):
                part = words[first : first + CACHED // 2]
                any_word = True
                at = list(map(self.known.get, part))
                while None in at:  # a second time if learning made room by dropping rows that this part needs
                    self.learn(list({w for w, k in zip(part, at) if k is None}))
                    at = list(map(self.known.get, part))
                total += self.rows.take(at, axis=1).sum(axis=1)
        if not any_word:
            return UNKNOWN, 0.0
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    entries: int = MODEL_ENTRIES,
    longest: int = LONGEST,
    id_col: str = "doc_id",
) -> Model:
    """Fit on the ``sample_rows`` rows of each language (or all, if fewer) that a hash of id and text puts first.

    Rows whose hash is in the step of the last one are read too: some 4% more, or all of a group of rows with
    the same id and text. So every language has its rows in the sample, whatever its texts. Rows without text or
    language are left out. Words and n-grams are counted in Spark; the most frequent ``entries`` in all, as many
    for every language, half of them words, reach the driver.

    What a language has not seen scores the same in all languages, below all that any of them has seen: half
    an occurrence in the largest sample. So a language with little text wins nothing by not knowing a word.
    """
    draw = F.pmod(F.xxhash64("text", "id"), F.lit(1 << DRAW_BITS)) + 1
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id")
    )
    known = known.select("lang", "text", F.floor(F.log2(draw.cast("double")) * DRAW_STEPS).cast("int").alias("step"))
    rows: dict[str, dict[int, int]] = {}
    for r in known.groupBy("lang", "step").agg(F.count("*").alias("n")).collect():
        rows.setdefault(r["lang"], {})[r["step"]] = r["n"]
    languages = sorted(rows)
    if not languages:
        return Model([], {}, [{} for _ in range(longest)])
    last = {}
    for lang, steps in rows.items():
        held = 0
        for step in sorted(steps):
            last[lang], held = step, held + steps[step]
            if held >= sample_rows:
                break
    upto = F.create_map(*[F.lit(x) for lang in languages for x in (lang, last[lang])])
    sample = known.where(F.col("step") <= F.element_at(upto, F.col("lang")))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words: dict[str, Counter] = {}
            for (lang, text), copies in Counter(zip(batch["lang"], batch["text"])).items():
                held = words.setdefault(lang, Counter())
                for part in words_of(text):
                    if copies == 1:
                        held.update(part)
                    else:
                        held.update({word: n * copies for word, n in Counter(part).items()})
            for lang, count in words.items():
                yield pd.DataFrame({"lang": lang, "word": list(count), "n": list(count.values())})

    def spelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held: Counter = Counter()
            for lang, word, n in zip(batch["lang"], batch["word"], batch["n"]):
                held[lang, 0, word.decode()] += n
                for length in range(1, longest + 1):
                    for gram in grams(word, length):
                        held[lang, length, gram] += n
            yield pd.DataFrame([(*key, n) for key, n in held.items()], columns=["lang", "length", "unit", "n"])

    words = sample.select("lang", utf8("text").alias("text")).mapInPandas(counted, "lang string, word binary, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    units = words.mapInPandas(spelled, "lang string, length int, unit string, n long")
    units = materialise(units.groupBy("lang", "length", "unit").agg(F.sum("n").alias("n")), "language-units")
    each = max(1, entries // len(languages))
    kept = F.when(F.col("length") == 0, each // 2).otherwise(each // (2 * longest))
    totals = {(r["lang"], r["length"]): r["n"] for r in units.groupBy("lang", "length").agg(F.sum("n").alias("n")).collect()}
    order = Window.partitionBy("lang", "length").orderBy(F.desc("n"), "unit")
    top = units.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= each) & (F.col("rank") <= kept))
    tables: list[dict[str, np.ndarray]] = [{} for _ in range(longest + 1)]
    most = [max(totals.get((lang, length), 0) for lang in languages) for length in range(longest + 1)]
    floor = [np.full(len(languages), np.log(0.5) - np.log(n + 1.0)) for n in most]
    for row in top.select("lang", "length", "unit", "n").collect():
        values = tables[row["length"]].get(row["unit"])
        if values is None:
            values = tables[row["length"]][row["unit"]] = floor[row["length"]].copy()
        at = languages.index(row["lang"])
        values[at] = np.log(row["n"] + 0.5) - np.log(totals[row["lang"], row["length"]] + 1.0)
    discard(units)
    return Model(languages, {word.encode(): row for word, row in tables[0].items()}, tables[1:])


def predicted(text: str, model: Model, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("lang_pred string, score double")
    def named(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for batch in batches:
            yield pd.DataFrame([scorer.predict(x) for x in batch], columns=["lang_pred", "score"])

    return named(utf8(text))


def identify(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fitted
) -> DataFrame:
    """doc_id, lang_pred and score of every row, by a model fitted on the rows where ``learn`` holds.

    ``und`` with score 0 for a text that is NULL or has no letter, and for all if there is nothing to learn
    from. Equally likely languages: the first by name. Only the text is an input of a prediction, so ids
    may be NULL or repeat and other columns are ignored.
    """
    model = fit(docs.where(learn), text_col, lang_col, id_col=id_col, **fitted)
    named = docs.select(F.col(id_col).alias("doc_id"), predicted(text_col, model, docs.sparkSession).alias("found"))
    return named.select("doc_id", "found.lang_pred", "found.score")
