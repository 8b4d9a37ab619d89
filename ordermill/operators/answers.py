"""A store of a scorer's answers, so that each text is put to it once.

A row is (version, text_hash): the prompt and model it was asked of, and the hash of the text. Texts that have no
answer yet are found by an anti-join and asked, in batches, each distinct text once; answers are appended.
Where a batch fails it is halved until the text that breaks it stands alone. That text keeps a row
with the reason and is asked again by later runs, up to a number of attempts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.reviews import ANALYSIS, INSTRUCTION, Scorer, parse_analysis
from ordermill.sources import sinks

ANSWERS = "text_hash string, analysis_json string, failure string, version string"
ATTEMPTS = 3
BATCH = 64  # prompts of one call


def prompt_version(model: str = "") -> str:
    """Names a prompt and a model; another wording gives another version, under which all texts are asked anew."""
    return hashlib.sha256(f"{model}\n{INSTRUCTION}".encode()).hexdigest()[:16]


def text_hash(text: str) -> Column:
    return F.sha2(F.col(text), 256)


def _readable(answer: object) -> bool:
    try:
        held = json.loads(answer)
    except (TypeError, ValueError):
        return False
    return isinstance(held, dict) and ANALYSIS.fieldNames()[0] in held


def ask(scorer: Scorer, texts: list[str]) -> list[tuple[str | None, str | None]]:
    """(answer, failure) of each text; a call that fails is made again for each half of its texts."""
    try:
        answers = scorer([INSTRUCTION + text for text in texts])
        if len(answers) != len(texts):
            raise ValueError(f"{len(answers)} answers to {len(texts)} prompts")
    except Exception as problem:  # whatever a scorer raises; the reason is kept with the text
        if len(texts) == 1:
            return [(None, f"{type(problem).__name__}: {problem}"[:500])]
        half = len(texts) // 2
        return ask(scorer, texts[:half]) + ask(scorer, texts[half:])
    return [(a, None) if _readable(a) else (None, f"unreadable answer: {str(a)[:400]}") for a in answers]


def unanswered(reviews: DataFrame, store: str, version: str, text: str = "review_text", attempts: int = ATTEMPTS) -> DataFrame:
    """(text_hash, text) of the distinct texts without an answer that are still to be asked."""
    spark = reviews.sparkSession
    texts = reviews.where(F.col(text).isNotNull()).groupBy(text_hash(text).alias("text_hash")).agg(F.min(text).alias("text"))
    if not spark.catalog.tableExists(store):
        return texts
    tried = spark.table(store).where(F.col("version") == version).groupBy("text_hash")
    settled = tried.agg(F.count("*").alias("tries"), F.count_if(F.col("failure").isNull()).alias("good"))
    return texts.join(settled.where((F.col("good") > 0) | (F.col("tries") >= attempts)), "text_hash", "left_anti")


def answer_texts(
    reviews: DataFrame, scorer: Scorer, store: str, version: str, text: str = "review_text", attempts: int = ATTEMPTS, batch: int = BATCH
) -> None:
    """Ask what is not answered yet and append it to the store."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for first in range(0, len(part), batch):
                some = part.iloc[first : first + batch]
                found = ask(scorer, some["text"].tolist())
                yield pd.DataFrame(
                    {
                        "text_hash": some["text_hash"].tolist(), "analysis_json": [a for a, _ in found],
                        "failure": [f for _, f in found], "version": version,
                    }
                )

    new = unanswered(reviews, store, version, text, attempts)
    sinks.append_rows(new.mapInPandas(run, ANSWERS), store, ["version"])


def with_answers(reviews: DataFrame, store: str, version: str, text: str = "review_text") -> DataFrame:
    """Reviews with `analysis_json` from the store; NULL for a text that has none."""
    held = reviews.sparkSession.table(store).where((F.col("version") == version) & F.col("failure").isNull())
    one = held.groupBy("text_hash").agg(F.min("analysis_json").alias("analysis_json"))
    keyed = reviews.withColumn("_text_hash", text_hash(text))
    met = keyed.join(one.withColumnRenamed("text_hash", "_text_hash"), "_text_hash", "left")
    return met.select(*reviews.columns, "analysis_json")


def enrich_by_store(reviews: DataFrame, scorer: Scorer, store: str, version: str | None = None, text: str = "review_text") -> DataFrame:
    """Reviews with answer and typed fields, before any quality rule; only new texts reach the scorer."""
    version = version or prompt_version()
    answer_texts(reviews, scorer, store, version, text)
    return parse_analysis(with_answers(reviews, store, version, text))


def failures(spark: SparkSession, store: str, version: str | None = None) -> DataFrame:
    """Texts that have no answer, with the number of tries and a reason."""
    held = spark.table(store) if version is None else spark.table(store).where(F.col("version") == version)
    tried = held.groupBy("version", "text_hash").agg(
        F.count("*").alias("tries"), F.max("failure").alias("failure"), F.count_if(F.col("failure").isNull()).alias("good")
    )
    return tried.where("good = 0").drop("good")
