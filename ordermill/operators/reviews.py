"""Review enrichment: free text to a fixed JSON answer, and the answer to typed columns.

The answer comes either from an injected scorer (any batch function from prompts to JSON texts,
run as an Arrow-batched pandas UDF) or, by default, from cue words evaluated as Spark expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.numbers import choose
from ordermill.functions.text import has_any_cue, has_cue, spaced_words, words_present
from ordermill.operators.quality import (
    REVIEW_CATEGORIES,
    SENTIMENTS,
    SEVERITIES,
    apply_expectations,
    review_rules,
)

Scorer = Callable[[list[str]], list[str]]

INSTRUCTION = (
    "You label customer reviews. Answer with a single JSON object and nothing else, with exactly these keys: "
    + "sentiment (" + ", ".join(SENTIMENTS) + ")"
    + "".join(
        f"; issue_{c} (true or false), {c}_severity ({', '.join(SEVERITIES)}), issue_{c}_reason (short text or empty)"
        for c in REVIEW_CATEGORIES
    )
    + ". An issue that is false has severity none and an empty reason. Minor means a small inconvenience,"
    " moderate a clear annoyance, severe a spoiled experience. Judge each severity by what the text says about"
    " that issue, whatever the overall mood; a good review can still name an issue. Late or mishandled delivery"
    " belongs to delivery only; food_quality is about the food itself; pricing about cost and value; portion_size"
    " about quantity. Reasons quote the review.\nReview: "
)


@dataclass(frozen=True)
class CueRules:
    """Cue words of the default classifier, in lower case; the most severe level with a cue wins,
    and the first cue listed for it is the reason."""

    positive: Sequence[str] = ("great", "excellent", "delicious", "perfect", "loved", "best", "friendly")
    negative: Sequence[str] = (
        "terrible", "awful", "bad", "worst", "disappointed", "never again",
        "worthless", "disgusting", "pathetic", "trash", "stupid", "idiot",
    )
    issues: Mapping[str, Mapping[str, Sequence[str]]] = field(
        default_factory=lambda: {
            "delivery": {
                "severe": ("never arrived", "hours late"),
                "moderate": ("very late", "late delivery", "wrong address"),
                "minor": ("bit late", "slightly late", "slow delivery"),
            },
            "food_quality": {
                "severe": ("disgusting", "inedible", "spoiled", "raw"),
                "moderate": ("stale", "undercooked", "burnt"),
                "minor": ("bland", "lukewarm", "too salty"),
            },
            "pricing": {
                "severe": ("rip off", "daylight robbery"),
                "moderate": ("overpriced", "not worth"),
                "minor": ("pricey", "a bit expensive"),
            },
            "portion_size": {
                "severe": ("left hungry",),
                "moderate": ("tiny portion", "half empty"),
                "minor": ("small portion", "rather small"),
            },
        }
    )

    @classmethod
    def read(cls, cues: DataFrame) -> CueRules:
        """Rules from a table (topic, level, place, cue): topic is `positive`, `negative` or an issue, level a severity
        of an issue. Cues count in the order of `place`. A word list is small; a table of over 10,000 cues is refused."""
        rows = cues.select("topic", "level", "place", F.lower("cue").alias("cue")).limit(10_001).collect()
        if len(rows) > 10_000:
            raise ValueError("a list of cues has at most 10,000")
        moods: dict[str, list[str]] = {"positive": [], "negative": []}
        issues: dict[str, dict[str, list[str]]] = {c: {level: [] for level in SEVERITIES[1:]} for c in REVIEW_CATEGORIES}
        for row in sorted(rows, key=lambda r: (r["place"], r["cue"])):
            if row["topic"] in moods:
                moods[row["topic"]].append(row["cue"])
            elif row["topic"] in issues and row["level"] in issues[row["topic"]]:
                issues[row["topic"]][row["level"]].append(row["cue"])
            else:
                raise ValueError(f"not a topic and level: {row['topic']!r}, {row['level']!r}")
        return cls(moods["positive"], moods["negative"], issues)

    def cues(self) -> list[str]:
        by_issue = [cue for levels in self.issues.values() for cues in levels.values() for cue in cues]
        return [*self.positive, *self.negative, *by_issue]


def review_prompt(text: Column) -> Column:
    return F.concat(F.lit(INSTRUCTION), text)


def classify_by_cues(reviews: DataFrame, rules: CueRules | None = None, text: str = "review_text") -> DataFrame:
    """Add `analysis_json` from cue words, JVM side, reading the whole text.

    The steps are separate projections on purpose: the text is then normalised once, and each
    finding is worked out once per row and used three times.
    """
    rules = rules or CueRules()
    words, present = F.col("_words"), F.col("_present")

    def finding(level: str, cue: str) -> Column:
        return F.struct(F.lit(level).alias("level"), F.lit(cue).alias("cue"))

    findings = {
        f"_{category}": choose(
            [
                (has_cue(words, present, cue), finding(level, cue))
                for level in reversed(SEVERITIES[1:])
                for cue in levels[level]
            ],
            finding(SEVERITIES[0], ""),
        )
        for category, levels in rules.issues.items()
    }
    mood = choose(
        [
            (has_any_cue(words, present, rules.negative), F.lit("negative")),
            (has_any_cue(words, present, rules.positive), F.lit("positive")),
        ],
        F.lit("neutral"),
    )
    answer = [mood.alias("sentiment")]
    for category in rules.issues:
        level = F.col(f"_{category}.level")
        answer += [
            (level != SEVERITIES[0]).alias(f"issue_{category}"),
            level.alias(f"{category}_severity"),
            F.col(f"_{category}.cue").alias(f"issue_{category}_reason"),
        ]
    normalised = reviews.withColumn("_words", spaced_words(F.col(text)))
    searched = normalised.withColumn("_present", words_present(words, rules.cues()))
    found = searched.withColumns(findings)
    return found.select(*reviews.columns, F.to_json(F.struct(*answer)).alias("analysis_json"))


def classify_by_scorer(reviews: DataFrame, scorer: Scorer, text: str = "review_text") -> DataFrame:
    """Add `analysis_json` from an injected batch scorer, fed with whole prompts."""

    @F.pandas_udf("string")
    def ask(prompts: pd.Series) -> pd.Series:
        return pd.Series(scorer(prompts.tolist()), dtype="object")

    return reviews.withColumn("analysis_json", ask(review_prompt(F.col(text))))


# Flags are read as text so that an answer of "yes" or "maybe" gives a value or NULL, never an error.
ANALYSIS = T.StructType(
    [T.StructField("sentiment", T.StringType())]
    + [
        T.StructField(name, T.StringType())
        for c in REVIEW_CATEGORIES
        for name in (f"issue_{c}", f"{c}_severity", f"issue_{c}_reason")
    ]
)
FLAGS = {f"issue_{c}" for c in REVIEW_CATEGORIES}


def parse_analysis(df: DataFrame, answer: str = "analysis_json") -> DataFrame:
    """Add the 13 answer fields, reading the JSON once per row."""
    parsed = df.withColumn("_answer", F.from_json(F.col(answer), ANALYSIS))
    fields = [
        F.col(f"_answer.{f.name}").try_cast("boolean" if f.name in FLAGS else "string").alias(f.name)
        for f in ANALYSIS
    ]
    return parsed.select(*df.columns, *fields)


def enrich_reviews(reviews: DataFrame, scorer: Scorer | None = None, rules: CueRules | None = None) -> DataFrame:
    """Reviews with answer text and typed fields, before any quality rule. Stateless."""
    answered = classify_by_cues(reviews, rules) if scorer is None else classify_by_scorer(reviews, scorer)
    return parse_analysis(answered)


REVIEW_COLUMNS = [
    "review_id", "order_id", "customer_id", "restaurant_id", "rating", "review_text", "analysis_json",
    *[f.name for f in ANALYSIS], "review_timestamp",
]


def counted_once(enriched: DataFrame) -> DataFrame:
    """A step the optimizer moves nothing across: without it every rule would classify the text again."""
    return enriched.observe(f"rows_{uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def valid_reviews(enriched: DataFrame, metrics: Observation | str | None = None) -> DataFrame:
    """The enriched reviews that pass the review rules. They are always counted: that, too, is such a step."""
    return apply_expectations(enriched, review_rules(), metrics or f"review_rules_{uuid4().hex}")


def fact_review(
    reviews: DataFrame,
    scorer: Scorer | None = None,
    rules: CueRules | None = None,
    metrics: Observation | str | None = None,
) -> DataFrame:
    """Enriched reviews that pass the review rules. `answers.enrich_by_store` puts each text to a scorer once."""
    return valid_reviews(enrich_reviews(reviews, scorer, rules).select(*REVIEW_COLUMNS), metrics)
