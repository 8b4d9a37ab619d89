import json

import pytest
from pyspark.sql import functions as F

from ordermill.operators import reviews as rv
from ordermill.operators.quality import REVIEW_CATEGORIES, review_rules, violation_counts

RAW = (
    "review_id string, order_id string, customer_id string, restaurant_id string, review_text string, "
    "rating int, review_timestamp string"
)


def texts(spark, *lines):
    rows = [(f"R{i}", "O", "C", "V", line, 4, "2024-01-01 00:00:00") for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, RAW)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Great food, friendly staff!", {"sentiment": "positive"}),
        ("The kebab was STALE, and the courier was a bit  late.", {
            "sentiment": "neutral", "issue_food_quality": True, "food_quality_severity": "moderate",
            "issue_food_quality_reason": "stale", "issue_delivery": True, "delivery_severity": "minor",
            "issue_delivery_reason": "bit late"}),
        ("It never arrived. Very late, as ever: terrible", {
            "sentiment": "negative", "delivery_severity": "severe", "issue_delivery_reason": "never arrived"}),
        ("overpriced... rip-off", {"pricing_severity": "severe", "issue_pricing_reason": "rip off"}),
        ("a strawberry", {"food_quality_severity": "none", "issue_food_quality": False}),
        ("tiny; portion", {"portion_size_severity": "moderate"}),
        ("", {"sentiment": "neutral"}),
    ],
)
def test_cues(spark, text, expected):
    row = rv.enrich_reviews(texts(spark, text)).first().asDict()
    assert {k: row[k] for k in expected} == expected
    for c in REVIEW_CATEGORIES:
        if not row[f"issue_{c}"]:
            assert row[f"{c}_severity"] == "none" and row[f"issue_{c}_reason"] == ""


def test_a_cue_at_the_end_of_a_very_long_text_counts(spark):
    row = rv.enrich_reviews(texts(spark, "word " * 200_000 + "inedible")).first()
    assert row.food_quality_severity == "severe"


def answer(**changes):
    base = {"sentiment": "neutral"}
    for c in REVIEW_CATEGORIES:
        base |= {f"issue_{c}": False, f"{c}_severity": "none", f"issue_{c}_reason": ""}
    return json.dumps(base | changes)


def test_parsing_tolerates_any_answer(spark):
    answers = [
        answer(issue_pricing=True, pricing_severity="minor"),
        answer(issue_delivery="maybe"),
        answer(delivery_severity="high"),
        '{"rating": 1}',
        "Here you go: " + answer(),
        "",
        None,
    ]
    df = spark.createDataFrame([(i, 3, a) for i, a in enumerate(answers)], "n int, rating int, analysis_json string")
    rows = rv.parse_analysis(df).orderBy("n").collect()
    assert rows[0].issue_pricing is True and rows[0].pricing_severity == "minor"
    assert rows[1].issue_delivery is None and rows[1].sentiment == "neutral"
    assert rows[2].delivery_severity == "high"
    assert all(r.sentiment is None for r in rows[3:])
    counts = {r.rule: r.row_count for r in violation_counts(rv.parse_analysis(df), review_rules()).collect()}
    assert counts["rows_kept"] == 2 and counts["valid_delivery_severity"] == 5


def test_an_injected_scorer_sees_whole_prompts_and_decides(spark):
    good, odd = answer(sentiment="positive"), answer(sentiment="odd")

    def scorer(prompts):
        return [good if p.endswith("lovely") and p.startswith("You") else odd for p in prompts]

    kept = rv.fact_review(texts(spark, "lovely", "dull"), scorer).collect()
    assert [r.review_id for r in kept] == ["R0"]
    assert kept[0].sentiment == "positive"


def test_prompt_names_every_key(spark):
    prompt = spark.range(1).select(rv.review_prompt(F.lit("TEXT"))).first()[0]
    assert prompt.endswith("TEXT")
    for c in REVIEW_CATEGORIES:
        assert f"issue_{c}" in prompt and f"{c}_severity" in prompt


def test_the_text_is_classified_once_per_row(spark):
    plan = rv.fact_review(texts(spark, "x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
    assert plan.count("from_json") == 1


def test_letters_of_any_script_belong_to_words(spark):
    rules = rv.CueRules(positive=("вкусно", "délicieux"), negative=("ужасно",), issues={"food_quality": {"severe": ("raw",), "moderate": (), "minor": ("сырой",)}})
    texts = [("a", "Очень ВКУСНО!"), ("b", "C'était délicieux."), ("c", "sërawé"), ("d", "стейк сырой"), ("e", "raw")]
    df = spark.createDataFrame(texts, "k string, review_text string")
    got = {r.k: r.analysis_json for r in rv.classify_by_cues(df, rules).collect()}
    assert '"sentiment":"positive"' in got["a"] and '"sentiment":"positive"' in got["b"]
    assert '"food_quality_severity":"none"' in got["c"] and '"food_quality_severity":"minor"' in got["d"]
    assert '"food_quality_severity":"severe"' in got["e"]


def test_insults_name_no_issue(spark):
    df = spark.createDataFrame([("What an idiot of a parrot",)], "review_text string")
    answer = rv.classify_by_cues(df).first().analysis_json
    assert '"sentiment":"negative"' in answer and "true" not in answer


def test_rounding_keeps_large_numbers(spark):
    from ordermill.functions.numbers import round_half_up

    row = spark.sql("SELECT 2e18D AS a, 0.575D AS b, -1e300D AS c, CAST(NULL AS double) AS d").select(
        *[round_half_up(c, 2).alias(c) for c in "abcd"]).first()
    assert tuple(row) == (2e18, 0.58, -1e300, None)


def test_cues_come_from_a_table(spark):
    rows = [
        ("positive", None, 1, "Splendid"), ("negative", None, 2, "dire"), ("negative", None, 1, "grim"),
        ("pricing", "severe", 1, "theft"), ("pricing", "minor", 2, "steep"),
    ]
    cues = spark.createDataFrame(rows, "topic string, level string, place int, cue string")
    rules = rv.CueRules.read(cues)
    assert rules.negative == ["grim", "dire"] and rules.issues["pricing"]["minor"] == ["steep"]
    found = rv.enrich_reviews(texts(spark, "A splendid but steep place", "grim theft"), rules=rules).collect()
    assert [(r.sentiment, r.pricing_severity, r.issue_pricing_reason) for r in found] == [("positive", "minor", "steep"), ("negative", "severe", "theft")]
    with pytest.raises(ValueError, match="topic"):
        rv.CueRules.read(spark.createDataFrame([("pricing", "odd", 1, "x")], "topic string, level string, place int, cue string"))
