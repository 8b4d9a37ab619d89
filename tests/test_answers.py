import json
import os

import pytest
from pyspark.sql import functions as F

from ordermill.operators import answers
from ordermill.operators.reviews import INSTRUCTION
from ordermill.streaming import flows
from tests.test_streaming import done

GOOD = json.dumps({"sentiment": "positive", **{f"{c}_severity": "none" for c in ("delivery", "food_quality", "pricing", "portion_size")}})


@pytest.fixture()
def make():
    # Inside a function, so that workers get it by value.
    class Model:
        """A scorer that notes every prompt in a file, as it runs in workers."""

        def __init__(self, path, broken=()):
            self.path, self.broken, self.start = str(path), set(broken), len(INSTRUCTION)

        def __call__(self, prompts):
            texts = [p[self.start :] for p in prompts]
            if self.broken & set(texts):
                raise RuntimeError("overloaded")
            with open(self.path, "a") as file:
                file.writelines(t + "\n" for t in texts)
            return ["nonsense" if t == "odd" else GOOD for t in texts]

        def asked(self):
            if not os.path.exists(self.path):
                return []
            with open(self.path) as file:
                return sorted(file.read().split())

    return Model


def reviews(spark, *texts):
    rows = [(f"R{n}", f"O{n}", "C1", "V1", t, 4, "2024-01-01") for n, t in enumerate(texts)]
    columns = "review_id string, order_id string, customer_id string, restaurant_id string, review_text string, rating int, review_timestamp string"
    return spark.createDataFrame(rows, columns).repartition(2)


def test_each_text_is_asked_once(spark, database, tmp_path, make):
    store, model = f"{database}.answers", make(tmp_path / "asked")
    first = reviews(spark, "a", "b", "a", None, "c")
    got = answers.enrich_by_store(first, model, store, "v1").collect()
    assert model.asked() == ["a", "b", "c"]
    assert {r.review_text: r.sentiment for r in got} == {"a": "positive", "b": "positive", "c": "positive", None: None} and len(got) == 5
    answers.enrich_by_store(first, model, store, "v1").collect()
    assert model.asked() == ["a", "b", "c"]
    answers.enrich_by_store(reviews(spark, "d", "b"), model, store, "v1").collect()
    assert model.asked() == ["a", "b", "c", "d"]
    answers.enrich_by_store(reviews(spark, "b"), model, store, "v2").collect()
    assert model.asked() == ["a", "b", "b", "c", "d"]
    assert answers.prompt_version("m1") != answers.prompt_version("m2")


def test_a_text_that_fails_is_lost_alone_and_tried_again(spark, database, tmp_path, make):
    store, model = f"{database}.answers", make(tmp_path / "asked", {"bad"})
    many = reviews(spark, *[f"t{n}" for n in range(40)], "bad", "odd")
    for tries in (1, 2):
        got = {r.review_text: r.sentiment for r in answers.enrich_by_store(many, model, store, "v").collect()}
        assert [t for t, mood in got.items() if mood is None] and {t for t, mood in got.items() if mood is None} == {"bad", "odd"}
        held = {(r.tries, r.failure.split(":")[0]) for r in answers.failures(spark, store, "v").collect()}
        assert held == {(tries, "RuntimeError"), (tries, "unreadable answer")}
    assert len([t for t in model.asked() if t == "t7"]) == 1
    model.broken.clear()
    got = {r.review_text: r.sentiment for r in answers.enrich_by_store(many, model, store, "v").collect()}
    assert got["bad"] == "positive" and got["odd"] is None
    answers.enrich_by_store(many, model, store, "v").collect()
    assert model.asked().count("odd") == answers.ATTEMPTS


def test_a_scorer_that_leaves_answers_out(tmp_path):
    found = answers.ask(lambda prompts: [GOOD] * (1 if len(prompts) == 1 else 0), ["a", "b", "c"])
    assert found == [(GOOD, None)] * 3
    assert answers.ask(lambda prompts: [], ["a"])[0][1].startswith("ValueError: 0 answers")


def test_the_review_stream_asks_once_and_replaces_a_replayed_batch(spark, database, tmp_path, make):
    model, path = make(tmp_path / "asked"), str(tmp_path / "reviews")
    table = f"{database}.reviews"

    def run():
        stream = spark.readStream.schema(reviews(spark, "a").schema).parquet(path)
        done(flows.fact_review_stream(stream, table, str(tmp_path / "c"), model))

    reviews(spark, "a", "b", "odd").coalesce(1).write.parquet(path)
    run()
    reviews(spark, "b", "c").withColumn("review_id", F.concat(F.lit("later"), "review_id")).coalesce(1).write.mode("append").parquet(path)
    run()
    assert model.asked() == ["a", "b", "c", "odd"]
    assert sorted(r.review_text for r in spark.table(table).collect()) == ["a", "b", "b", "c"]
    assert [(r.review_text, len(r.reasons)) for r in spark.table(f"{table}_rejects").collect()] == [("odd", 5)]


@pytest.mark.parametrize("answer, good", [(GOOD, True), ("[]", False), ("{}", False), (None, False), ("{", False)])
def test_readable_answers(answer, good):
    assert answers._readable(answer) == good
