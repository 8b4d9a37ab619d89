"""Trained operators: held-out accuracy, agreement with plain programs, and the edges."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ordermill.llm import language, quality
from ordermill.llm.common import fold
from ordermill.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    found = QUERIES["op2_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    held = found.where("held_out").collect()
    assert held and all(0 <= r["score"] <= 1 for r in held)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert {r["held_out"] for r in found.where(fold("doc_id", 4) != 2).collect()} == {False}


def plain_rows(model, word):
    """Word first, then the longest n-grams that any language knows."""
    if word in model.words:
        return model.words[word]
    padded = f"_{word.decode()}_"
    for length in range(len(model.grams), 0, -1):
        grams = [padded[k : k + length] for k in range(len(padded) - length + 1)] or [padded]
        known = [model.grams[length - 1][g] for g in grams if g in model.grams[length - 1]]
        if known:
            return np.mean(known, axis=0)
    return np.zeros(len(model.languages))


def test_scores_follow_the_backoff(spark, edge):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(docs, entries=4000)
    for cached in (1 << 12, language.CACHED):
        language_scorer = language.Scorer(model, max(cached, 1 << 17))
        for row in docs.limit(60).collect():
            words = re.findall(r"[^\W\d_]+", row["text"].lower())
            total = sum(plain_rows(model, w.encode()) for w in words)
            name, score = language_scorer.predict(row["text"].encode())
            best = int(np.argmax(total))
            assert name == model.languages[best] and abs(score - 1 / np.exp(total - total[best]).sum()) < 1e-6
    few = language.fit(docs, sample_rows=10)
    assert few.languages == model.languages and len(few.words) < len(language.fit(docs).words)


def test_language_at_the_edges(edge, edge_rows):
    found = {}
    for r in language.identify(edge, F.lit(True)).collect():
        found.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert found[1] == found[2] == found[3] == found[11] == [(language.UNKNOWN, 0.0)]
    assert (language.UNKNOWN, 0.0) in found[None] and sum(map(len, found.values())) == len(edge_rows)
    assert found[4][0][0] in ("de", "en", "es", "fr") and all(0 <= s <= 1 for rows in found.values() for _, s in rows)
    assert {r["lang_pred"] for r in language.identify(edge, F.lit(False)).collect()} == {language.UNKNOWN}
    assert language.identify(edge.limit(0), F.lit(True)).count() == 0


def accuracy(docs, model, spark, langs):
    found = docs.where(F.col("lang").isin(*langs)).select("lang", language.predicted("text", model, spark).alias("found")).collect()
    return {x: np.mean([r["found"]["lang_pred"] == x for r in found if r["lang"] == x]) for x in langs}


def test_language_with_little_text_takes_no_documents_of_others(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang in ('de', 'en', 'es', 'fr') and length(text) > 100")
    one = [r["doc_id"] for r in docs.where("lang = 'es' and length(text) > 300").orderBy("doc_id").limit(1).collect()]
    model = language.fit(docs.where((F.col("lang") != "es") | F.col("doc_id").isin(one)))
    assert model.languages == ["de", "en", "es", "fr"]
    assert min(accuracy(docs, model, spark, ("de", "en", "fr")).values()) >= 0.97
    floors = [np.min(list(table.values()), axis=0) for table in (model.words, *model.grams[1:])]
    assert all(np.ptp(x) < 1e-9 for x in floors)


def test_language_made_of_copies_is_in_the_sample(spark, make):
    for k, text in enumerate(("uno dos tres", "cuatro cinco", "seis siete ocho", "nueve diez once doce")):
        rows = [(n, text, "es", "s") for n in range(300)] + [(1000 + n, f"one two {'abcdefgh'[n % 8] * 3}", "en", "s") for n in range(300)]
        for docs in (make(rows), make([(None, *r[1:]) for r in rows])):
            model = language.fit(docs, sample_rows=5)
            assert model.words[text.split()[0].encode()][1] > model.words[b"one"][1], k
            assert language.Scorer(model).predict(text.encode())[0] == "es"


def test_quality_of_held_out_documents(spark):
    found = QUERIES["op10_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    good, bad = found[found["quality"] == 1], found[found["quality"] == 0]
    assert len(good) > 50 and len(bad) > 10
    wins = (good["score"].to_numpy()[:, None] > bad["score"].to_numpy()[None, :]).mean()
    assert wins >= 0.97 and (good["predicted"] == 1).mean() >= 0.97 and (bad["predicted"] == 0).mean() >= 0.85


def test_gradient_of_the_loss():
    draw = np.random.default_rng(1)
    sizes = np.array([1, 3, 2, 5])
    x = draw.normal(size=(sizes.sum(), quality.FEATURES))
    starts, bag, y = np.cumsum(sizes) - sizes, np.repeat(np.arange(4), sizes), np.array([1, 0, 1, 0])
    flat = quality.start_parameters()
    _, grad = quality.bag_loss(flat, x, starts, bag, y)
    for k in draw.integers(0, len(flat), 40):
        step = np.zeros_like(flat)
        step[k] = 1e-5
        slope = (quality.bag_loss(flat + step, x, starts, bag, y)[0] - quality.bag_loss(flat - step, x, starts, bag, y)[0]) / 2e-5
        assert abs(slope + quality.DECAY * flat[k] - grad[k]) < 1e-6


def test_loss_of_blocks_is_that_of_the_whole(monkeypatch):
    draw = np.random.default_rng(2)
    sizes = np.array([1, 3, 12, 5, 1, 9])
    x, y = draw.normal(size=(sizes.sum(), quality.FEATURES)), np.array([1, 0, 1, 0, 0, 1])
    starts, bag = np.cumsum(sizes) - sizes, np.repeat(np.arange(6), sizes)
    loss, grad = quality.bag_loss(quality.start_parameters() * 3, x, starts, bag, y)
    for block in (1, 4, 7):
        monkeypatch.setattr(quality, "BLOCK", block)
        again, parts = quality.bag_loss(quality.start_parameters() * 3, x, starts, bag, y)
        assert abs(again - loss) < 1e-12 and np.abs(parts - grad).max() < 1e-12


def test_fit_reads_every_passage(spark, make, monkeypatch):
    # Every other passage is clean; what decides stands in one of some 130.
    clean, draw = "Plain words of a clean passage, as many as fit. " * 11, np.random.default_rng(3)
    clean = clean[: quality.PASSAGE]
    rows = []
    for k in range(60):
        parts = [clean] * 130
        if k % 2:
            parts[draw.integers(1, 129)] = ("#$ %% @@ !! " * 50)[: quality.PASSAGE]
        rows.append((k, "".join(parts), "en", "s"))
    docs = make([*rows, (1, rows[1][1], "en", "s")])
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(60)], "doc_id long, quality int")
    every = np.concatenate([quality.features([text.encode()])[0] for _, text, _, _ in [*rows, rows[1]]])
    model = quality.fit(docs, labels, F.lit(True))
    assert np.abs(model.centre - every.mean(0, dtype=np.float64)).max() < 1e-9
    found = model.score_all([text.encode() for _, text, _, _ in rows])
    assert all((score >= 0.5) == (k % 2 == 0) for k, score in enumerate(found))
    # The same of rows that hold a few passages each, in more shards than one.
    monkeypatch.setattr(quality, "SHARD_PASSAGES", 2_000)
    monkeypatch.setattr(quality, "CHUNK", quality.PASSAGE * 8)
    for _, text, _, _ in rows[:2]:
        parts = list(quality.long_features(text.encode()))
        assert len(parts) > 16 and np.array_equal(np.concatenate(parts), quality.features([text.encode()])[0])
    again = quality.fit(docs, labels, F.lit(True))
    assert np.abs(again.centre - model.centre).max() < 1e-9


def test_score_is_the_attention_weighted_passage(edge_rows):
    model = quality.Model(quality.start_parameters(3) * 3, np.zeros(quality.FEATURES), np.ones(quality.FEATURES), 0.5)
    texts = [(r[1] or "").encode() for r in edge_rows]
    p = quality.unpacked(model.flat)
    for text, score in zip(texts, model.score_all(texts)):
        if len(text) > quality.CHUNK:
            continue
        x, _ = quality.features([text])
        h = np.tanh(x @ p[0] + p[1])
        a = np.exp((np.tanh(h @ p[2]) / (1 + np.exp(-h @ p[3]))) @ p[4])
        assert abs(1 / (1 + np.exp(-((a / a.sum()) @ h @ p[5] + p[6][0]))) - score) < 1e-9
    # Cut at a passage's edge, a long text scores as it does whole.
    text = texts[6][: quality.PASSAGE * 40]
    keep, quality.CHUNK = quality.CHUNK, quality.PASSAGE * 8
    try:
        pieces = model.long_score(text)
    finally:
        quality.CHUNK = keep
    assert abs(pieces - model.scores([text])[0]) < 0.02


def test_a_long_text_scores_as_it_does_whole(edge_rows, monkeypatch):
    model = quality.Model(quality.start_parameters(3) * 3, np.zeros(quality.FEATURES), np.ones(quality.FEATURES), 0.5)
    prose = edge_rows[6][1].encode()
    texts = [prose[: quality.PASSAGE * 40], prose[:20_001], b"x" * 9_000 + b" y" * 3_000, b"ab c" + b"z" * 700 + b" " + prose[:9_000], b""]
    whole = [model.scores([text])[0] for text in texts]
    monkeypatch.setattr(quality, "CHUNK", quality.PASSAGE * 8)
    assert max(abs(model.long_score(text) - score) for text, score in zip(texts, whole)) < 1e-6


def test_quality_at_the_edges(spark, edge, edge_rows):
    labels = spark.createDataFrame(
        [(k, k % 2, "x") for k in range(12)] + [(5, 1, "x"), (5, None, "x"), (None, 1, "x")], "doc_id long, quality int, score string"
    )
    got = quality.classify(edge, labels, F.lit(True))
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(r[0] for r in edge_rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.collect())
    none, same = labels.limit(0), labels.where("quality = 1")
    assert {r["score"] for r in quality.classify(edge, none, F.lit(True)).collect()} == {0.5}
    assert {r["score"] for r in quality.classify(edge, same, F.lit(True)).collect()} == {1.0}
    assert quality.classify(edge.limit(0), labels, F.lit(True)).count() == 0
    kept = quality.kept(edge, same, F.lit(True))
    assert kept.columns == edge.columns and kept.count() == len(edge_rows)


def test_words_are_letters_with_their_marks():
    def words(text):
        return [w.decode() for some in language.words_of(text.encode()) for w in some]

    assert words("½ ² ٣ – “”") == [] == words("́ 1́ ٣́")
    assert words("हिन्दी में été Été") == ["हिन्दी", "में", "été", "été"]
    model = language.Model(["de", "en"], {b"a": np.array([-1.0, -2.0])}, [{}])
    scorer = language.Scorer(model)
    assert scorer.predict("½ ²".encode()) == ("und", 0.0) and scorer.predict("a ½".encode())[0] == "de"
