"""Importance resampling against a plain program."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ordermill.llm import importance, queries

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def features(text):
    words = WORD.findall((text or "").encode().lower())
    return words, Counter(zlib.crc32(x) % 10_000 for x in [*words, *(a + b" " + b for a, b in zip(words, words[1:]))])


def expected(docs, items, percent=25):
    read = [(doc, *features(text)) for doc, text in docs]
    s = sum((c for _, _, c in read), Counter())
    t = sum((features(text)[1] for text in items), Counter())
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))

    out = []
    for doc, words, counts in read:
        total = sum(counts.values())
        weight = sum(gain(b) * n for b, n in counts.items()) // total if total else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, total, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words) >= 20])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: len(able) * percent // 100]):
        row[4] = place + 1
    return Counter(tuple(r[:5]) for r in out)


def rows(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def test_crc_of_ranges_of_any_length():
    draw = random.Random(1)
    data = np.frombuffer(draw.randbytes(20_000), np.uint8)
    starts = [0, 5, 7, 0, 100, 3, 0] + [draw.randrange(1000) for _ in range(300)]
    lengths = [0, 1, 30, 256, 10_000, 515, 20_000] + [draw.randrange(600) for _ in range(300)]
    got = importance.crc32(data, np.array(starts), np.array(lengths))
    assert got.tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, lengths)]


@pytest.mark.parametrize("group", [1 << 21, 50])
def test_features_of_texts_in_groups(group, monkeypatch):
    monkeypatch.setattr(importance, "GROUP", group)
    texts = ["", "a", "One TWO one two", "x" * 1000 + " y " + "é" * 700, " ".join(f"w{k % 7}" for k in range(500))]
    counts, words = [Counter() for _ in texts], [0] * len(texts)
    for row, bucket, piece_row, fresh in importance.Features(10_000, 2).groups([x.encode() for x in texts]):
        for r, b in zip(row.tolist(), bucket.tolist()):
            counts[r][b] += 1
        for r, n in zip(piece_row.tolist(), fresh.tolist()):
            words[r] += n
    assert counts == [features(x)[1] for x in texts] and words == [len(features(x)[0]) for x in texts]


def test_longer_runs(monkeypatch):
    monkeypatch.setattr(importance, "GROUP", 40)
    text = " ".join(f"w{k % 5}" for k in range(100)).encode()
    found = Counter()
    for _, bucket, _, _ in importance.Features(1 << 32, 3).groups([text]):
        found.update(bucket.tolist())
    words = text.split()
    assert found == Counter(zlib.crc32(b" ".join(words[k : k + n])) for n in (1, 2, 3) for k in range(len(words) - n + 1))


def test_query_on_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = expected(docs, items)
    assert rows(queries.op13_importance(spark, sf_dir)) == want and sum(r[4] is not None for r in want) > 10


def test_edges(spark, edge, edge_rows):
    items = spark.createDataFrame([(1, None), (2, ""), (3, edge_rows[5 + 5][1])], "item_id long, text string")
    got = importance.resample(edge, items, percent=50)
    assert rows(got) == expected([r[:2] for r in edge_rows], [edge_rows[10][1]], 50)
    assert rows(importance.resample(edge, items.limit(0))) == expected([r[:2] for r in edge_rows], [])
    assert importance.resample(edge.limit(0), items).count() == 0


def test_equal_scores_go_to_smaller_ids(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(importance, "noise", lambda id_col, seed: F.lit(0).cast("long"))
    docs = spark.createDataFrame([(k, "same " * 30) for k in range(40)], "doc_id long, text string").repartition(3)
    got = importance.resample(docs, docs.limit(1), percent=25).where("rank IS NOT NULL").orderBy("rank")
    assert [(r.doc_id, r["rank"]) for r in got.collect()] == [(k, k + 1) for k in range(10)]
