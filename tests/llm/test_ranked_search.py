"""Ranked search against a plain program, and its lists and bounds by themselves."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ordermill.llm import queries, ranked_search

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text):
    return TERM.findall((text or "").encode().lower())


def brute(docs, items, k=10):
    held = [(doc, Counter(terms(text)), len(terms(text))) for doc, text in docs]
    held = [x for x in held if x[2]]
    n_docs, n_terms = len(held), sum(x[2] for x in held)
    df = Counter(t for _, counts, _ in held for t in counts)
    out = Counter()
    for item, text in items:
        found = []
        for doc, counts, n in held:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in terms(text)
                if counts[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out.update((item, rank + 1, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(found)[:k]))
    return out


def rows(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_query_on_tables(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert want and rows(queries.op12_ranked_search(spark, sf_dir)) == want


@pytest.mark.parametrize("shard_docs, block", [(1 << 16, 128), (3, 2)])
def test_edges(spark, edge, edge_rows, shard_docs, block, monkeypatch):
    long = edge_rows[6][1]
    texts = [long[900_000:900_400], edge_rows[7][1], edge_rows[7][1], None, "", "absent terms only zz", edge_rows[0][1], "ONE one 漢字"]
    rows_in = [(k if k != 6 else None, t, "x") for k, t in enumerate(texts)]
    items = spark.createDataFrame(rows_in, "item_id long, text string, score string")
    want = brute([r[:2] for r in edge_rows], [r[:2] for r in rows_in])
    for size in (1 << 20, 300):  # in one block and in several
        assert rows(ranked_search.search(edge, items, block_bytes=size)) == want
    doubled = items.unionAll(items)
    assert rows(ranked_search.search(edge, doubled)) == want
    assert ranked_search.search(edge.limit(0), items).count() == 0
    assert ranked_search.search(edge, items.limit(0)).count() == 0
    assert ranked_search.search(edge.where("text IS NULL"), items).count() == 0


def test_lists_come_back_as_they_were():
    draw = np.random.default_rng(4)
    for size in (1, 127, 128, 129, 5000):
        docs = np.unique(draw.integers(0, 200_000, size))
        tf = draw.integers(1, 5, len(docs)) * draw.choice([1, 1000, 100_000], len(docs))
        m = draw.integers(25, 300, 200_001)
        worth = ranked_search.impact(tf, m[docs])
        held = ranked_search.Postings(worth.max(), *ranked_search.compress(docs, tf, worth), m)
        assert [x.tolist() for x in held.all()] == [docs.tolist(), worth.tolist()]
        asked = np.arange(0, 200_000, 7)
        at, top = held.bounds(asked)
        known = dict(zip(docs.tolist(), worth.tolist()))
        assert all(known.get(d, 0) <= t for d, t in zip(asked.tolist(), top.tolist()))
        inside = at < len(held.tops)
        assert held.of(asked[inside], at[inside]).tolist() == [known.get(d, 0) for d in asked[inside].tolist()]


def test_a_shard_gives_its_best_and_leaves_blocks_compressed():
    draw = np.random.default_rng(9)
    size, skipped = 20_000, 0
    m = np.sort(draw.integers(25, 400, size))
    for turn in range(30):
        lists, total = [], np.zeros(size, np.int64)
        for share, w in ((0.0005, 7000), (0.002, 5500), (0.3, 900), (0.9, 100), (0.5, 0)):
            docs = np.flatnonzero(draw.random(size) < share)
            if not len(docs):
                continue
            tf = draw.geometric(0.5, len(docs))
            worth = ranked_search.impact(tf, m[docs])
            lists.append((w, ranked_search.Postings(worth.max(), *ranked_search.compress(docs, tf, worth), m)))
            total[docs] += w * worth
        docs, scores = ranked_search.best_of_shard(lists, size, 10)
        floor = np.sort(total)[-10]
        want = {d: total[d] for d in np.flatnonzero((total >= floor) & (total > 0))}
        assert dict(zip(docs, scores)) == want
        skipped += sum(len(p.ends) - len(p.blocks) for _, p in lists)
    assert skipped > 1000


def test_fewer_documents_than_asked_for():
    m = np.full(5, 100)
    held = ranked_search.Postings(1000, *ranked_search.compress(np.array([1, 3]), np.array([1, 2]), np.array([500, 1000])), m)
    docs, scores = ranked_search.best_of_shard([(2, held), (0, held)], 5, 10)
    assert docs.tolist() == [1, 3] and (scores > 0).all()
    assert [x.tolist() for x in ranked_search.best_of_shard([(0, held)], 5, 10)] == [[], []]


def test_groups_of_equal_documents_tie_to_smaller_ids(spark):
    docs = spark.createDataFrame([(k, "same words here") for k in range(50)] + [(99, "words")], "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(1, "here words")], "item_id long, text string")
    by_item = defaultdict(list)
    for r in ranked_search.search(docs, items).orderBy("rank").collect():
        by_item[r.item_id].append(r.doc_id)
    assert by_item == {1: list(range(10))}
