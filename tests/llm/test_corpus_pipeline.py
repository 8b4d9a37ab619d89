"""The pipeline stage by stage, each on its own input, and whole."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import rows_of
from ordermill.llm import decontamination, mixing, secret_scan, simhash
from ordermill.llm.queries import ORACLES, QUERIES
from ordermill.session import materialise

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_take_effect_on_all_that_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = materialise(stage(spark, docs, SF), "stage")
        if number < 4:
            assert out.columns == docs.columns
        if number == 0:
            scores = QUERIES["op10_quality"](spark, SF)
            assert ids(out) == ids(scores.where("predicted = 1")) and ids(scores.where("predicted = 0"))
        if number == 1:
            found = simhash.near_duplicates(docs)
            assert ids(out) == ids(found.where("doc_id = component_id")) and out.count() < docs.count()
        if number == 2:
            hit = decontamination.contaminations(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert ids(out) == ids(docs.join(hit, "doc_id", "left_anti")) and out.count() < docs.count()
        if number == 3:
            assert ids(out) == ids(docs)
            before = {r["doc_id"] for r in secret_scan.scan(docs).where("spans <> ''").collect()}
            texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
            changed = {r["doc_id"] for r in out.collect() if texts[r["doc_id"]] != (r["text"], r["n_chars"])}
            assert before and changed == before
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect() if r["doc_id"] in changed)
        if number == 4:
            assert rows_of(out.columns, out.collect()) == rows_of(out.columns, mixing.mix(docs).select(*out.columns).collect())
        docs = out
    assert rows_of(docs.columns, corpus_pipeline.run(spark, SF).collect()) == rows_of(docs.columns, docs.collect())


def test_stages_at_the_edges(spark, edge):
    for docs in (edge, edge.limit(0)):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = materialise(stage(spark, docs, SMALL), "stage")
            assert out.columns == docs.columns or number == 4
            docs = out


def test_first_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    out = corpus_pipeline.quality_filter(spark, docs, SF)
    assert out.join(good, "doc_id").count() >= 0.99 * docs.join(good, "doc_id").count()


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = QUERIES[name](spark, SMALL)
    cursor = connection.execute(ORACLES[name])
    got = rows_of(frame.columns, frame.collect())
    assert got[1] and got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert [n for n in QUERIES if n.startswith("op")] == list(QUERIES)


def test_one_document_stays_of_each_group_whatever_the_ids(spark):
    base = " ".join(f"word{k}" for k in range(400))
    near = base.replace("word399", "other")
    assert bin(simhash.fingerprint(base.encode()) ^ simhash.fingerprint(near.encode())).count("1") <= 3
    far = " ".join(f"else{k}" for k in range(300))
    rows = [(5, base), (5, near), (6, base), (None, far), (None, far), (None, near), (9, "own text here now"), (9, "own text here now")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, __simhash_tag string").repartition(3)
    kept = [(r.doc_id, r.text) for r in simhash.deduplicated(docs).collect()]
    assert sorted(kept, key=str)[0][0] == 5 and sorted(str(i) for i, _ in kept) == ["5", "9", "None"]
    assert [t for i, t in kept if i is None] == [far]
    assert simhash.deduplicated(docs).columns == docs.columns
