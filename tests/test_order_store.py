import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ordermill.functions.payload import ORDER_PAYLOAD
from ordermill.operators import marts, quality, reviews, silver
from ordermill.sources import kafka, sinks
from ordermill.streaming import orders as store_module
from ordermill.streaming.orders import (
    OrderStore, daily_step, entity_step, follow_changes, items_step, merge_orders, order_store_stream, orders_step, review_step_stream,
)
from tests.test_streaming import Topic, done


def message(n, day=5, hour=10, made=None, status="completed", amount=5.0, customer=None, venue="V1"):
    at = f"2024-01-{day:02d}T{hour:02d}:00:00+00:00"
    items = [{"item_id": "a", "name": "Stew", "quantity": 2, "unit_price": amount / 2, "subtotal": amount}]
    return json.dumps({
        "order_id": None if n is None else f"O{n}", "timestamp": at, "restaurant_id": venue, "customer_id": customer or f"C{n}",
        "order_type": "dine_in", "items": items, "total_amount": amount, "payment_method": "card", "order_status": status,
        "created_at": made or at,
    })


@pytest.fixture()
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture()
def store(database):
    return OrderStore(f"{database}.unified", buckets=8)


@pytest.fixture()
def run(spark, topic, store, tmp_path):
    def send(*values, **options):
        topic.send(*values)
        options = {"checkpoint": str(tmp_path / "store"), **options}
        done(order_store_stream(kafka.bronze_orders(topic.read()), store, **options))

    return send


def batch_build(spark, topic):
    return silver.unify_orders([("streaming_kafka", kafka.bronze_orders(spark.read.parquet(topic.path)).where("order_id IS NOT NULL"))])


def same(got, want):
    want = want.select(*[c for c in got.columns if c in want.columns])
    got = got.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_one_row_per_id_over_all_days(spark, topic, store, run, tmp_path):
    run(message(1, 5, 23), message(2, 6), message(3, 7))
    run(message(1, 6, 0), message(1, 4, 1), message(4, 6))
    run(message(1, 5, 23), message(2, 6, made="2024-01-09T00:00:00+00:00", status="delivered"))
    run()
    rows = spark.table(store.orders)
    assert rows.count() == 4
    same(rows.drop("order_date"), batch_build(spark, topic))
    assert {r.order_id: r.order_date.day for r in rows.collect()} == {"O1": 6, "O2": 6, "O3": 7, "O4": 6}
    # From the start once more, under another name: all copies, nothing new.
    changes = spark.table(store.changes).count()
    run(checkpoint=str(tmp_path / "again"), stream="again")
    same(spark.table(store.orders).drop("order_date"), batch_build(spark, topic))
    assert spark.table(store.changes).count() == changes


def test_a_batch_that_breaks_off_is_completed_by_its_replay(spark, store, topic, monkeypatch):
    def survivors(*values):
        rows = spark.createDataFrame([(v,) for v in values], "raw string").select(F.from_json("raw", ORDER_PAYLOAD).alias("d")).select("d.*")
        return silver.unify_orders([("s", rows)])

    merge_orders(survivors(message(1, 5), message(2, 5), message(3, 6)), store)
    second = survivors(message(1, 7, made="2024-02-01T00:00:00+00:00"), message(4, 5), message(5, 9))
    real, calls = sinks.append_rows, []

    def broken(df, table, *rest):
        calls.append(table)
        if len(calls) in (2, 5):  # the change log of the first try, the keys of the second
            raise OSError("lost")
        real(df, table, *rest)

    monkeypatch.setattr(sinks, "append_rows", broken)
    for _ in range(2):
        with pytest.raises(OSError):
            merge_orders(second, store)
    assert calls[-1] == store.keys
    monkeypatch.undo()
    merge_orders(second, store)
    rows = {r.order_id: r.order_date.day for r in spark.table(store.orders).collect()}
    assert rows == {"O1": 7, "O2": 5, "O3": 6, "O4": 5, "O5": 9} and spark.table(store.orders).count() == 5
    listed = {(r.order_id, r.order_date.day) for r in spark.table(store.changes).collect()}
    assert {("O1", 5), ("O1", 7), ("O4", 5), ("O5", 9)} <= listed


def test_a_batch_looks_into_its_own_buckets_only(spark, store, run, monkeypatch):
    run(*[message(n) for n in range(60)])
    read = []
    real = store_module._stored_keys
    monkeypatch.setattr(store_module, "_stored_keys", lambda *a: read.append(real(*a)) or read[-1])
    run(message(7), message(7, 6, made="2024-03-01T00:00:00+00:00"))
    own = spark.range(1).select(F.pmod(F.xxhash64(F.lit("O7")), F.lit(8))).first()[0]
    files = read[0].inputFiles()
    assert files and {f.split("bucket=")[1].split("/")[0] for f in files} == {str(own)}


def test_key_buckets_are_rewritten_with_one_key_per_id(spark, store, run, monkeypatch):
    monkeypatch.setattr(store_module, "KEY_FILES", 3)
    for turn in range(5):
        run(*[message(n, made=f"2024-02-0{turn + 1}T00:00:00+00:00") for n in range(6)])
    assert spark.table(store.keys).count() < 18 and spark.table(store.orders).count() == 6
    assert {str(r.created_at)[:10] for r in spark.table(store.orders).collect()} == {"2024-02-05"}


def test_messages_without_id_are_kept_whole_and_once(spark, store, run, topic, tmp_path):
    run(message(1), *["{bad %d" % n for n in range(1000)], message(None), message(None), "")
    rejects = spark.table(store.rejects)
    assert {r.reason: r.n for r in rejects.groupBy(F.col("reasons")[0].alias("reason")).agg(F.count("*").alias("n")).collect()} == {
        "unreadable_message": 1001, "valid_order_id": 2}
    assert rejects.where("row = '{bad 17'").count() == 1 and spark.table(store.orders).count() == 1
    messages = kafka.bronze_orders(spark.read.parquet(topic.path))
    for _ in range(2):
        store_module.reject_batch(messages, store, 0, "orders")
    assert spark.table(store.rejects).count() == 1003
    unified = silver.unify_orders([("a", messages)])
    assert unified.count() == 1004
    counts = {r.rule: r.row_count for r in quality.violation_counts(silver.order_headers(unified), silver.header_rules()).collect()}
    assert counts["rows_in"] == 1004 and counts["valid_order_id"] == 1003
    assert quality.quarantine(silver.order_headers(unified), silver.order_rules()).count() == 1003


def test_facts_rejects_and_counts_follow_the_changes(spark, store, run, topic, database, tmp_path):
    names = facts, items, gold, bad, log = [f"{database}.{n}" for n in ("facts", "items", "gold", "bad", "log")]
    steps = [
        orders_step(store, facts, bad, log), items_step(store, items, bad, log),
        daily_step([facts], gold, marts.daily_sales_summary),
    ]

    def follow():
        done(follow_changes(spark, store, steps, str(tmp_path / "follow")))

    run(message(1, 5), message(2, 6, status="cancelled"), message(3, 6, amount=-1.0), message(4, 7))
    follow()
    run(message(4, 8, made="2024-02-01T00:00:00+00:00"), message(3, 6, made="2024-02-01T00:00:00+00:00"), message(5, 6))
    follow()
    follow()
    unified = batch_build(spark, topic)
    same(spark.table(facts), silver.fact_orders(unified))
    same(spark.table(items), silver.fact_order_items(unified))
    same(spark.table(gold).select("order_date", "total_orders", "total_revenue"), marts.daily_sales_summary(silver.fact_orders(unified)))
    assert {r.order_date.day for r in spark.table(gold).collect()} == {5, 6, 8}  # the seventh was recomputed to nothing
    held = spark.table(bad).where(F.col("table_name") == facts).collect()
    assert [(json.loads(r.row)["order_id"], r.reasons) for r in held] == [("O2", ["valid_order_status"])]
    counted = {r.measure: r.value for r in spark.table(log).where(F.col("table_name") == facts).groupBy("measure").agg(F.sum("value").alias("value")).collect()}
    want = {r.rule: r.row_count for r in quality.violation_counts(silver.order_headers(unified), silver.header_rules()).collect()}
    want.pop("rows_kept")
    assert counted == want and len(names) == 5


def test_profiles_follow_the_changes_bucket_by_bucket(spark, store, run, topic, database, tmp_path):
    as_of, buckets = "2024-02-01", 4
    t = {n: f"{database}.{n}" for n in ("facts", "bad", "orders_c", "orders_v", "reviews_c", "reviews_v", "customers", "venues", "pref", "c360", "v360", "reviews")}
    customers = spark.createDataFrame([(f"C{n}",) for n in range(12)], "customer_id string")
    venues = spark.createDataFrame([(f"V{n}", f"Acme {n}", "X") for n in range(5)], "restaurant_id string, name string, city string")
    customers.write.saveAsTable(t["customers"])
    venues.write.saveAsTable(t["venues"])
    raw = spark.createDataFrame(
        [(f"R{n}", f"O{n}", f"C{n % 4}", f"V{n % 3}", "stale bread" if n % 2 else "great", n % 5 + 1, "2024-01-09") for n in range(8)],
        "review_id string, order_id string, customer_id string, restaurant_id string, review_text string, rating int, review_timestamp string",
    )
    facts_of_reviews = reviews.fact_review(raw)
    for copy in ("reviews_c", "reviews_v"):
        empty = facts_of_reviews.limit(0).withColumn("bucket", F.lit(0))
        sinks.overwrite_table(empty, t[copy], partition_by=["bucket"])
    customer_marts = [
        (t["pref"], lambda rows: marts.customer_restaurant_preference(rows(t["orders_c"]), rows(t["reviews_c"]), as_of)),
        (t["c360"], lambda rows: marts.customer_360(
            rows(t["customers"]), rows(t["orders_c"]), rows(t["reviews_c"]), rows(t["pref"]), rows(t["venues"]), as_of)),
    ]
    venue_marts = [(t["v360"], lambda rows: marts.restaurant_360(rows(t["venues"]), rows(t["orders_v"]), rows(t["reviews_v"]), as_of))]
    steps = [
        orders_step(store, t["facts"], t["bad"]),
        entity_step(store, t["facts"], t["orders_c"], "customer_id", customer_marts, buckets),
        entity_step(store, t["facts"], t["orders_v"], "restaurant_id", venue_marts, buckets),
    ]

    def follow():
        done(follow_changes(spark, store, steps, str(tmp_path / "follow")))

    run(*[message(n, customer=f"C{n % 7}", venue=f"V{n % 4}", day=n % 9 + 1, amount=3.0 + n) for n in range(30)])
    follow()
    facts_of_reviews.write.parquet(str(tmp_path / "reviews"))
    stream = spark.readStream.schema(facts_of_reviews.schema).parquet(str(tmp_path / "reviews"))
    copies = [(t["reviews_c"], "customer_id", customer_marts), (t["reviews_v"], "restaurant_id", venue_marts)]
    done(review_step_stream(stream, copies, str(tmp_path / "r"), buckets))
    before = {n: {r.customer_id: r for r in spark.table(t[n]).collect()} for n in ("c360",)}
    # Orders that move to another customer, are cancelled, or are new.
    late = "2024-03-01T00:00:00+00:00"
    run(message(3, customer="C8", venue="V0", made=late), message(10, customer="C3", venue="V2", made=late, status="cancelled"))
    files = {n: set(spark.table(t["c360"]).where(f"bucket = {n}").inputFiles()) for n in range(buckets)}
    follow()
    touched = {r[0] for r in spark.createDataFrame([("C3",), ("C8",)], "customer_id string").select(store_module.bucket_of("customer_id", buckets)).collect()}
    for n in range(buckets):
        assert (files[n] != set(spark.table(t["c360"]).where(f"bucket = {n}").inputFiles())) == (n in touched)
    run(message(40, customer="C1", venue="V3", day=20), message(41, customer="C11", venue="V1", day=21))
    follow()

    orders, written = silver.fact_orders(batch_build(spark, topic)), reviews.fact_review(raw)
    preference = marts.customer_restaurant_preference(orders, written, as_of)
    same(spark.table(t["pref"]).drop("bucket"), preference)
    same(spark.table(t["c360"]).drop("bucket"), marts.customer_360(customers, orders, written, preference, venues, as_of))
    same(spark.table(t["v360"]).drop("bucket"), marts.restaurant_360(venues, orders, written, as_of))
    assert before["c360"] and spark.table(t["c360"]).count() == 12
    some = store_module.in_buckets(spark.table(t["orders_c"]), "customer_id", buckets, [1])
    assert {f.split("bucket=")[1].split("/")[0] for f in some.inputFiles()} <= {"1"}


def test_an_empty_store_and_a_batch_of_rejects_only(spark, store, run):
    run("{bad")
    assert spark.table(store.rejects).count() == 1 and spark.table(store.orders).count() == 0
    run(message(1))
    assert [r.order_date for r in spark.table(store.orders).collect()] == [dt.date(2024, 1, 5)]
