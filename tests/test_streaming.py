import json

import pytest
from pyspark.sql import functions as F

from ordermill.operators import marts, silver
from ordermill.sources import batch, kafka, sinks
from ordermill.sources.partitions import in_partitions
from ordermill.streaming import flows
from ordermill.streaming.orders import days_touched


def payload(n, status="completed", day=5):
    at = f"2024-01-{day:02d}T10:00:00+00:00"
    items = [{"item_id": "a", "name": "Stew", "quantity": 2, "unit_price": 2.5, "subtotal": 5.0}]
    return json.dumps({
        "order_id": f"O{n}", "timestamp": at, "restaurant_id": "V1", "customer_id": f"C{n}", "order_type": "dine_in",
        "items": items, "total_amount": 5.0, "payment_method": "card", "order_status": status, "created_at": at,
    })


class Topic:
    """A folder of files in the message envelope, standing in for a topic."""

    def __init__(self, spark, path):
        self.spark, self.path, self.offset = spark, str(path), 0

    def send(self, *values):
        rows = [(bytearray(b"V1"), bytearray(v.encode()), None, 0, self.offset + i) for i, v in enumerate(values)]
        self.offset += len(rows)
        self.spark.createDataFrame(rows, kafka.ENVELOPE).coalesce(1).write.mode("append").parquet(self.path)

    def read(self, **options):
        return self.spark.readStream.schema(kafka.ENVELOPE).options(**options).parquet(self.path)


@pytest.fixture()
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def done(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_bronze_stream_equals_batch_and_restarts_without_duplicates(spark, topic, database, tmp_path):
    table, checkpoint = f"{database}.bronze", str(tmp_path / "c")
    topic.send(payload(1), "{bad", payload(2))
    done(flows.bronze_stream(topic.read(), table, checkpoint))
    done(flows.bronze_stream(topic.read(), table, checkpoint))
    topic.send(payload(3))
    done(flows.bronze_stream(topic.read(maxFilesPerTrigger=1), table, checkpoint))
    columns = ["kafka_key", "raw_json_payload", "order_id", "items", "total_amount", "offset"]
    streamed = spark.table(table).select(columns)
    batched = kafka.bronze_orders(spark.read.parquet(topic.path)).select(columns)
    assert streamed.count() == 4
    assert streamed.exceptAll(batched).isEmpty() and batched.exceptAll(streamed).isEmpty()


def test_facts_from_the_stream_equal_the_batch_facts(spark, topic, database, tmp_path):
    bronze = f"{database}.bronze"
    topic.send(payload(1), payload(2, "cancelled"), payload(3), payload(1))
    done(flows.bronze_stream(topic.read(), bronze, str(tmp_path / "c0")))

    unified_table = f"{database}.unified"
    done(flows.silver_order_stream(batch.read_stream_table(spark, bronze), unified_table, str(tmp_path / "s")))

    def silver_stream():
        return batch.read_stream_table(spark, unified_table)

    done(flows.fact_order_stream(silver_stream(), f"{database}.orders", str(tmp_path / "c1"), metrics="orders"))
    done(flows.fact_item_stream(silver_stream(), f"{database}.items", str(tmp_path / "c2")))
    unified = silver.unify_orders([("streaming_kafka", spark.table(bronze))])
    for name, expected in (("orders", silver.fact_orders(unified)), ("items", silver.fact_order_items(unified))):
        got = spark.table(f"{database}.{name}").select(*expected.columns)
        assert got.count() == expected.count() > 0
        assert got.exceptAll(expected).isEmpty(), name


def test_stream_dedup_spans_batches(spark, topic, database, tmp_path):
    table, checkpoint = f"{database}.silver", str(tmp_path / "c")

    def run():
        done(flows.silver_order_stream(kafka.bronze_orders(topic.read()), table, checkpoint))

    topic.send(payload(1), payload(1), payload(2))
    run()
    topic.send(payload(2), payload(3))
    run()
    assert sorted(r.order_id for r in spark.table(table).collect()) == ["O1", "O2", "O3"]


def test_late_orders_are_kept_and_late_copies_are_not(spark, topic, database, tmp_path):
    table, checkpoint = f"{database}.silver", str(tmp_path / "c")

    def run():
        done(flows.silver_order_stream(kafka.bronze_orders(topic.read()), table, checkpoint))

    topic.send(payload(1, day=10))
    run()
    topic.send(payload(2, day=3), payload(3, day=12))
    run()
    topic.send(payload(4, day=1), payload(2, day=3), payload(1, day=10))
    run()
    assert sorted(r.order_id for r in spark.table(table).collect()) == ["O1", "O2", "O3", "O4"]


def test_review_stream(spark, database, tmp_path):
    schema = (
        "review_id string, order_id string, customer_id string, restaurant_id string, review_text string, "
        "rating int, review_timestamp string"
    )
    path = str(tmp_path / "reviews")
    rows = [("R1", "O1", "C1", "V1", "stale bread", 2, "2024-01-01"), ("R2", "O2", "C1", "V1", "fine", -1, "2024-01-01")]
    spark.createDataFrame(rows, schema).write.parquet(path)
    stream = spark.readStream.schema(schema).parquet(path)
    done(flows.fact_review_stream(stream, f"{database}.reviews", str(tmp_path / "c")))
    row = spark.table(f"{database}.reviews").collect()
    assert [r.review_id for r in row] == ["R1"] and row[0].food_quality_severity == "moderate"


def test_gold_refresh_recomputes_the_touched_days(spark, topic, database, tmp_path):
    facts, gold = f"{database}.facts", f"{database}.gold"

    def ingest(*values):
        topic.send(*values)
        done(flows.silver_order_stream(kafka.bronze_orders(topic.read()), f"{database}.u", str(tmp_path / "c0")))
        done(flows.fact_order_stream(spark.readStream.table(f"{database}.u"), facts, str(tmp_path / "c1")))

    def refresh():
        stream = spark.readStream.table(facts)
        done(flows.refresh_daily(spark, stream, facts, gold, marts.daily_sales_summary, str(tmp_path / "c2")))

    ingest(payload(1, day=5), payload(2, day=6))
    refresh()
    ingest(payload(3, day=6), payload(4, day=7))
    refresh()
    refresh()
    days = {r.order_date.day: r.total_orders for r in spark.table(gold).collect()}
    assert days == {5: 1, 6: 2, 7: 1}
    whole = marts.daily_sales_summary(spark.table(facts)).select("order_date", "total_orders", "total_revenue")
    assert spark.table(gold).select(*whole.columns).exceptAll(whole).isEmpty()


def test_a_refresh_reads_only_the_touched_partitions(spark, database):
    rows = [(n, f"2024-01-{n % 28 + 1:02d}") for n in range(280)]
    facts = spark.createDataFrame(rows, "v int, order_date string")
    sinks.overwrite_table(facts, f"{database}.facts", partition_by=["order_date"])
    batch = spark.createDataFrame([(1, "2024-01-03"), (1, "2024-01-27"), (2, "2024-01-27")], "v int, order_date string")
    days = days_touched(batch, "order_date")
    touched = spark.table(f"{database}.facts").where(in_partitions(["order_date"], days))
    assert sorted(days) == [("2024-01-03",), ("2024-01-27",)] and touched.count() == 20
    assert {(f.split("order_date=")[1].split("/")[0],) for f in touched.inputFiles()} == set(days)


def test_item_popularity_from_a_stream_equals_the_batch(spark, topic, database, tmp_path):
    menu = spark.createDataFrame([("V1", "a", "Stew", "Main", True)], "restaurant_id string, item_id string, name string, category string, is_vegetarian boolean")
    menu.write.saveAsTable(f"{database}.menu")
    facts, items, gold = (f"{database}.{n}" for n in ("facts", "items", "gold"))

    def ingest(*values):
        topic.send(*values)
        done(flows.silver_order_stream(kafka.bronze_orders(topic.read()), f"{database}.u", str(tmp_path / "c0")))
        for stream, table, place in ((flows.fact_order_stream, facts, "c1"), (flows.fact_item_stream, items, "c2")):
            done(stream(spark.readStream.table(f"{database}.u"), table, str(tmp_path / place)))
        done(flows.refresh_daily(
            spark, spark.readStream.table(facts), [items, facts], gold, marts.daily_item_popularity, str(tmp_path / "c3"),
            dimensions=[f"{database}.menu"],
        ))

    ingest(payload(1, day=5), payload(2, day=6))
    ingest(payload(3, day=6), payload(4, day=9), payload(1, day=5))
    whole = marts.daily_item_popularity(spark.table(items), spark.table(facts), spark.table(f"{database}.menu"))
    got = spark.table(gold).select(*whole.columns)
    assert got.count() == whole.count() == 3 and got.exceptAll(whole).isEmpty()


def test_continuous_trigger_runs_until_stopped(spark, topic, database, tmp_path):
    topic.send(payload(1))
    query = flows.bronze_stream(topic.read(), f"{database}.bronze", str(tmp_path / "c"), every="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.table(f"{database}.bronze").agg(F.count("*")).first()[0] == 1
