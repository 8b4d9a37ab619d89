import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill.functions.payload import ORDER_FIELDS, count_items, parse_items
from ordermill.operators import quality, silver

RAW = ", ".join(f"{c} {'double' if c == 'total_amount' else 'string'}" for c in ORDER_FIELDS)


def order(order_id="O1", timestamp="2024-01-05T10:00:00", items='[{"item_id":"a","quantity":1,"unit_price":5,"subtotal":5}]',
          total=5.0, status="completed", created="2024-01-05T10:00:00"):
    return (order_id, timestamp, "V1", "C1", "dine_in", items, total, "card", status, created)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


@pytest.mark.parametrize(
    "items, count",
    [(None, None), ("[]", 0), ("nope", None), ('[{"item_id":"x","quantity":"two"}]', 1), ('[{"item_id":"x"},{}]', 2)],
)
def test_item_count_from_one_field_equals_the_full_parse(spark, items, count):
    row = spark.createDataFrame([(items,)], "items string").select(
        count_items(F.col("items")).alias("narrow"), F.size(parse_items(F.col("items"))).alias("full")
    ).first()
    assert row.narrow == row.full == count


def test_survivor_is_the_preferred_source_then_the_newest(spark):
    hist = frame(spark, order("A", created="2024-01-05T10:00:00", status="delivered"),
                 order("A", created="2024-01-06T10:00:00", status="completed"))
    live = frame(spark, order("A", created="2024-02-01T00:00:00+00:00", status="pending"),
                 order("B", created=None, status="ready"), order("B", created="2024-01-01T00:00:00Z", status="confirmed"))
    rows = {r.order_id: r for r in silver.unify_orders([("h", hist), ("s", live)]).collect()}
    assert (rows["A"].order_status, rows["A"].source_system) == ("completed", "h")
    assert rows["B"].order_status == "confirmed"
    swapped = {r.order_id: r for r in silver.unify_orders([("s", live), ("h", hist)]).collect()}
    assert swapped["A"].order_status == "pending"


def test_dedup_is_idempotent_and_ignores_row_order(spark):
    rows = [order("A", status=s) for s in ("pending", "ready", "completed")] + [order("B")]
    once = silver.unify_orders([("h", frame(spark, *rows))])
    again = silver.unify_orders([("h", frame(spark, *rows[::-1]))])
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_zoned_and_naive_timestamps(spark):
    df = frame(spark, order("zoned", "2024-01-05T10:00:00+03:30"), order("naive", "2024-01-05T10:00:00"),
               order("short", "2024-01-05T10:00:00+03"), order("day", "2024-01-05"), order("bad", "yesterday"))
    at = {r.order_id: r.timestamp for r in silver.conform_orders(df, "h", "Asia/Tehran").select(
        "order_id", F.date_format("timestamp", "HH:mm").alias("timestamp")).collect()}
    assert at == {"zoned": "06:30", "naive": "06:30", "short": "07:00", "day": "20:30", "bad": None}


def test_real_timestamps_are_left_alone(spark):
    df = frame(spark, order()).withColumn("timestamp", F.to_timestamp("timestamp"))
    row = silver.conform_orders(df, "h", "Asia/Tehran").select(F.hour("timestamp"), F.hour("created_at")).first()
    assert tuple(row) == (10, 6)


def test_fact_orders_columns_and_drops(spark):
    df = silver.unify_orders([("h", frame(
        spark, order("ok"), order(None), order("bad_time", "x"), order("large", total=1e12), order("huge", total=1e17), order("no_items", items="nope")))])
    facts = silver.fact_orders(df)
    row = facts.collect()
    assert [r.order_id for r in sorted(row, key=lambda r: r.total_amount)] == ["ok", "large"]
    row = [r for r in row if r.order_id == "ok"]
    failed = {r.order_id: r.reasons for r in quality.quarantine(silver.order_headers(df), silver.header_rules()).collect()}
    assert failed["huge"] == ["valid_total_amount", "readable_total_amount"]
    assert row[0].order_date == dt.date(2024, 1, 5) and row[0].order_hour == 10
    assert row[0].day_of_week == "Friday" and row[0].is_weekend is True
    assert silver.order_headers(df, weekend_days=("Saturday",)).filter("is_weekend").count() == 0


def test_fact_order_items_drops_bad_lines_only(spark):
    items = '[{"item_id":"a","name":"n","quantity":2,"unit_price":2.5,"subtotal":5},{"item_id":"b","quantity":"two"},{"quantity":1}]'
    lines = silver.fact_order_items(silver.unify_orders([("h", frame(spark, order(items=items), order("O2", items=None)))]))
    row = lines.collect()
    assert len(row) == 1
    assert (row[0].item_id, row[0].item_name, row[0].quantity, float(row[0].unit_price)) == ("a", "n", 2, 2.5)


def test_items_total(spark):
    items = '[{"item_id":"a","subtotal":5.25},{"item_id":"b","subtotal":1}]'
    row = silver.with_items_total(silver.conform_orders(frame(spark, order(items=items)), "h")).first()
    assert float(row.items_total) == 6.25 and row.item_count == 2


def test_dimensions_drop_rows_without_key_or_date(spark):
    raw = spark.createDataFrame(
        [("C1", "n", "e", "p", "c", "2024-01-01"), (None, "n", "e", "p", "c", "2024-01-01"), ("C2", "n", "e", "p", "c", "soon")],
        "customer_id string, name string, email string, phone string, city string, join_date string",
    )
    assert silver.dim_customer(raw).collect() == [("C1", "n", "p", "c", dt.date(2024, 1, 1))]
    menu = spark.createDataFrame(
        [("V", "i", "n", "Bread", 10, "a, b", "True", "None"), ("V", None, "n", "Bread", 10, "a", "maybe", "Mild")],
        "restaurant_id string, item_id string, name string, category string, price int, ingredients string, "
        "is_vegetarian string, spice_level string",
    )
    rows = silver.dim_menu_item(menu).collect()
    assert len(rows) == 1 and rows[0].is_vegetarian is True and rows[0].spice_level == "None"
