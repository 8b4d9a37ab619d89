import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ordermill.operators import quality as q

HEADER = (
    "order_id string, order_timestamp timestamp, customer_id string, restaurant_id string, item_count int, "
    "total_amount decimal(10,2), order_status string, payment_method string"
)


def headers(spark):
    """One good row, then one row per way to fail."""
    good = "'{}', timestamp'2024-01-05 10:00:00', 'C', 'V', 2, 10.00, 'completed', 'card'"
    spoiled = [
        good.format("ok"),
        good.format("x").replace("'x'", "NULL"),
        good.format("no_time").replace("timestamp'2024-01-05 10:00:00'", "NULL"),
        good.format("status").replace("completed", "cancelled"),
        good.format("payment").replace("card", "crypto"),
        good.format("zero").replace("10.00", "0.00"),
        good.format("negative").replace("10.00", "-1.00"),
        good.format("empty").replace("2,", "0,"),
        good.format("no_items").replace("2,", "NULL,"),
    ]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"({row})" for row in spoiled)).toDF(
        *[c.split()[0] for c in HEADER.split(", ")]
    )


def test_only_the_good_row_is_kept_and_every_rule_is_counted(spark):
    seen = Observation("headers")
    kept = q.apply_expectations(headers(spark), q.order_rules(), seen)
    assert [r.order_id for r in kept.collect()] == ["ok"]
    assert seen.get["rows_in"] == 9
    assert seen.get["valid_order_id"] == 1
    assert seen.get["valid_total_amount"] == 2
    assert seen.get["valid_item_count"] == 2
    assert seen.get["valid_customer_id"] == 0


def test_violation_counts_agree_with_the_observed_ones(spark):
    counts = {r.rule: r.row_count for r in q.violation_counts(headers(spark), q.order_rules()).collect()}
    assert counts["rows_in"] == 9 and counts["rows_kept"] == 1
    assert counts["valid_order_status"] == 1 and counts["valid_payment_method"] == 1


def test_kept_and_quarantined_rows_make_up_the_input(spark):
    df, rules = headers(spark), q.order_rules()
    rejected = q.quarantine(df, rules).collect()
    assert len(rejected) + q.apply_expectations(df, rules).count() == df.count()
    reasons = {r.order_id: r.reasons for r in rejected}
    assert reasons["status"] == ["valid_order_status"]
    assert reasons["no_items"] == ["valid_item_count"]


@pytest.mark.parametrize(
    "quantity, price, subtotal, kept",
    [(0, 1, 1, False), (20, 1, 20, True), (21, 1, 21, False), (2, 5, 10.05, True), (2, 5, 10.06, False), (1, 0, 1, False)],
)
def test_item_consistency(spark, quantity, price, subtotal, kept):
    row = spark.sql(
        f"SELECT 'x' AS item_id, {quantity} AS quantity, CAST({price} AS decimal(10,2)) AS unit_price, "
        f"CAST({subtotal} AS decimal(10,2)) AS subtotal"
    )
    assert q.apply_expectations(row, q.item_consistency_rules()).count() == int(kept)


def test_reconcile_keeps_keys_of_either_side(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 3), ("c", 5)], "k string, v int")
    rows = {r.k: r.difference for r in q.reconcile(left, right, "k", F.sum("v"), F.sum("v")).collect()}
    assert rows == {"a": 0, "b": 3, "c": -5}


def test_load_summary_looks_at_kept_rows_only(spark):
    row = q.load_summary(headers(spark), q.order_rules(), "order_timestamp", "total_amount").first()
    assert (row.rows_kept, row.rows_rejected, float(row.total_amount)) == (1, 8, 10.0)
