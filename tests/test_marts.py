import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks import frames as fx
from checks import queries as cq
from ordermill.operators import marts

ORDERS = (
    "order_id string, order_timestamp timestamp, order_date date, order_hour int, is_weekend boolean, restaurant_id string, "
    "customer_id string, order_type string, total_amount decimal(10,2), order_status string"
)
REVIEWS = (
    "review_id string, customer_id string, restaurant_id string, rating int, sentiment string, issue_delivery boolean, "
    "delivery_severity string, issue_food_quality boolean, food_quality_severity string, issue_pricing boolean, "
    "pricing_severity string, issue_portion_size boolean, portion_size_severity string, review_timestamp timestamp"
)
VENUES = "restaurant_id string, name string, city string, opening_date date"
AS_OF = "2024-03-31"


def order(n, venue="V1", customer="C1", day="2024-03-01", amount="100.00", kind="dine_in", status="completed"):
    at = dt.datetime.fromisoformat(day + "T12:00:00")
    return (f"O{n}", at, at.date(), 12, at.weekday() == 4, venue, customer, kind, Decimal(amount), status)


def review(n, venue="V1", customer="C1", rating=5, mood="positive", food="none", day="2024-03-02"):
    at = dt.datetime.fromisoformat(day + "T12:00:00")
    return (f"R{n}", customer, venue, rating, mood, False, "none", food != "none", food, False, "none", False, "none", at)


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS)


def reviews(spark, *rows):
    return spark.createDataFrame(list(rows), REVIEWS)


def venues(spark, *ids):
    return spark.createDataFrame([(i, f"Name {i}", "City", dt.date(2024, 1, 1)) for i in ids], VENUES)


def preference(spark, o, r=(), **options):
    rows = marts.customer_restaurant_preference(orders(spark, *o), reviews(spark, *r), AS_OF, **options).collect()
    return {(x.customer_id, x.restaurant_id): x for x in rows}


def test_one_order_is_kept_but_not_ranked(spark):
    row = preference(spark, [order(1)])["C1", "V1"]
    assert row.preference_status == "insufficient_data" and row.preference_rank is None
    assert row.order_share == 1.0 and row.days_since_last_order == 30
    assert row.rating_score == 0.5 and row.experience_score == 0.5 and row.avg_rating is None


def test_eligible_venue_beats_single_orders(spark):
    rows = preference(spark, [order(1), order(2), order(3, "V2", day="2024-03-30", amount="9999")])
    assert rows["C1", "V1"].preference_status == "preferred"
    assert rows["C1", "V2"].preference_status == "not_eligible"
    assert rows["C1", "V1"].eligible_restaurant_count == 1


def test_full_ties_go_to_the_smaller_id(spark):
    rows = preference(spark, [order(1, "V2"), order(2, "V2"), order(3, "V1"), order(4, "V1")])
    assert (rows["C1", "V1"].preference_rank, rows["C1", "V2"].preference_rank) == (1, 2)
    assert rows["C1", "V2"].preference_status == "candidate"


def test_trust_grows_with_the_number_of_reviews(spark):
    many = [review(i, "V2") for i in range(20)]
    rows = preference(spark, [order(1, "V1"), order(2, "V2")], [review(99, "V1"), *many])
    assert rows["C1", "V1"].rating_score == pytest.approx(0.25 * 1.0 + 0.75 * 0.5)
    assert rows["C1", "V2"].rating_score == pytest.approx(20 / 23 + 3 / 23 * 0.5)


def test_severity_none_counts_as_zero_in_the_preference(spark):
    rows = preference(spark, [order(1)], [review(1, food="none"), review(2, food="severe")])
    assert rows["C1", "V1"].avg_food_quality_severity == 1.5


def test_severity_averages_over_complaints_only_in_the_venue_profile(spark):
    rows = {
        r.restaurant_id: r
        for r in marts.restaurant_360(
            venues(spark, "V1", "V2", "V3"), orders(spark, order(1), order(2), order(3, "V2")),
            reviews(spark, review(1), review(2, food="severe"), review(3, "V2")), AS_OF,
        ).collect()
    }
    assert rows["V1"].avg_food_quality_severity == 3.0 and rows["V1"].food_quality_complaint_count == 1
    assert rows["V2"].avg_food_quality_severity is None and rows["V2"].quality_score == 0.5
    assert rows["V3"].total_orders == 0 and rows["V3"].avg_order_value is None and rows["V3"].rating_score == 0.5
    assert rows["V3"].avg_orders_per_customer is None and rows["V3"].delivery_order_ratio == 0.0
    assert rows["V1"].repeat_customer_rate == 1.0 and rows["V2"].repeat_customer_rate == 0.0


def test_customer_profile_keeps_everyone(spark):
    o, r = orders(spark, order(1), order(2), order(3, customer="C2", day="2024-01-30")), reviews(spark, review(1))
    customers = spark.createDataFrame([("C1",), ("C2",), ("C3",)], "customer_id string")
    pref = marts.customer_restaurant_preference(o, r, AS_OF)
    rows = {x.customer_id: x for x in marts.customer_360(
        customers, o, r, pref, venues(spark, "V1"), AS_OF, loyalty_floors={"Gold": 200, "Silver": 150}).collect()}
    assert rows["C1"].customer_preference_status == "has_preference" and rows["C1"].preferred_restaurant_name == "Name V1"
    assert rows["C1"].loyalty_segment == "Gold" and rows["C1"].customer_activity_status == "active"
    assert rows["C2"].loyalty_segment == "Bronze" and rows["C2"].customer_activity_status == "at_risk"
    assert rows["C2"].customer_preference_status == "insufficient_data"
    assert rows["C3"].loyalty_segment == "No Orders Yet" and rows["C3"].customer_activity_status == "no_orders_yet"
    assert rows["C3"].total_orders == 0 and rows["C3"].avg_order_value is None


def test_duplicate_ids_are_counted_once_when_the_grain_is_not_guaranteed(spark):
    o = orders(spark, order(1), order(1), order(2, kind="delivery"))
    r = reviews(spark, review(1), review(1))
    v = venues(spark, "V1")
    assert marts.customer_order_share(o, unique_ids=False).first().order_count == 2
    assert marts.restaurant_360(v, o, r, AS_OF, unique_ids=False).first().total_orders == 2
    assert marts.restaurant_reviews(r, v, unique_ids=False).first().total_reviews == 1
    day = marts.daily_restaurant_performance(o, r, v, AS_OF, unique_ids=False).filter("daily_orders > 0").first()
    assert (day.daily_orders, day.delivery_orders) == (2, 1)


def test_performance_has_every_day_once(spark):
    rows = marts.daily_restaurant_performance(
        orders(spark, order(1, day="2024-03-27"), order(2, day="2024-03-29"), order(3, "V2", day="2024-04-05")),
        reviews(spark, review(1, day="2024-03-28")), venues(spark, "V1", "V2"), AS_OF,
    ).orderBy("activity_date").collect()
    assert [r.activity_date.day for r in rows] == [27, 28, 29, 30, 31]
    assert {r.restaurant_id for r in rows} == {"V1"}  # V2 starts after the reference day
    assert [r.day_of_week for r in rows if r.is_weekend] == ["Friday"]
    assert rows[1].daily_orders == 0 and rows[1].daily_reviews == 1 and rows[1].avg_order_value is None
    assert rows[0].restaurant_age_days == 86


def test_daily_summary_counts_valid_orders_by_type(spark):
    row = marts.daily_sales_summary(
        orders(spark, order(1), order(2, kind="delivery", customer="C2"), order(3, status="pending"))
    ).first()
    assert (row.total_orders, row.dine_in_orders, row.delivery_orders, row.takeaway_orders) == (2, 1, 1, 0)
    assert float(row.total_revenue) == 200.0 and row.unique_restaurants == 1


def test_item_popularity_counts_orders_once_whatever_repeats(spark):
    """Repeated lines and headers, headers on two days, and keys that are null."""
    headers = [order(1), order(1), order(1, day="2024-03-02"), order(2), order(3, venue="V2"), order(4, status="pending")]
    headers += [(None, *order(5)[1:]), (*order(6)[:2], None, *order(6)[3:])]
    names = ["O1", "O1", "O1", "O2", "O2", "O3", "O4", None, "O6", "O6"]
    items = ["a", "a", "b", "a", None, "a", "a", "a", "b", "b"]
    lines = [(n, "V2" if n == "O3" else "V1", i, k, Decimal(k), None if k == 2 else Decimal(k)) for k, (n, i) in enumerate(zip(names, items))]
    lines = spark.createDataFrame(
        lines, "order_id string, restaurant_id string, item_id string, quantity int, subtotal decimal(10,2), unit_price decimal(10,2)")
    menu = spark.createDataFrame(
        [("V1", "a", "Stew", "Main", True), ("V1", "b", "Soup", "Main", True)],
        "restaurant_id string, item_id string, name string, category string, is_vegetarian boolean")
    joined = lines.join(marts.valid_orders(orders(spark, *headers)).select("order_id", "restaurant_id", "order_date"), ["order_id", "restaurant_id"])
    wanted = joined.join(menu, ["restaurant_id", "item_id"]).groupBy("order_date", "restaurant_id", "item_id").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("quantity").alias("total_quantity_sold"),
        F.sum("subtotal").alias("total_revenue"), F.round(F.avg("unit_price"), 2).cast("decimal(18,2)").alias("avg_unit_price"),
    )
    got = marts.daily_item_popularity(lines, orders(spark, *headers), menu).select(*wanted.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect())) and got.count() == 5


def test_sketches_merge_over_days(spark):
    days = [order(n, customer=f"C{n % 5000}", day=f"2024-03-{1 + n % 20:02d}") for n in range(10_000)]
    merged = marts.merged_customers(marts.daily_sales_summary(orders(spark, *days))).first()
    assert merged.unique_customers == pytest.approx(5000, rel=0.05)


def test_grain_of_the_marts(spark, sf_dir):
    grains = {
        "customer_restaurant_preference": ["customer_id", "restaurant_id"],
        "customer_360": ["customer_id"],
        "restaurant_360": ["restaurant_id"],
        "restaurant_reviews": ["restaurant_id"],
        "daily_item_popularity": ["order_date", "restaurant_id", "item_id"],
        "daily_restaurant_performance": ["restaurant_id", "activity_date"],
        "daily_sales_summary": ["order_date"],
    }
    for name, keys in grains.items():
        df = cq.QUERIES[name](spark, sf_dir)
        assert df.groupBy(*keys).count().filter("count > 1").isEmpty(), name


def test_scores_and_ranks_on_the_test_tables(spark, sf_dir):
    df = cq.preference(spark, sf_dir)
    scores = [c for c in df.columns if c.endswith("_score")]
    out = df.filter(" OR ".join(f"NOT {c} BETWEEN 0 AND 1" for c in scores))
    assert out.isEmpty()
    firsts = df.groupBy("customer_id").agg(
        F.count_if(F.col("preference_status") == "preferred").alias("n"),
        F.max("eligible_restaurant_count").alias("eligible"), F.sum("order_share").alias("share"),
    )
    assert firsts.filter("n <> least(eligible, 1)").isEmpty()
    assert firsts.filter("abs(share - 1) > 0.01").isEmpty()


def test_venue_orders_reconcile(spark, sf_dir):
    assert cq.QUERIES["dq_reconcile_orders"](spark, sf_dir).filter("difference <> 0").isEmpty()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.sampled_from("xyz"), st.integers(1, 28)), min_size=1, max_size=30))
def test_shares_and_ranks_hold_for_any_orders(spark, triples):
    rows = [order(i, v, c, f"2024-03-{d:02d}") for i, (v, c, d) in enumerate(triples)]
    by_customer = {}
    for (customer, _), row in preference(spark, rows).items():
        by_customer.setdefault(customer, []).append(row)
    for rows_ in by_customer.values():
        assert sum(r.order_count for r in rows_) == rows_[0].customer_total_orders
        ranks = sorted(r.preference_rank for r in rows_ if r.preference_rank)
        assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == rows_[0].eligible_restaurant_count


def test_a_hot_customer_and_venue_give_the_same_numbers(spark):
    """A third of all orders at one venue by one customer."""
    hot = [order(n, "HOT", "HOT", f"2024-03-{1 + n % 28:02d}") for n in range(3000)]
    rest = [order(10_000 + n, f"V{n % 50}", f"C{n % 700}", f"2024-03-{1 + n % 28:02d}") for n in range(6000)]
    o = orders(spark, *hot, *rest)
    pref = marts.customer_restaurant_preference(o, reviews(spark, review(1)), AS_OF)
    assert pref.filter("customer_id = 'HOT'").first().order_count == 3000
    assert pref.agg(F.sum("order_count")).first()[0] == 9000
    assert fx.AS_OF > "2000"
