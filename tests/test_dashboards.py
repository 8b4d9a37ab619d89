import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import frames as fx
from checks import queries as cq
from ordermill.functions.text import strip_brand
from ordermill.plans import dashboards as db

VENUES = "restaurant_id string, name string"
DIAGNOSTICS = (
    "restaurant_id string, sarima_order string, holdout_mape_pct double, residuals_pass string, status string, "
    "model_run_date date"
)
DAY = dt.date(2024, 1, 1)


def diagnostics(spark, *rows):
    return spark.createDataFrame(list(rows), DIAGNOSTICS)


def footer(spark, *rows):
    venues = spark.createDataFrame([("V1", "Acme One")], VENUES)
    return db.diagnostics_footer(diagnostics(spark, *rows), venues).first()[0]


def test_footer_for_one_venue(spark):
    text = footer(spark, ("V1", "(1, 0, 1)", 12.345, "PASS", "OK", DAY))
    assert text == "Branch: Acme One | Order: (1, 0, 1) | Holdout WAPE: 12.3% | Residuals: PASS | Model used: Weekly model"
    text = footer(spark, ("V9", "(1, 0, 1)", 12.0, "FAIL", "OK_FALLBACK_SEASONAL_MEDIAN", DAY))
    assert text.startswith("Branch: V9") and text.endswith("Model used: Seasonal-median fallback")


def test_footer_for_several(spark):
    text = footer(
        spark, ("V1", "x", 10.0, "PASS", "OK", DAY), ("V2", "x", 20.0, "FAIL", "OK_FALLBACK_SEASONAL_MEDIAN", DAY))
    assert text == (
        "Chain-Wide Status (as of 2024-01-01) | Avg Holdout WAPE: 15.0% | Passing Residual Diagnostics: 1/2 Branches"
        " | On Fallback: 1/2 Branches"
    )


@pytest.mark.parametrize(
    "name, short",
    [("Acme Table - North", "North"), ("ACME  TABLE — North", "North"), ("acmetable North", "North"), ("North", "North"),
     ("Acme Table", ""), ("North Acme Table – South", "North South")],
)
def test_brand_is_stripped(spark, name, short):
    row = spark.range(1).select(strip_brand(F.lit(name), "Acme Table").alias("x")).first()
    assert row.x == short


@pytest.mark.parametrize(
    "first, last, days", [(None, None, 4), ("2024-01-02", None, 3), (None, "2024-01-02", 2), ("2024-01-02", "2024-01-03", 2),
                          ("2025-01-01", "2024-01-01", 0)],
)
def test_optional_date_range(spark, first, last, days):
    summary = spark.sql(
        "SELECT date_add(date'2024-01-01', cast(id as int)) AS order_date, id AS total_orders, "
        "cast(id * 3 as decimal(12,2)) AS total_revenue FROM range(4)"
    )
    rows = db.orders_line(summary, first, last).collect()
    assert len(rows) == days
    assert [r.order_date for r in rows] == sorted(r.order_date for r in rows)
    if first is None:
        assert rows[0].avg_order_value is None  # no orders that day


def popularity(spark):
    rows = [("a", "Bread", 5, 10.0), ("b", None, 7, 20.0), ("c", "Soup", 7, 0.0)]
    return spark.createDataFrame(rows, "item_name string, category string, total_quantity_sold long, total_revenue double"
                                 ).withColumn("order_date", F.lit(DAY))


def test_categories_and_top_items(spark):
    revenue = [tuple(r) for r in db.category_revenue(popularity(spark)).collect()]
    assert revenue == [("Uncategorized", 20.0), ("Bread", 10.0)]
    assert [r.item_name for r in db.top_items(popularity(spark), k=2).collect()] == ["b", "c"]


def test_kpis_are_zero_without_data(spark, sf_dir):
    summary = cq.marts.daily_sales_summary(fx.fact_orders(spark, sf_dir))
    customers = cq.customers_360(spark, sf_dir)
    row = db.live_kpis(summary, customers, "2030-01-01").first()
    assert (row.total_orders, row.unique_customers, row.active_customers) == (0, 0, 0)
    assert float(row.total_revenue) == 0.0 and float(row.avg_order_value) == 0.0
    assert db.live_kpis(summary, customers, "1990-01-01", "2030-01-01").first().total_orders > 0


def test_sorted_outputs(spark, sf_dir):
    health = [r.restaurant_health_score for r in db.entity_health(
        cq.venues_360(spark, sf_dir), cq.venues(spark, sf_dir)).collect()]
    assert health == sorted(health, reverse=True)
    feed = [r.date for r in cq.QUERIES["db_actual_vs_forecast"](spark, sf_dir).collect()]
    assert feed == sorted(feed)


def test_star_counts_add_up_to_the_reviews(spark, sf_dir):
    stars = cq.QUERIES["db_star_breakdown"](spark, sf_dir).agg(F.sum("rating_count")).first()[0]
    known = fx.fact_review(spark, sf_dir).filter("restaurant_id IS NOT NULL").count()
    assert stars == known
