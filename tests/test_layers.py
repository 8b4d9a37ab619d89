import datetime as dt

from checks import frames as fx
from ordermill.operators import quality, silver
from ordermill.plans import layers
from ordermill.sources import kafka, sinks


def test_all_layers_from_bronze_to_forecast(spark, sf_dir):
    sinks.create_namespaces(spark)
    first_months = "timestamp < '1995-03-01'"  # every day is a partition of three tables
    bronze = {
        "historical_orders_raw": fx.historical_orders_raw(spark, sf_dir).filter(first_months),
        "restaurant_orders_stream_bronze": kafka.bronze_orders(fx.stream_messages(spark, sf_dir)).filter(first_months),
        "customer_reviews_raw": fx.reviews_raw(spark, sf_dir).withColumn(
            "review_timestamp", fx.F.col("review_timestamp").cast("string")),
        "restaurants_raw": fx.venues_raw(spark, sf_dir),
        "customers_raw": fx.customers_raw(spark, sf_dir),
        "menu_items_raw": fx.menu_raw(spark, sf_dir),
    }
    good = bronze["historical_orders_raw"]
    spoiled = good.limit(1).withColumns({"order_id": fx.F.lit("spoiled"), "total_amount": fx.F.lit(-1.0)})
    bronze["historical_orders_raw"] = good.unionByName(spoiled)
    try:
        for name, df in bronze.items():
            sinks.overwrite_table(df, f"bronze.{name}")
        steps = layers.build_steps(fx.AS_OF)
        layers.build_all(spark, steps)
        for step in steps:
            assert not spark.table(step.table).isEmpty(), step.table
        assert spark.table("silver.fact_orders").count() == fx.fact_orders(spark, sf_dir).filter("order_date < '1995-03-01'").count()
        log = {(r.table_name, r.measure): r.value for r in spark.table(layers.BUILD_LOG).collect()}
        headers = silver.order_headers(spark.table("silver.orders_unified_silver"))
        counted = {r.rule: r.row_count for r in quality.violation_counts(headers, silver.header_rules()).collect()}
        assert log["silver.fact_orders", "rows_written"] == counted.pop("rows_kept")
        assert {m: v for (t, m), v in log.items() if t == "silver.fact_orders" and m != "rows_written"} == counted
        held = spark.table(layers.QUARANTINE).filter("table_name = 'silver.fact_orders'")
        assert held.count() == counted["rows_in"] - log["silver.fact_orders", "rows_written"] > 0
        shown = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES gold.customer_360").collect()}
        assert shown["quality"] == "gold"

        performance = spark.table("gold.daily_restaurant_performance")
        for day in (fx.EARLIER_RUN, fx.AS_OF, fx.AS_OF):
            layers.publish_forecasts(spark, performance, as_of=day)
        forecasts = spark.table("platinum.daily_revenue_forecast_by_restaurant")
        assert {r[0] for r in forecasts.select("model_run_date").distinct().collect()} == {dt.date.fromisoformat(fx.AS_OF)}
        log = spark.table("platinum.daily_revenue_forecast_diagnostics")
        assert log.select("model_run_date").distinct().count() == 2
        assert log.count() == log.select("restaurant_id", "model_run_date").distinct().count()
        assert "record_type" not in forecasts.columns + log.columns
    finally:
        for layer in sinks.LAYERS:
            spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def test_naive_times_of_the_build_are_local(spark):
    order = "'O', '2024-01-05T01:00:00', 'V', 'C', 'dine_in', '[]', 1.0D, 'card', 'ready', '2024-01-05T01:00:00+03:30'"
    raw = spark.sql(f"SELECT * FROM VALUES ({order})").toDF(*silver.ORDER_FIELDS)
    step = next(s for s in layers.build_steps(naive_tz="Asia/Tehran") if s.table == "silver.orders_unified_silver")
    row = step.build(lambda name: raw, None).selectExpr("CAST(timestamp AS string) AS at", "CAST(created_at AS string) AS made").first()
    assert (row.at, row.made) == ("2024-01-04 21:30:00", "2024-01-04 21:30:00")
