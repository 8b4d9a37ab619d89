"""One query per operator: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import frames as fx
from ordermill.functions.calendar import days_between
from ordermill.functions.numbers import choose, round_half_up
from ordermill.functions.payload import ORDER_FIELDS, parse_items
from ordermill.functions.text import strip_brand
from ordermill.operators import autoregression
from ordermill.operators import forecast as fc
from ordermill.operators import marts, quality, reviews, silver
from ordermill.plans import dashboards as db
from ordermill.session import configure
from ordermill.sources import kafka

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name, with its columns in plain types."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(configure(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


def plain(df: DataFrame) -> DataFrame:
    """Types any engine prints alike: 64-bit numbers, and text for dates and times."""

    def cast(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[cast(f) for f in df.schema])


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: round_half_up(c, n) for c, n in digits.items()})


# --- sources, sinks, silver ---------------------------------------------------------------------


@fx.frame
def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.unify_orders(
        [
            ("historical_batch", fx.historical_orders_raw(spark, sf_dir)),
            ("streaming_kafka", fx.bronze_stream_orders(spark, sf_dir)),
        ]
    )


def line_list(items: Column) -> Column:
    """An order's lines as one text that does not depend on their order."""
    fields = ("item_id", "name", "quantity", "unit_price", "subtotal")
    lines = F.transform(parse_items(items), lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields]))
    return F.array_join(F.array_sort(lines), ",")


@query
def src_kafka_decode(spark, sf_dir):
    bronze = kafka.bronze_orders(fx.all_messages(spark, sf_dir))

    def raw(name: str) -> Column:
        return F.get_json_object("raw_json_payload", f"$.{name}")

    texts = [c for c in ORDER_FIELDS if c not in ("items", "total_amount")]
    return bronze.withColumns(
        {
            "items": line_list(F.col("items")),
            "raw_fields": F.concat_ws("|", *map(raw, texts)),
            "raw_amount": raw("total_amount").cast("double"),
            "raw_items": line_list(raw("items")),
        }
    ).drop("raw_json_payload", "ingested_at")


@query
def snk_kafka_payload(spark, sf_dir):
    orders = fx.fact_orders(spark, sf_dir)
    messages = kafka.to_messages(orders, "restaurant_id")
    return messages.select("key", F.from_json("value", orders.schema).alias("row")).select("key", "row.*")


@query
def orders_unified(spark, sf_dir):
    return unified(spark, sf_dir).withColumn("items", line_list(F.col("items")))


@query
def orders_dedup_survivor(spark, sf_dir):
    live_first = silver.unify_orders(
        [
            ("streaming_kafka", fx.bronze_stream_orders(spark, sf_dir)),
            ("historical_batch", fx.historical_orders_raw(spark, sf_dir)),
        ]
    )
    return live_first.select("order_id", "source_system", "order_status")


@query
def fact_orders(spark, sf_dir):
    return silver.fact_orders(unified(spark, sf_dir))


@query
def fact_orders_dq_counts(spark, sf_dir):
    return quality.violation_counts(silver.order_headers(unified(spark, sf_dir)), silver.header_rules())


@query
def fact_order_items(spark, sf_dir):
    return silver.fact_order_items(unified(spark, sf_dir))


@query
def dim_restaurant(spark, sf_dir):
    return silver.dim_restaurant(fx.venues_raw(spark, sf_dir))


@query
def dim_customer(spark, sf_dir):
    return silver.dim_customer(fx.customers_raw(spark, sf_dir))


@query
def dim_menu_item(spark, sf_dir):
    return silver.dim_menu_item(fx.whole_menu_raw(spark, sf_dir))


# --- reviews ------------------------------------------------------------------------------------


@query
def classify_review(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("review_text"))
    return reviews.enrich_reviews(docs).drop("review_text")


@query
def fact_review(spark, sf_dir):
    return reviews.fact_review(fx.reviews_raw(spark, sf_dir))


def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a model that at times is no JSON, knows unknown severities, or leaves out the mood."""
    doc = F.col("doc_id")
    mood = F.when(doc % 13 != 0, F.lit("neutral")).alias("sentiment")
    fields = [mood]
    for k, category in enumerate(quality.REVIEW_CATEGORIES):
        level = choose([(doc % (17 + k) == 0, F.lit("high")), (doc % 3 == 0, F.lit("minor"))], F.lit("none"))
        flag = choose([(doc % 5 == k, F.lit("maybe"))], F.lit("false"))
        fields += [level.alias(f"{category}_severity"), flag.alias(f"issue_{category}")]
    answer = F.to_json(F.struct(*fields))
    docs = fx.table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.col("n_chars") % 7 - 1).cast("int").alias("rating"),
        F.when(doc % 11 == 0, F.concat(F.lit("Sure! "), answer)).otherwise(answer).alias("analysis_json"),
    )
    return reviews.parse_analysis(docs)


@query
def fact_review_dq_counts(spark, sf_dir):
    return quality.violation_counts(model_answers(spark, sf_dir), quality.review_rules())


@query
def dq_review_contract(spark, sf_dir):
    return quality.violation_counts(fx.reviews_raw(spark, sf_dir), quality.review_contract_rules())


# --- data quality -------------------------------------------------------------------------------


@query
def dq_item_consistency(spark, sf_dir):
    return quality.violation_counts(fx.lines_flat(spark, sf_dir), quality.item_consistency_rules())


@query
def dq_order_total_consistency(spark, sf_dir):
    return quality.violation_counts(silver.with_items_total(unified(spark, sf_dir)), quality.order_contract_rules())


@query
def dq_reconcile_orders(spark, sf_dir):
    orders = fx.fact_orders(spark, sf_dir)
    return quality.reconcile(
        marts.valid_orders(orders), marts.venue_customers(orders), "restaurant_id",
        F.count("order_id"), F.sum("orders"),
    )


@query
def dq_quarantine_reasons(spark, sf_dir):
    rejected = quality.quarantine(silver.order_headers(unified(spark, sf_dir)), quality.order_rules())
    return rejected.select("order_id", F.array_join(F.array_sort("reasons"), ",").alias("reasons"))


@fx.frame
def unified_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh order has lost its id in both sources."""
    id_lost = F.substring("order_id", 2, 20).cast("bigint") % 7 == 0
    kept = F.when(~id_lost, F.col("order_id"))
    history, live = (f(spark, sf_dir).withColumn("order_id", kept) for f in (fx.historical_orders_raw, fx.bronze_stream_orders))
    return silver.unify_orders([("historical_batch", history), ("streaming_kafka", live)])


@query
def dq_counts_without_ids(spark, sf_dir):
    return quality.violation_counts(silver.order_headers(unified_with_gaps(spark, sf_dir)), silver.header_rules())


@query
def dq_reasons_without_ids(spark, sf_dir):
    rejected = quality.quarantine(silver.order_headers(unified_with_gaps(spark, sf_dir)), silver.header_rules())
    return rejected.select(
        "order_id", "customer_id", F.col("order_timestamp"), F.array_join(F.array_sort("reasons"), ",").alias("reasons")
    )


@query
def load_summary(spark, sf_dir):
    return quality.load_summary(
        fx.orders_flat(spark, sf_dir), quality.order_rules(), "order_timestamp", "total_amount"
    )


@query
def rating_distribution(spark, sf_dir):
    return quality.value_distribution(fx.fact_review(spark, sf_dir), "rating")


# --- gold ---------------------------------------------------------------------------------------


@fx.frame
def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_restaurant(fx.venues_raw(spark, sf_dir))


@fx.frame
def preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_restaurant_preference(
        fx.fact_orders(spark, sf_dir), fx.fact_review(spark, sf_dir), fx.AS_OF
    )


@fx.frame
def customers_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_360(
        silver.dim_customer(fx.customers_raw(spark, sf_dir)), fx.fact_orders(spark, sf_dir),
        fx.fact_review(spark, sf_dir), preference(spark, sf_dir), venues(spark, sf_dir),
        fx.AS_OF, loyalty_floors=fx.LOYALTY_FLOORS,
    )


@fx.frame
def venues_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.restaurant_360(
        venues(spark, sf_dir), fx.fact_orders(spark, sf_dir), fx.fact_review(spark, sf_dir), fx.AS_OF
    )


@fx.frame
def popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_item_popularity(
        fx.fact_order_items(spark, sf_dir), fx.fact_orders(spark, sf_dir),
        silver.dim_menu_item(fx.menu_raw(spark, sf_dir)),
    )


@fx.frame
def performance(spark: SparkSession, sf_dir: str, as_of: str = fx.AS_OF) -> DataFrame:
    return marts.daily_restaurant_performance(
        fx.fact_orders(spark, sf_dir), fx.fact_review(spark, sf_dir), venues(spark, sf_dir), as_of
    )


@query
def daily_sales_summary(spark, sf_dir):
    return marts.daily_sales_summary(fx.fact_orders(spark, sf_dir), sketch=False)


def sketch_error(orders: DataFrame, estimated: DataFrame, period: Column, name: str) -> DataFrame:
    """Exact customers per period, and whether the sketches come within 5 % of them."""
    exact = (
        marts.valid_orders(orders)
        .groupBy(period.alias(name))
        .agg(F.count_distinct("customer_id").alias("exact_customers"))
    )
    error = F.abs(F.col("unique_customers") - F.col("exact_customers"))
    within = (error <= 0.05 * F.col("exact_customers")).alias("within_5_pct")
    return exact.join(estimated, name).select(name, "exact_customers", within)


@query
def daily_sales_hll(spark, sf_dir):
    orders = fx.fact_orders(spark, sf_dir)
    estimated = marts.merged_customers(marts.daily_sales_summary(orders), "order_date")
    return sketch_error(orders, estimated, F.col("order_date"), "order_date")


@query
def hll_union_error(spark, sf_dir):
    orders = fx.fact_orders(spark, sf_dir)
    month = F.date_format("order_date", "yyyy-MM")
    estimated = marts.merged_customers(marts.daily_sales_summary(orders).withColumn("month", month), "month")
    return sketch_error(orders, estimated, month, "month")


@query
def restaurant_reviews(spark, sf_dir):
    return marts.restaurant_reviews(fx.fact_review(spark, sf_dir), venues(spark, sf_dir))


@query
def customer_order_share(spark, sf_dir):
    return marts.customer_order_share(fx.fact_orders(spark, sf_dir))


@query
def customer_restaurant_preference(spark, sf_dir):
    scores = ["recency_score", "rating_score", "sentiment_score", "food_quality_score", "pricing_score", "portion_score"]
    return rounded(preference(spark, sf_dir), **dict.fromkeys(scores, 6))


@query
def preferred_restaurant(spark, sf_dir):
    return marts.preferred_restaurant(preference(spark, sf_dir), venues(spark, sf_dir))


@query
def customer_360(spark, sf_dir):
    return customers_360(spark, sf_dir)


@query
def repeat_customer_stats(spark, sf_dir):
    return marts.repeat_customer_stats(fx.fact_orders(spark, sf_dir))


@query
def restaurant_360(spark, sf_dir):
    return rounded(venues_360(spark, sf_dir), rating_score=6, quality_score=6)


@query
def daily_item_popularity(spark, sf_dir):
    return popularity(spark, sf_dir)


@query
def daily_restaurant_performance(spark, sf_dir):
    return performance(spark, sf_dir)


# --- forecasting --------------------------------------------------------------------------------


@fx.frame
def sales_by_day(spark: SparkSession, sf_dir: str, as_of: str = fx.AS_OF) -> DataFrame:
    """Forecast input: days with sales only, so that the series builder has gaps to fill."""
    return (
        marts.valid_orders(fx.fact_orders(spark, sf_dir))
        .filter(F.col("order_date") <= F.lit(as_of).cast("date"))
        .select("restaurant_id", F.col("order_date").alias("activity_date"), F.col("total_amount").alias("daily_revenue"))
    )


@fx.frame
def profile(spark: SparkSession, sf_dir: str, as_of: str = fx.AS_OF) -> DataFrame:
    return fc.series_profile(fc.regular_series(sales_by_day(spark, sf_dir, as_of)))


@fx.frame
def forecasts(spark: SparkSession, sf_dir: str, as_of: str = fx.AS_OF) -> DataFrame:
    return fc.forecast(sales_by_day(spark, sf_dir, as_of), as_of=as_of)


def diagnostics(spark: SparkSession, sf_dir: str, as_of: str = fx.AS_OF) -> DataFrame:
    return rounded(fc.diagnostics_rows(forecasts(spark, sf_dir, as_of)), **DIAGNOSTIC_DIGITS)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = [fc.diagnostics_rows(forecasts(spark, sf_dir, day)) for day in (fx.EARLIER_RUN, fx.AS_OF)]
    return runs[0].unionByName(runs[1])


def median_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fc.median_forecast(profile(spark, sf_dir))


DIAGNOSTIC_DIGITS = {"aic": 4, "aicc": 4, "ljung_box_pvalue": 6, "holdout_mape_pct": 4, "naive_wape_pct": 4, "skill_vs_naive_pct": 4}


@query
def daily_series_regular(spark, sf_dir):
    return fc.regular_series(sales_by_day(spark, sf_dir))


@query
def forecast_history_gate(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("restaurant_id"), F.to_date("ts").alias("activity_date"),
        F.col("value").alias("daily_revenue"),
    )
    short = fc.series_profile(fc.regular_series(events))
    return fc.history_gate(profile(spark, sf_dir).unionByName(short))


@query
def forecast_capacity_cap(spark, sf_dir):
    caps = profile(spark, sf_dir).select("restaurant_id", "n_obs_used", "last_date", "capacity_cap")
    return rounded(caps, capacity_cap=6)


@query
def forecast_naive(spark, sf_dir):
    return fc.naive_forecast(profile(spark, sf_dir))


@query
def forecast_naive_wape(spark, sf_dir):
    rows = fc.naive_forecast(profile(spark, sf_dir))
    errors = rows.groupBy("restaurant_id").agg(
        (F.try_divide(F.sum(F.abs(F.col("naive") - F.col("actual"))), F.sum("actual")) * 100).alias("naive_wape_pct")
    )
    return rounded(errors, naive_wape_pct=4)


@query
def forecast_skill(spark, sf_dir):
    return diagnostics(spark, sf_dir).select("restaurant_id", "holdout_mape_pct", "naive_wape_pct", "skill_vs_naive_pct")


@query
def ljung_box(spark, sf_dir):
    return diagnostics(spark, sf_dir).select("restaurant_id", "ljung_box_pvalue", "residuals_pass")


@query
def forecast_median_fallback(spark, sf_dir):
    return rounded(median_forecasts(spark, sf_dir), predicted_revenue=6, lower_ci=6, upper_ci=6)


@query
def forecast_fallback_decision(spark, sf_dir):
    return diagnostics(spark, sf_dir).select("restaurant_id", "residuals_pass", "status")


@query
def forecast_rows(spark, sf_dir):
    rows = fc.forecast_rows(forecasts(spark, sf_dir))
    return rounded(rows, predicted_revenue=4, lower_ci=4, upper_ci=4)


@query
def forecast_diagnostics(spark, sf_dir):
    return diagnostics(spark, sf_dir)


@query
def forecast_diagnostics_latest(spark, sf_dir):
    return rounded(fc.latest_diagnostics(run_log(spark, sf_dir)), **DIAGNOSTIC_DIGITS)


def order_choices(spark: SparkSession, sf_dir: str, most: int) -> DataFrame:
    chosen = autoregression.order_choice(profile(spark, sf_dir), most=most)
    return rounded(chosen, dickey_fuller=6, aicc=4)


@query
def forecast_difference_test(spark, sf_dir):
    return order_choices(spark, sf_dir, 3).select("restaurant_id", "dickey_fuller", "differenced")


@query
def forecast_ar_order(spark, sf_dir):
    chosen = order_choices(spark, sf_dir, 3)
    phi = [round_half_up(F.get("phi", F.lit(k)), 6).alias(f"phi_{k + 1}") for k in range(3)]
    return chosen.select("restaurant_id", "differenced", "ar_order", "aicc", *phi)


# --- dashboards ---------------------------------------------------------------------------------


@query
def db_forecast_total(spark, sf_dir):
    totals = db.forecast_total(median_forecasts(spark, sf_dir), venues(spark, sf_dir))
    return rounded(totals, expected_total_m=4)


@query
def db_forecast_feed(spark, sf_dir):
    return rounded(db.forecast_feed(median_forecasts(spark, sf_dir), venues(spark, sf_dir)), predicted_revenue_m=4)


@query
def db_diagnostics_footer(spark, sf_dir):
    return db.diagnostics_footer(fc.latest_diagnostics(run_log(spark, sf_dir)), venues(spark, sf_dir))


@query
def db_expected_peak(spark, sf_dir):
    return db.expected_peak(median_forecasts(spark, sf_dir), venues(spark, sf_dir))


@query
def db_issue_pivot(spark, sf_dir):
    return db.issue_pivot(venues_360(spark, sf_dir), venues(spark, sf_dir), fx.BRAND)


@query
def db_orders_line(spark, sf_dir):
    summary = marts.daily_sales_summary(fx.fact_orders(spark, sf_dir))
    return db.orders_line(summary, "1997-01-01", "1999-12-31")


@query
def db_actual_vs_forecast(spark, sf_dir):
    feed = db.actual_vs_forecast(
        performance(spark, sf_dir), median_forecasts(spark, sf_dir), venues(spark, sf_dir), fx.AS_OF
    )
    return rounded(feed, amount=4, lower_ci=4, upper_ci=4)


@query
def db_star_breakdown(spark, sf_dir):
    per_venue = marts.restaurant_reviews(fx.fact_review(spark, sf_dir), venues(spark, sf_dir))
    return db.star_breakdown(per_venue, venues(spark, sf_dir))


@query
def db_entity_health(spark, sf_dir):
    return db.entity_health(venues_360(spark, sf_dir), venues(spark, sf_dir))


@query
def db_category_revenue(spark, sf_dir):
    return db.category_revenue(popularity(spark, sf_dir), date_min="1996-01-01")


@query
def db_sentiment_distribution(spark, sf_dir):
    per_venue = marts.restaurant_reviews(fx.fact_review(spark, sf_dir), venues(spark, sf_dir))
    return db.sentiment_distribution(per_venue, venues(spark, sf_dir))


@query
def db_top_items(spark, sf_dir):
    return db.top_items(popularity(spark, sf_dir), date_max="2000-12-31")


@query
def db_live_kpis(spark, sf_dir):
    orders = fx.fact_orders(spark, sf_dir)
    kpis = db.live_kpis(marts.daily_sales_summary(orders), customers_360(spark, sf_dir))
    exact = marts.valid_orders(orders).agg(F.count_distinct("customer_id").alias("exact_customers")).scalar()
    error = F.abs(F.col("unique_customers") - F.col("exact_customers"))
    return rounded(
        kpis.withColumn("exact_customers", exact)
        .withColumn("customers_within_5_pct", error <= 0.05 * F.col("exact_customers"))
        .drop("unique_customers"),
        avg_order_value=2,
    )


# --- functions ----------------------------------------------------------------------------------


@query
def fn_brand_strip(spark, sf_dir):
    named = venues(spark, sf_dir).select("restaurant_id", "name")
    return named.withColumn("short_name", strip_brand(F.col("name"), fx.BRAND))


@query
def fn_calendar_features(spark, sf_dir):
    features = fc.calendar_features(fc.regular_series(sales_by_day(spark, sf_dir)))
    return rounded(features.drop("daily_revenue"), log_value=6)


@query
def fn_date_scaffold(spark, sf_dir):
    opened = venues(spark, sf_dir).select("restaurant_id", "opening_date")
    return days_between(opened, "opening_date", F.lit("1996-01-31").cast("date"), "day").select("restaurant_id", "day")


@query
def fn_json_items(spark, sf_dir):
    payloads = fx.order_payloads(spark, sf_dir)
    items = parse_items(F.col("items"))
    units = F.aggregate(items, F.lit(0), lambda acc, x: acc + x["quantity"])
    return payloads.select("order_id", F.size(items).alias("item_count"), units.alias("units"))
