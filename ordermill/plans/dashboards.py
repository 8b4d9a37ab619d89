"""Dashboard queries over the gold and forecast tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.calendar import DateLike, as_of_date, day_name, in_date_range
from ordermill.functions.numbers import choose, round_half_up
from ordermill.functions.text import strip_brand

MILLION = 1e6


def with_venue_name(df: DataFrame, venues: DataFrame) -> DataFrame:
    """Add the display name, falling back to the id."""
    names = venues.select("restaurant_id", F.col("name").alias("_name"))
    return df.join(names, "restaurant_id", "left").withColumn(
        "restaurant_name", F.coalesce("_name", "restaurant_id")
    ).drop("_name")


def forecast_feed(forecasts: DataFrame, venues: DataFrame) -> DataFrame:
    """One row per forecast day and venue, in millions; the dashboard adds them up."""
    millions = (F.col("predicted_revenue") / MILLION).alias("predicted_revenue_m")
    return with_venue_name(forecasts.select(millions, "restaurant_id"), venues)


def forecast_total(forecasts: DataFrame, venues: DataFrame) -> DataFrame:
    """Expected revenue per venue over the whole horizon, in millions."""
    totals = forecasts.groupBy("restaurant_id").agg((F.sum("predicted_revenue") / MILLION).alias("expected_total_m"))
    return with_venue_name(totals, venues)


def diagnostics_footer(latest: DataFrame, venues: DataFrame, model_name: str = "Weekly model") -> DataFrame:
    """One line of text on model health: about the venue if there is one, else about the chain.

    Takes the latest run per venue; the log of all runs would mix old and new verdicts.
    """
    # The wording of both lines.
    def text(c: Column) -> Column:
        return c.cast("string")

    entities = F.count(F.lit(1))

    def share(n: Column) -> list[Column]:
        return [text(n), F.lit("/"), text(entities), F.lit(" Branches")]

    def wape_text(c: Column) -> list[Column]:
        return [text(round_half_up(c, 1)), F.lit("%")]

    single = F.concat(
        F.lit("Branch: "), F.max("restaurant_name"),
        F.lit(" | Order: "), F.max("sarima_order"),
        F.lit(" | Holdout WAPE: "), *wape_text(F.max("holdout_mape_pct")),
        F.lit(" | Residuals: "), F.max("residuals_pass"),
        F.lit(" | Model used: "),
        F.when(F.max("status") == "OK", model_name).otherwise("Seasonal-median fallback"),
    )
    chain = F.concat(
        F.lit("Chain-Wide Status (as of "), text(F.max("model_run_date")), F.lit(") | Avg Holdout WAPE: "),
        *wape_text(F.avg("holdout_mape_pct")),
        F.lit(" | Passing Residual Diagnostics: "), *share(F.count_if(F.col("residuals_pass") == "PASS")),
        F.lit(" | On Fallback: "), *share(F.count_if(F.col("status") == "OK_FALLBACK_SEASONAL_MEDIAN")),
    )
    one = F.count_distinct("restaurant_id") == 1
    return with_venue_name(latest, venues).agg(F.when(one, single).otherwise(chain).alias("diagnostics_footer"))


def expected_peak(forecasts: DataFrame, venues: DataFrame) -> DataFrame:
    """Forecast days by expected revenue, highest first, with a display text in millions."""
    daily = forecasts.groupBy("forecast_date", "restaurant_id").agg(
        F.sum("predicted_revenue").alias("expected"), F.sum("upper_ci").alias("upper")
    )

    def millions(c: str) -> Column:
        return round_half_up(F.col(c) / MILLION, 1).cast("string")

    shown = F.concat(millions("expected"), F.lit("(Upper: "), millions("upper"), F.lit(")"))
    return (
        with_venue_name(daily, venues)
        .orderBy(F.desc("expected"), "forecast_date", "restaurant_id")
        .select(
            "forecast_date", day_name("forecast_date").alias("peak_day_name"),
            shown.alias("display_value"), "restaurant_id", "restaurant_name",
        )
    )


# Dashboard labels of the issue dimensions and their 360 columns.
ISSUE_LABELS = {
    "Food Quality": "food_quality",
    "Pricing": "pricing",
    "Portion Size": "portion",
    "Delivery": "delivery",
}


def issue_pivot(venue_360: DataFrame, venues: DataFrame, brand: str | None = None) -> DataFrame:
    """Complaints and severity per venue and issue, from one read of the venue table."""
    cells = F.array(
        *[
            F.struct(
                F.lit(label).alias("issue_dimension"),
                F.col(f"{c}_complaint_count").alias("complaint_count"),
                F.coalesce(f"avg_{c}_severity", F.lit(0.0)).alias("avg_severity"),
            )
            for label, c in ISSUE_LABELS.items()
        ]
    )
    name = F.col("restaurant_name")
    shown = F.trim(name) if brand is None else strip_brand(name, brand)
    named = with_venue_name(venue_360.drop("restaurant_name"), venues)
    return named.select(shown.alias("restaurant_name"), F.inline(cells))


def orders_line(
    summary: DataFrame, date_min: DateLike = None, date_max: DateLike = None
) -> DataFrame:
    """Orders and average order value per day within an optional date range."""
    totals = in_date_range(summary, "order_date", date_min, date_max).groupBy("order_date").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("total_revenue").alias("_revenue")
    )
    average = F.round(F.try_divide("_revenue", "total_orders"), 2).alias("avg_order_value")
    return totals.select("order_date", "total_orders", average).orderBy("order_date")


def actual_vs_forecast(
    performance: DataFrame, forecasts: DataFrame, venues: DataFrame, as_of: DateLike = None, days: int = 14
) -> DataFrame:
    """The last days of actual revenue followed by the forecast, in millions."""
    nothing = F.lit(None).cast("double")
    actual = performance.filter(F.col("activity_date") >= F.date_sub(as_of_date(as_of), days)).select(
        F.col("activity_date").alias("date"),
        (F.col("daily_revenue").cast("double") / MILLION).alias("amount"),
        F.lit("Actual").alias("metric_type"),
        nothing.alias("lower_ci"),
        nothing.alias("upper_ci"),
        "restaurant_id",
    )
    expected = forecasts.select(
        F.col("forecast_date").alias("date"),
        (F.col("predicted_revenue") / MILLION).alias("amount"),
        F.lit("Forecast").alias("metric_type"),
        (F.col("lower_ci") / MILLION).alias("lower_ci"),
        (F.col("upper_ci") / MILLION).alias("upper_ci"),
        "restaurant_id",
    )
    return with_venue_name(actual.unionByName(expected), venues).orderBy("date")


def _unpivot_counts(per_venue: DataFrame, venues: DataFrame, cells: list[Column]) -> DataFrame:
    """Counts of each venue as rows, from one read of the venue table."""
    rows = per_venue.select("restaurant_id", F.inline(F.array(*cells)))
    labels = [c for c in rows.columns if not c.endswith("_count")]
    counted = next(c for c in rows.columns if c.endswith("_count"))
    summed = rows.groupBy(*labels).agg(F.sum(counted).alias(counted))
    return with_venue_name(summed, venues).drop("restaurant_id")


def star_breakdown(per_venue: DataFrame, venues: DataFrame) -> DataFrame:
    cells = [
        F.struct(
            F.lit(f"{n} Star" + ("s" if n > 1 else "")).alias("rating_label"),
            F.lit(n).alias("star_rank"),
            F.col(f"rating_{n}_stars").alias("rating_count"),
        )
        for n in range(5, 0, -1)
    ]
    return _unpivot_counts(per_venue, venues, cells)


def sentiment_distribution(per_venue: DataFrame, venues: DataFrame) -> DataFrame:
    cells = [
        F.struct(
            F.lit(mood.capitalize()).alias("sentiment_category"),
            F.col(f"sentiment_{mood}_review").alias("review_count"),
        )
        for mood in ("positive", "neutral", "negative")
    ]
    return _unpivot_counts(per_venue, venues, cells)


def entity_health(venue_360: DataFrame, venues: DataFrame) -> DataFrame:
    """Venues by health score, best first."""
    named = with_venue_name(venue_360.drop("restaurant_name"), venues)
    return named.orderBy(F.desc("restaurant_health_score"), "restaurant_id").select(
        round_half_up("restaurant_health_score", 4).alias("restaurant_health_score"),
        round_half_up(F.col("repeat_customer_rate") * 100, 2).alias("repeat_customer_rate_pct"),
        "avg_order_value", "total_orders", "total_revenue", "restaurant_id", "restaurant_name",
    )


def category_revenue(
    popularity: DataFrame, date_min: DateLike = None, date_max: DateLike = None
) -> DataFrame:
    """Revenue per menu category, highest first; categories that sold nothing are left out."""
    category = F.coalesce("category", F.lit("Uncategorized")).alias("category")
    totals = in_date_range(popularity, "order_date", date_min, date_max).groupBy(category).agg(
        F.sum("total_revenue").alias("category_revenue")
    )
    return totals.filter(F.col("category_revenue") > 0).orderBy(F.desc("category_revenue"), "category")


def top_items(
    popularity: DataFrame, date_min: DateLike = None, date_max: DateLike = None, k: int = 10
) -> DataFrame:
    """The k items that sold most units; equal sales go by name."""
    units = F.sum("total_quantity_sold").alias("total_units_sold")
    totals = in_date_range(popularity, "order_date", date_min, date_max).groupBy("item_name").agg(units)
    return totals.orderBy(F.desc("total_units_sold"), "item_name").limit(k)


def live_kpis(
    summary: DataFrame, customers: DataFrame, date_min: DateLike = None, date_max: DateLike = None
) -> DataFrame:
    """Headline numbers as one row; distinct customers come from the daily sketches.

    The customer count joins the row as a scalar subquery, so Spark itself checks that it is one row.
    """
    orders = F.coalesce(F.sum("total_orders"), F.lit(0))
    revenue = F.coalesce(F.sum("total_revenue"), F.lit(0))
    estimate = F.hll_sketch_estimate(F.hll_union_agg("customer_hll_sketch"))
    sales = in_date_range(summary, "order_date", date_min, date_max).agg(
        orders.alias("total_orders"),
        revenue.alias("total_revenue"),
        F.coalesce(F.try_divide(F.sum("total_revenue"), F.sum("total_orders")), F.lit(0)).alias("avg_order_value"),
        F.coalesce(estimate, F.lit(0)).alias("unique_customers"),
    )
    active = in_date_range(customers, "last_order_date", date_min, date_max).agg(
        F.count_if(F.col("customer_activity_status") == "active").alias("active_customers")
    )
    return sales.select("*", active.scalar().alias("active_customers"))
