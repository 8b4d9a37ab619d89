"""Gold marts over order headers, order lines, reviews and dimensions.

Ids are counted distinctly. Pass `unique_ids=True` for facts with one row per id, as the batch builders
make them: a plain count then does, and no row is copied for it. Every grouping combines on the map side, so a venue or customer with a large
part of all rows reaches the reducers as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.calendar import DateLike, as_of_date, day_name, days_between, is_day
from ordermill.functions.numbers import (
    choose,
    confidence,
    count_ids,
    mean_money,
    rate,
    recency,
    round_half_up,
    severity_points,
    shrink,
    tier,
    unit_rating,
    unit_severity,
    weighted,
)
from ordermill.operators.quality import ORDER_TYPES, REVIEW_CATEGORIES, SUCCESS_STATUSES

# Score weights, tier floors and activity windows.
EXPERIENCE_WEIGHTS = {
    "rating_score": 0.50,
    "sentiment_score": 0.20,
    "food_quality_score": 0.15,
    "pricing_score": 0.10,
    "portion_score": 0.05,
}
PREFERENCE_WEIGHTS = {"order_share": 0.40, "recency_score": 0.20, "experience_score": 0.40}
HEALTH_WEIGHTS = {
    "rating_score": 0.35,
    "repeat_customer_rate": 0.25,
    "positive_ratio": 0.20,
    "quality_score": 0.20,
}
LOYALTY_FLOORS = {"Platinum": 5_000_000, "Gold": 2_000_000, "Silver": 1_000_000}
ACTIVE_DAYS, AT_RISK_DAYS = 30, 90

# Output columns say "portion" where the review fields say "portion_size".
SHORT_NAME = {c: "portion" if c == "portion_size" else c for c in REVIEW_CATEGORIES}


def valid_orders(orders: DataFrame, ok_statuses: Sequence[str] = SUCCESS_STATUSES) -> DataFrame:
    return orders.filter(F.col("order_status").isin(list(ok_statuses)))


def _is(sentiment: str) -> Column:
    return F.col("sentiment") == sentiment


def daily_sales_summary(
    orders: DataFrame,
    ok_statuses: Sequence[str] = SUCCESS_STATUSES,
    sketch: bool = True,
    revenue_type: str = "decimal(20,2)",
) -> DataFrame:
    """Orders, revenue, venues and order types per day, with a mergeable customer sketch.

    A cast that overflows stops the job, so the revenue type leaves room for a day of any size.
    """
    kinds = [f"{kind}_orders" for kind in ORDER_TYPES]
    good = valid_orders(orders, ok_statuses)
    per_venue = good.groupBy("order_date", "restaurant_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_revenue"),
        *[F.count(F.when(F.col("order_type") == kind, F.col("order_id"))).alias(f"{kind}_orders") for kind in ORDER_TYPES],
    )
    days = per_venue.groupBy("order_date").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue").cast(revenue_type).alias("total_revenue"),
        # One row per venue here, so a plain count of the known ones is the distinct count.
        F.count("restaurant_id").alias("unique_restaurants"),
        *[F.sum(kind).alias(kind) for kind in kinds],
    )
    if not sketch:
        return days
    # Apart from the venues: a sketch per day and task moves, none per venue.
    sketches = good.groupBy("order_date").agg(F.hll_sketch_agg("customer_id").alias("customer_hll_sketch"))
    joined = days.join(sketches.withColumnRenamed("order_date", "_day"), F.col("order_date").eqNullSafe(F.col("_day")))
    return joined.select("order_date", "total_orders", "total_revenue", "customer_hll_sketch", "unique_restaurants", *kinds)


def merged_customers(summary: DataFrame, *keys: str) -> DataFrame:
    """Customers over several days from the daily sketches, without reading any order again."""
    estimate = F.hll_sketch_estimate(F.hll_union_agg("customer_hll_sketch"))
    return summary.groupBy(*keys).agg(F.coalesce(estimate, F.lit(0)).alias("unique_customers"))


def restaurant_reviews(reviews: DataFrame, venues: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Review count, mean, star counts and sentiment counts per venue; every venue is kept."""
    per_venue = reviews.groupBy("restaurant_id").agg(
        count_ids(F.col("review_id"), unique_ids).alias("total_reviews"),
        round_half_up(F.avg("rating"), 2).alias("avg_rating"),
        *[F.count_if(F.col("rating") == n).alias(f"rating_{n}_stars") for n in range(5, 0, -1)],
        *[
            F.count_if(_is(mood)).alias(f"sentiment_{mood}_review")
            for mood in ("positive", "negative", "neutral")
        ],
    )
    measures = [c for c in per_venue.columns if c != "restaurant_id"]
    return venues.select("restaurant_id", "city").join(per_venue, "restaurant_id", "left").fillna(0, measures)


def with_customer_share(pairs: DataFrame) -> DataFrame:
    """Add the customer's order total over all venues and this venue's share of it.

    The input has one row per customer and venue, so a window holds at most one row per venue.
    """
    total = F.sum("order_count").over(Window.partitionBy("customer_id"))
    return pairs.withColumn("customer_total_orders", total).withColumn(
        "order_share", round_half_up(F.col("order_count") / F.col("customer_total_orders"), 4)
    )


def customer_venue_orders(
    orders: DataFrame, ok_statuses: Sequence[str] = SUCCESS_STATUSES, unique_ids: bool = False
) -> DataFrame:
    """Order totals per customer and venue."""
    return (
        valid_orders(orders, ok_statuses)
        .groupBy("customer_id", "restaurant_id")
        .agg(
            count_ids(F.col("order_id"), unique_ids).alias("order_count"),
            F.sum("total_amount").alias("total_spend"),
            F.min("order_timestamp").alias("first_order_timestamp"),
            F.max("order_timestamp").alias("last_order_timestamp"),
        )
    )


def customer_order_share(
    orders: DataFrame, ok_statuses: Sequence[str] = SUCCESS_STATUSES, unique_ids: bool = False
) -> DataFrame:
    """Order profile of each customer at each venue."""
    return with_customer_share(customer_venue_orders(orders, ok_statuses, unique_ids))


def _pair_reviews(reviews: DataFrame, unique_ids: bool) -> DataFrame:
    return reviews.groupBy("customer_id", "restaurant_id").agg(
        count_ids(F.col("review_id"), unique_ids).alias("review_count"),
        round_half_up(F.avg("rating"), 2).alias("avg_rating"),
        rate(_is("positive")).alias("positive_ratio"),
        rate(_is("negative")).alias("negative_ratio"),
        *[
            round_half_up(F.avg(severity_points(f"{c}_severity", 0.0)), 4).alias(f"avg_{SHORT_NAME[c]}_severity")
            for c in ("food_quality", "pricing", "portion_size", "delivery")
        ],
    )


def customer_restaurant_preference(
    orders: DataFrame,
    reviews: DataFrame,
    as_of: DateLike | Column = None,
    ok_statuses: Sequence[str] = SUCCESS_STATUSES,
    min_orders: int = 2,
    decay_days: float = 90.0,
    smoothing: float = 3.0,
    experience_weights: Mapping[str, float] = EXPERIENCE_WEIGHTS,
    preference_weights: Mapping[str, float] = PREFERENCE_WEIGHTS,
    unique_ids: bool = False,
) -> DataFrame:
    """Score and rank the venues of each customer by behaviour, recency and experience.

    Rows below `min_orders` stay in the result but carry no rank. Orders and reviews meet as totals
    per customer and venue, already placed by those keys; all windows work on these pairs and share
    one exchange by customer.
    """
    pairs = (
        customer_venue_orders(orders, ok_statuses, unique_ids)
        .join(_pair_reviews(reviews, unique_ids), ["customer_id", "restaurant_id"], "left")
        .fillna({"review_count": 0, "positive_ratio": 0.0, "negative_ratio": 0.0})
    )
    profile = (
        with_customer_share(pairs)
        .withColumns(
            {
                "days_since_last_order": F.datediff(as_of_date(as_of), F.to_date("last_order_timestamp")),
                "review_confidence": confidence("review_count", smoothing),
                "is_eligible": F.col("order_count") >= min_orders,
            }
        )
    )
    scores = {
        "recency_score": recency("days_since_last_order", decay_days),
        "rating_score": shrink(unit_rating("avg_rating"), "review_confidence"),
        "sentiment_score": (F.col("positive_ratio") - F.col("negative_ratio") + 1.0) / 2.0,
        **{
            f"{name}_score": shrink(unit_severity(f"avg_{name}_severity"), "review_confidence")
            for name in ("food_quality", "pricing", "portion")
        },
    }
    scored = (
        profile.withColumns(scores)
        .withColumn("experience_score", round_half_up(weighted(experience_weights), 4))
        .withColumn("preference_score", round_half_up(weighted(preference_weights), 4))
    )

    customer = Window.partitionBy("customer_id")
    best_first = customer.orderBy(
        F.col("is_eligible").cast("int").desc(),
        F.desc("preference_score"),
        F.desc("order_count"),
        F.desc("total_spend"),
        "restaurant_id",
    )
    eligible = F.col("is_eligible")
    ranked = scored.withColumns(
        {
            "eligible_restaurant_count": F.sum(eligible.cast("int")).over(customer),
            "preference_rank": F.when(eligible, F.row_number().over(best_first)),
        }
    )
    status = choose(
        [
            (F.col("eligible_restaurant_count") == 0, F.lit("insufficient_data")),
            (F.col("preference_rank") == 1, F.lit("preferred")),
            (eligible, F.lit("candidate")),
        ],
        F.lit("not_eligible"),
    )
    # The mart's columns.
    return ranked.select(
        "customer_id", "restaurant_id", "order_count", "customer_total_orders", "order_share",
        "total_spend", "first_order_timestamp", "last_order_timestamp", "days_since_last_order",
        "review_count", "avg_rating", "positive_ratio", "negative_ratio",
        "avg_food_quality_severity", "avg_pricing_severity", "avg_portion_severity", "avg_delivery_severity",
        *scores, "experience_score", "preference_score", "is_eligible",
        "eligible_restaurant_count", "preference_rank", status.alias("preference_status"),
    )


def preferred_restaurant(preference: DataFrame, venues: DataFrame) -> DataFrame:
    """The first-ranked venue of each customer, with its name."""
    names = venues.select("restaurant_id", F.col("name").alias("preferred_restaurant_name"))
    return (
        preference.filter(F.col("preference_rank") == 1)
        .select("customer_id", "restaurant_id", "preference_score", "order_share")
        .join(names, "restaurant_id", "left")
        .withColumnRenamed("restaurant_id", "preferred_restaurant_id")
    )


def customer_360(
    customers: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    preference: DataFrame,
    venues: DataFrame,
    as_of: DateLike | Column = None,
    ok_statuses: Sequence[str] = SUCCESS_STATUSES,
    loyalty_floors: Mapping[str, float] = LOYALTY_FLOORS,
    active_days: int = ACTIVE_DAYS,
    at_risk_days: int = AT_RISK_DAYS,
    unique_ids: bool = False,
) -> DataFrame:
    """One row per known customer: orders, reviews, preferred venue, loyalty and activity."""
    ordering = (
        valid_orders(orders, ok_statuses)
        .groupBy("customer_id")
        .agg(
            count_ids(F.col("order_id"), unique_ids).alias("total_orders"),
            F.sum("total_amount").alias("lifetime_spend"),
            mean_money(F.sum("total_amount"), F.count("total_amount")).alias("avg_order_value"),
            F.max("order_date").alias("last_order_date"),
            round_half_up(F.avg("order_hour"), 1).alias("avg_order_hour"),
            rate(F.col("is_weekend")).alias("weekend_order_ratio"),
        )
        .withColumns(
            {
                "days_since_last_order": F.datediff(as_of_date(as_of), "last_order_date"),
                "loyalty_segment": tier("lifetime_spend", loyalty_floors, "Bronze"),
            }
        )
    )
    reviewing = reviews.groupBy("customer_id").agg(
        count_ids(F.col("review_id"), unique_ids).alias("total_reviews_given"),
        round_half_up(F.avg("rating"), 2).alias("avg_rating_given"),
        rate(_is("positive")).alias("positive_review_ratio"),
        rate(_is("negative")).alias("negative_review_ratio"),
        *[
            rate(F.col(f"issue_{c}")).alias(f"{SHORT_NAME[c]}_issue_ratio")
            for c in ("food_quality", "pricing", "portion_size")
        ],
    )
    # The columns that count 0 where there is nothing.
    zero_filled = [
        "total_orders", "lifetime_spend", "total_reviews_given", "positive_review_ratio",
        "negative_review_ratio", "food_quality_issue_ratio", "pricing_issue_ratio", "portion_issue_ratio",
    ]
    idle = F.col("days_since_last_order")
    return (
        customers.select("customer_id")
        .join(ordering, "customer_id", "left")
        .join(reviewing, "customer_id", "left")
        .join(preferred_restaurant(preference, venues), "customer_id", "left")
        .fillna(0, zero_filled)
        .fillna("No Orders Yet", ["loyalty_segment"])
        .withColumns(
            {
                "customer_preference_status": choose(
                    [
                        (F.col("preferred_restaurant_id").isNotNull(), F.lit("has_preference")),
                        (F.col("total_orders") == 0, F.lit("no_orders_yet")),
                    ],
                    F.lit("insufficient_data"),
                ),
                "customer_activity_status": choose(
                    [
                        (idle <= active_days, F.lit("active")),
                        (idle <= at_risk_days, F.lit("at_risk")),
                        (idle > at_risk_days, F.lit("churned")),
                    ],
                    F.lit("no_orders_yet"),
                ),
            }
        )
    )


def venue_customers(
    orders: DataFrame, ok_statuses: Sequence[str] = SUCCESS_STATUSES, unique_ids: bool = False
) -> DataFrame:
    """Totals per venue and customer: the one shuffle of orders that the venue profile needs."""
    amount = F.col("total_amount")
    delivered = F.col("order_type") == "delivery"
    return (
        valid_orders(orders, ok_statuses)
        .groupBy("restaurant_id", "customer_id")
        .agg(
            count_ids(F.col("order_id"), unique_ids).alias("orders"),
            F.sum(amount).alias("revenue"),
            F.count(amount).alias("priced"),
            F.max("order_date").alias("last_date"),
            count_ids(F.when(delivered, F.col("order_id")), unique_ids).alias("delivery_orders"),
            F.sum(F.when(delivered, amount)).alias("delivery_revenue"),
        )
    )


def _loyalty_measures(repeat_from: int) -> dict[str, Column]:
    known = F.col("customer_id").isNotNull()
    customers = F.count_if(known)
    repeaters = F.count_if(known & (F.col("orders") >= repeat_from))
    return {
        "unique_customers": customers,
        "repeat_customers": repeaters,
        "repeat_customer_rate": round_half_up(F.try_divide(repeaters, customers), 4),
    }


def _named(measures: Mapping[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in measures.items()]


def repeat_customer_stats(
    orders: DataFrame, ok_statuses: Sequence[str] = SUCCESS_STATUSES, repeat_from: int = 2, unique_ids: bool = False
) -> DataFrame:
    pairs = venue_customers(orders, ok_statuses, unique_ids)
    return pairs.groupBy("restaurant_id").agg(*_named(_loyalty_measures(repeat_from)))


def restaurant_360(
    venues: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    as_of: DateLike | Column = None,
    ok_statuses: Sequence[str] = SUCCESS_STATUSES,
    smoothing: float = 10.0,
    repeat_from: int = 2,
    health_weights: Mapping[str, float] = HEALTH_WEIGHTS,
    unique_ids: bool = False,
) -> DataFrame:
    """One row per venue: orders, loyalty, delivery, reviews, complaints and a health score.

    Orders are read once: totals per venue and customer, then per venue. Severities average over
    the complaints only, so a venue without complaints has none and keeps the prior quality.
    """
    ordering = (
        venue_customers(orders, ok_statuses, unique_ids)
        .groupBy("restaurant_id")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("revenue").cast("decimal(20,2)").alias("total_revenue"),
            mean_money(F.sum("revenue"), F.sum("priced")).alias("avg_order_value"),
            F.max("last_date").alias("last_order_date"),
            *_named(_loyalty_measures(repeat_from)),
            F.sum("delivery_orders").alias("delivery_order_count"),
            F.sum("delivery_revenue").cast("decimal(20,2)").alias("delivery_revenue"),
        )
        .withColumn("days_since_last_order", F.datediff(as_of_date(as_of), "last_order_date"))
    )
    complaints = []
    for c in REVIEW_CATEGORIES:
        complained = F.when(F.col(f"issue_{c}"), F.col("review_id"))
        severity = F.avg(severity_points(f"{c}_severity", None))
        complaints += [
            count_ids(complained, unique_ids).alias(f"{SHORT_NAME[c]}_complaint_count"),
            round_half_up(severity, 2).alias(f"avg_{SHORT_NAME[c]}_severity"),
        ]
    reviewing = (
        reviews.groupBy("restaurant_id")
        .agg(
            count_ids(F.col("review_id"), unique_ids).alias("total_reviews"),
            round_half_up(F.avg("rating"), 2).alias("avg_rating"),
            rate(_is("positive")).alias("positive_ratio"),
            rate(_is("negative")).alias("negative_ratio"),
            *complaints,
        )
        .withColumn("review_confidence", round_half_up(confidence("total_reviews", smoothing), 4))
    )
    # The columns that count 0 where there is nothing.
    zero_filled = [
        "total_orders", "total_revenue", "unique_customers", "repeat_customers", "repeat_customer_rate",
        "delivery_order_count", "delivery_revenue", "total_reviews", "review_confidence",
        *[f"{SHORT_NAME[c]}_complaint_count" for c in REVIEW_CATEGORIES],
        "positive_ratio", "negative_ratio",
    ]
    total, delivered = F.col("total_orders"), F.col("delivery_order_count")
    trust = "review_confidence"
    return (
        venues.select("restaurant_id", F.col("name").alias("restaurant_name"), "city")
        .join(ordering, "restaurant_id", "left")
        .join(reviewing, "restaurant_id", "left")
        .fillna(0, zero_filled)
        .withColumns(
            {
                "avg_orders_per_customer": round_half_up(F.try_divide(total, F.col("unique_customers")), 2),
                "delivery_order_ratio": F.coalesce(round_half_up(F.try_divide(delivered, total), 4), F.lit(0.0)),
                "rating_score": shrink(unit_rating("avg_rating"), trust),
                "quality_score": shrink(unit_severity("avg_food_quality_severity"), trust),
            }
        )
        .withColumn("restaurant_health_score", round_half_up(weighted(health_weights), 4))
    )


def _first_marked(rows: DataFrame, keys: Sequence[str], within: str, mark: str) -> DataFrame:
    """Mark one row of each value of `within` per key; rows are dealt and sorted as a join on the keys needs them."""
    copies = Window.partitionBy(*keys, within).orderBy(within)
    return rows.repartition(*keys).withColumn(mark, F.row_number().over(copies) == 1)


def daily_item_popularity(
    items: DataFrame, orders: DataFrame, menu: DataFrame, ok_statuses: Sequence[str] = SUCCESS_STATUSES
) -> DataFrame:
    """Sales of each menu item per venue and day; items missing from the menu are left out.

    The date is the order's. An order counts where its first line of an item meets its first header of
    a day. Both are marked in the sort that the join needs anyway, so the distinct count adds no exchange
    and its tasks keep no table of orders; names are attached after the aggregation.
    """
    keys = ["order_id", "restaurant_id"]
    lines = _first_marked(items.select(*keys, "item_id", "quantity", "unit_price", "subtotal"), keys, "item_id", "first_line")
    headers = _first_marked(valid_orders(orders, ok_statuses).select(*keys, "order_date"), keys, "order_date", "first_header")
    daily = (
        lines.join(headers, keys, "inner")
        .groupBy("order_date", "restaurant_id", "item_id")
        .agg(
            F.count_if(F.col("first_line") & F.col("first_header")).alias("order_count"),
            F.sum("quantity").alias("total_quantity_sold"),
            F.sum("subtotal").alias("total_revenue"),
            mean_money(F.sum("unit_price"), F.count("unit_price")).alias("avg_unit_price"),
        )
    )
    names = menu.select("restaurant_id", "item_id", F.col("name").alias("item_name"), "category", "is_vegetarian")
    return daily.join(names, ["restaurant_id", "item_id"], "inner")


def daily_restaurant_performance(
    orders: DataFrame,
    reviews: DataFrame,
    venues: DataFrame,
    as_of: DateLike | Column = None,
    ok_statuses: Sequence[str] = SUCCESS_STATUSES,
    weekend_days: Sequence[str] = ("Friday",),
    unique_ids: bool = False,
) -> DataFrame:
    """One row per venue and day from its first order to `as_of`, without gaps."""
    good = valid_orders(orders, ok_statuses)
    amount = F.col("total_amount")
    delivered = F.col("order_type") == "delivery"
    sales = (
        good.groupBy("restaurant_id", F.col("order_date").alias("activity_date"))
        .agg(
            count_ids(F.col("order_id"), unique_ids).alias("daily_orders"),
            F.sum(amount).alias("daily_revenue"),
            F.count_distinct("customer_id").alias("daily_unique_customers"),
            mean_money(F.sum(amount), F.count(amount)).alias("avg_order_value"),
            count_ids(F.when(delivered, F.col("order_id")), unique_ids).alias("delivery_orders"),
            F.sum(F.when(delivered, amount)).alias("delivery_revenue"),
        )
    )
    opinions = (
        reviews.groupBy("restaurant_id", F.to_date("review_timestamp").alias("activity_date"))
        .agg(
            count_ids(F.col("review_id"), unique_ids).alias("daily_reviews"),
            round_half_up(F.avg("rating"), 2).alias("daily_avg_rating"),
            rate(_is("positive")).alias("daily_positive_ratio"),
            rate(_is("negative")).alias("daily_negative_ratio"),
        )
    )
    # The first day is the first one with sales, so orders are not read again for it.
    first_days = sales.groupBy("restaurant_id").agg(F.min("activity_date").alias("first_day"))
    calendar = days_between(first_days, "first_day", as_of_date(as_of), "activity_date").select(
        "restaurant_id",
        "activity_date",
        day_name("activity_date").alias("day_of_week"),
        is_day("activity_date", weekend_days).alias("is_weekend"),
    )
    context = venues.select("restaurant_id", F.col("city").alias("restaurant_city"), "opening_date")
    grain = ["restaurant_id", "activity_date"]
    # The columns that count 0 where there is nothing.
    zero_filled = [
        "daily_orders", "daily_revenue", "daily_unique_customers",
        "delivery_orders", "delivery_revenue", "daily_reviews",
    ]
    return (
        calendar.join(sales, grain, "left")
        .join(opinions, grain, "left")
        .join(context, "restaurant_id", "left")
        .withColumn("restaurant_age_days", F.datediff("activity_date", "opening_date"))
        .drop("opening_date")
        .fillna(0, zero_filled)
    )
