"""Silver layer: one conformed order stream, its facts, and the dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ordermill.functions.calendar import day_name, is_day, parse_timestamp
from ordermill.functions.payload import MONEY, ORDER_FIELDS, count_items, parse_items
from ordermill.operators.quality import (
    apply_expectations,
    dimension_rules,
    order_item_rules,
    order_rules,
    plausible_rules,
    readable_rules,
)

Metrics = Observation | str | None


def conform_orders(df: DataFrame, source: str, naive_tz: str | None = None) -> DataFrame:
    """The common order columns with a source tag and real timestamps. Stateless."""
    return df.select(*ORDER_FIELDS).withColumns(
        {
            "timestamp": parse_timestamp(df, "timestamp", naive_tz),
            "created_at": parse_timestamp(df, "created_at", naive_tz),
            "source_system": F.lit(source),
        }
    )


def order_time(df: DataFrame, naive_tz: str | None = None) -> Column:
    """An order's time before it is conformed."""
    return parse_timestamp(df, "timestamp", naive_tz)


BODY = [c for c in [*ORDER_FIELDS, "source_system"] if c != "order_id"]


def standing(preference: Column) -> Column:
    """How a conformed order ranks among copies of its id, the smallest first: the place of its source in the
    order of preference, then the newest `created_at`, then the smallest hash of the row."""
    age = F.coalesce(-F.unix_micros("created_at"), F.lit(2**63 - 1))
    return F.struct(preference.alias("preference"), age.alias("age"), F.xxhash64(*BODY).alias("hash"))


def unify_orders(sources: Sequence[tuple[str, DataFrame]], naive_tz: str | None = None) -> DataFrame:
    """Union of the order sources with one row per order id; rows without an id are all kept.

    Sources come in order of preference. The survivor of an id is the row of the most preferred
    source, then the newest `created_at`, then the smallest hash of the row, then the smallest row, so
    reruns agree. It is a minimum, so each task sends on one row per id at most, however many copies an id has.
    Rows without an id have nothing to be compared by and move nowhere: the rules drop and count each of them.
    """
    tagged = [
        conform_orders(df, label, naive_tz).withColumn("preference", F.lit(place))
        for place, (label, df) in enumerate(sources)
    ]
    union = tagged[0]
    for other in tagged[1:]:
        union = union.unionByName(other)
    columns = [*ORDER_FIELDS, "source_system"]
    best = F.min(F.struct(standing(F.col("preference")), *BODY)).alias("best")
    known = union.where("order_id IS NOT NULL").groupBy("order_id").agg(best)
    nameless = union.where("order_id IS NULL").select(*columns)
    return known.select("order_id", *[f"best.{c}" for c in BODY]).select(*columns).unionByName(nameless)


def order_headers(
    unified: DataFrame, weekend_days: Sequence[str] = ("Friday",), precision: tuple[int, int] = MONEY
) -> DataFrame:
    """Order header columns before any quality rule.

    An amount too large for the type is NULL; `total_amount_readable` tells it from a missing one.
    """
    amount = F.col("total_amount").try_cast("decimal({},{})".format(*precision))
    at = F.col("timestamp").cast("timestamp")
    return unified.select(
        "order_id",
        at.alias("order_timestamp"),
        F.to_date(at).alias("order_date"),
        F.hour(at).alias("order_hour"),
        day_name(at).alias("day_of_week"),
        is_day(at, weekend_days).alias("is_weekend"),
        "restaurant_id",
        "customer_id",
        "order_type",
        count_items(F.col("items")).alias("item_count"),
        amount.alias("total_amount"),
        "payment_method",
        "order_status",
        (amount.isNotNull() | F.col("total_amount").isNull()).alias("total_amount_readable"),
    )


def header_rules() -> dict[str, str]:
    return order_rules() | readable_rules("total_amount") | plausible_rules("order_timestamp")


def fact_orders(unified: DataFrame, metrics: Metrics = None, **options) -> DataFrame:
    headers = order_headers(unified, **options)
    return apply_expectations(headers, header_rules(), metrics).drop("total_amount_readable")


def order_lines(unified: DataFrame, precision: tuple[int, int] = MONEY) -> DataFrame:
    """One row per order line before any quality rule; orders without readable items give none."""
    at = F.col("timestamp").cast("timestamp")
    exploded = unified.select(
        "order_id",
        "restaurant_id",
        at.alias("order_timestamp"),
        F.to_date(at).alias("order_date"),
        F.explode(parse_items(F.col("items"), precision)).alias("line"),
    )
    return exploded.select(
        "order_id",
        F.col("line.item_id").alias("item_id"),
        "restaurant_id",
        "order_timestamp",
        "order_date",
        F.col("line.name").alias("item_name"),
        F.col("line.quantity").alias("quantity"),
        F.col("line.unit_price").alias("unit_price"),
        F.col("line.subtotal").alias("subtotal"),
    )


def fact_order_items(unified: DataFrame, metrics: Metrics = None, **options) -> DataFrame:
    return apply_expectations(order_lines(unified, **options), order_item_rules(), metrics)


def with_items_total(unified: DataFrame, precision: tuple[int, int] = MONEY) -> DataFrame:
    """Headers with the sum of their lines, folded inside the array: no explode, no shuffle."""
    lines = parse_items(F.col("items"), precision)
    zero = F.lit(0).cast("decimal(28,2)")
    total = F.aggregate(lines, zero, lambda acc, x: (acc + x["subtotal"]).cast("decimal(28,2)"))
    return unified.withColumns(
        {
            "order_timestamp": F.col("timestamp").cast("timestamp"),
            "item_count": F.size(lines),
            "items_total": total,
            "total_amount": F.col("total_amount").try_cast("decimal({},{})".format(*precision)),
        }
    ).drop("items", "timestamp", "created_at")


RESTAURANT_KEYS = ("restaurant_id", "opening_date")
CUSTOMER_KEYS = ("customer_id", "join_date")
MENU_KEYS = ("restaurant_id", "item_id")


def _dimension(rows: DataFrame, keys: Sequence[str], metrics: Metrics) -> DataFrame:
    return apply_expectations(rows, dimension_rules(*keys), metrics)


def restaurant_rows(raw: DataFrame) -> DataFrame:
    """Venues before any quality rule."""
    opened = F.col("opening_date").try_cast("date").alias("opening_date")
    return raw.select("restaurant_id", "name", "city", "country", "address", opened, "phone")


def dim_restaurant(raw: DataFrame, metrics: Metrics = None) -> DataFrame:
    return _dimension(restaurant_rows(raw), RESTAURANT_KEYS, metrics)


def customer_rows(raw: DataFrame) -> DataFrame:
    """Customers before any quality rule."""
    joined = F.col("join_date").try_cast("date").alias("join_date")
    return raw.select("customer_id", "name", "phone", "city", joined)


def dim_customer(raw: DataFrame, metrics: Metrics = None) -> DataFrame:
    return _dimension(customer_rows(raw), CUSTOMER_KEYS, metrics)


def menu_rows(raw: DataFrame, precision: tuple[int, int] = MONEY) -> DataFrame:
    """Menu items before any quality rule."""
    price = F.col("price").try_cast("decimal({},{})".format(*precision)).alias("price")
    vegetarian = F.col("is_vegetarian").try_cast("boolean").alias("is_vegetarian")
    return raw.select("restaurant_id", "item_id", "name", "category", price, "ingredients", vegetarian, "spice_level")


def dim_menu_item(raw: DataFrame, metrics: Metrics = None, precision: tuple[int, int] = MONEY) -> DataFrame:
    return _dimension(menu_rows(raw, precision), MENU_KEYS, metrics)
