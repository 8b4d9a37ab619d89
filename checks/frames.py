"""The test tables in the shape of this library's inputs (see FIXTURES.md).

Each frame is derived from whole tables; `checks.sql` states the same definitions in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.numbers import choose

AS_OF = "2001-08-02"
EARLIER_RUN = "2001-07-26"
BRAND = "Acme Table"
LOYALTY_FLOORS = {"Platinum": 3_000_000, "Gold": 2_000_000, "Silver": 1_000_000}


# Folders of frames that were written out beforehand, by frame name and table folder.
STORED: dict[tuple[str, str], str] = {}


def frame(build):
    """Frames are lazy: one per session and folder will do, as with tables opened by name."""
    cached = lru_cache(maxsize=512)(build)

    @wraps(build)
    def opened(spark: SparkSession, sf_dir: str, *rest) -> DataFrame:
        folder = None if rest else STORED.get((build.__name__, sf_dir))
        return spark.read.parquet(folder) if folder else cached(spark, sf_dir, *rest)

    return opened


def store(spark: SparkSession, sf_dir: str, names: Sequence[str], folder: str) -> None:
    """Write frames out and read them from there from now on, as a deployment reads its tables."""
    for name in names:
        path = f"{folder.rstrip('/')}/{name}"
        globals()[name](spark, sf_dir).write.mode("overwrite").parquet(path)
        STORED[name, sf_dir] = path


@frame
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tagged(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


@frame
def venues_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    opened = F.date_add(F.lit("1994-01-01").cast("date"), (F.col("n_nationkey") * 30).cast("int"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        tagged("V", "n_nationkey").alias("restaurant_id"),
        F.concat(F.lit(f"{BRAND} - "), "n_name").alias("name"),
        F.col("r_name").alias("city"),
        F.col("r_name").alias("province"),
        F.lit("Earth").alias("country"),
        tagged("Street ", "n_nationkey").alias("address"),
        opened.cast("string").alias("opening_date"),
        tagged("+", "n_nationkey").alias("phone"),
    )


@frame
def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
    return table(spark, sf_dir, "customer").select(
        tagged("C", "c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat("c_name", F.lit("@example.org")).alias("email"),
        tagged("+", "c_custkey").alias("phone"),
        F.col("c_mktsegment").alias("city"),
        joined.cast("string").alias("join_date"),
    )


@frame
def _order_venue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue and line count per order."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("l_suppkey"), F.count(F.lit(1)).cast("int").alias("item_count")
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "l_orderkey", "item_count", tagged("V", "s_nationkey").alias("restaurant_id")
    )


def _when(c: str, values: dict[str, str], default: str) -> Column:
    return choose([(F.col(c) == k, F.lit(v)) for k, v in values.items()], F.lit(default))


@frame
def orders_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders with their venue; those without lines have neither venue nor items."""
    orders = table(spark, sf_dir, "orders")
    second = (F.col("o_orderkey") * 7919 % 86400).cast("int")
    at = F.timestamp_add("SECOND", second, F.col("o_orderdate")).cast("timestamp")
    payment = choose(
        [(F.col("o_orderkey") % 3 == 0, F.lit("cash")), (F.col("o_orderkey") % 3 == 1, F.lit("card"))],
        F.lit("wallet"),
    )
    kinds = {"1-URGENT": "delivery", "2-HIGH": "delivery", "3-MEDIUM": "takeaway"}
    return orders.join(
        _order_venue(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    ).select(
        "o_orderkey",
        tagged("O", "o_orderkey").alias("order_id"),
        at.alias("order_timestamp"),
        "restaurant_id",
        tagged("C", "o_custkey").alias("customer_id"),
        _when("o_orderpriority", kinds, "dine_in").alias("order_type"),
        "item_count",
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        payment.alias("payment_method"),
        _when("o_orderstatus", {"F": "completed", "P": "delivered"}, "pending").alias("order_status"),
    )


@frame
def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order facts without the detour over JSON text."""
    at = F.col("order_timestamp")
    return orders_flat(spark, sf_dir).filter("restaurant_id IS NOT NULL AND total_amount > 0").select(
        "order_id", "order_timestamp", F.to_date(at).alias("order_date"), F.hour(at).alias("order_hour"),
        F.date_format(at, "EEEE").alias("day_of_week"),
        (F.date_format(at, "EEEE") == "Friday").alias("is_weekend"),
        "restaurant_id", "customer_id", "order_type", "item_count", "total_amount",
        "payment_method", "order_status",
    )


@frame
def lines_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_partkey",
        tagged("P", "l_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)").alias("unit_price"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("subtotal"),
    )


@frame
def fact_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_flat(spark, sf_dir).filter("restaurant_id IS NOT NULL")
    at = F.col("order_timestamp")
    return lines_flat(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "order_id", "item_id", "restaurant_id", "order_timestamp", F.to_date(at).alias("order_date"),
        F.col("name").alias("item_name"), "quantity", "unit_price", "subtotal",
    )


def menu_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The menu without every tenth part, so that joins with it have something to leave out."""
    return whole_menu_raw(spark, sf_dir).filter("CAST(substr(item_id, 2) AS bigint) % 10 <> 0")


@frame
def whole_menu_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items a venue has sold."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    sold = lines.join(_order_venue(spark, sf_dir), "l_orderkey").select("restaurant_id", "l_partkey").distinct()
    return sold.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        "restaurant_id",
        tagged("P", "p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_brand").alias("ingredients"),
        (F.col("p_size") % 2 == 0).alias("is_vegetarian"),
        F.lit("None").alias("spice_level"),
    )


@frame
def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as they arrive: one row per order with its items as one JSON text.

    An order's items are one field of one message by contract, so they are gathered per order here.
    """
    line = F.struct("item_id", "name", "quantity", "unit_price", "subtotal")
    items = lines_flat(spark, sf_dir).groupBy("l_orderkey").agg(F.to_json(F.collect_list(line)).alias("items"))
    iso = F.date_format("order_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    return (
        orders_flat(spark, sf_dir)
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            "o_orderkey", "order_id", iso.alias("timestamp"), "restaurant_id", "customer_id", "order_type",
            "items", F.col("total_amount").cast("double").alias("total_amount"), "payment_method",
            "order_status", iso.alias("created_at"),
        )
    )


def historical_orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_payloads(spark, sf_dir).filter("o_orderkey % 10 < 8").drop("o_orderkey")


@frame
def _sent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as a stream sends them: with zoned timestamps and another status."""
    zoned = {c: F.concat(c, F.lit("+00:00")) for c in ("timestamp", "created_at")}
    return order_payloads(spark, sf_dir).withColumns({**zoned, "order_status": F.lit("pending")})


def _live_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live share, which overlaps the historical one."""
    return _sent_orders(spark, sf_dir).filter("o_orderkey % 10 >= 6")


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live share in a message envelope."""
    return all_messages(spark, sf_dir).filter("offset % 10 >= 6")


def all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in a message envelope; `items` is a real array inside the payload."""
    payload = [
        "order_id", "timestamp", "restaurant_id", "customer_id", "order_type", "items",
        "total_amount", "payment_method", "order_status", "created_at",
    ]
    array = "array<struct<item_id string, name string, quantity int, unit_price decimal(10,2), subtotal decimal(10,2)>>"
    sent = _sent_orders(spark, sf_dir).withColumn("items", F.from_json("items", array))
    return sent.select(
        F.col("restaurant_id").cast("binary").alias("key"),
        F.to_json(F.struct(*payload)).cast("binary").alias("value"),
        F.to_timestamp("timestamp").alias("timestamp"),
        (F.col("o_orderkey") % 4).cast("int").alias("partition"),
        F.col("o_orderkey").alias("offset"),
    )


def bronze_stream_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live_orders(spark, sf_dir).drop("o_orderkey")


def _severity(k: int) -> Column:
    place = (F.col("doc_id") + k) % 4
    return choose(
        [(place == 0, F.lit("none")), (place == 1, F.lit("minor")), (place == 2, F.lit("moderate"))], F.lit("severe")
    )


CATEGORY_SHIFT = {"delivery": 0, "food_quality": 1, "pricing": 2, "portion_size": 3}


@frame
def _review_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    orders = orders_flat(spark, sf_dir).select("o_orderkey", "order_id", "order_timestamp", "customer_id", "restaurant_id")
    days = F.make_dt_interval(days=(F.col("doc_id") % 7 + 1).cast("int"))
    return docs.join(orders, F.col("doc_id") == F.col("o_orderkey")).select(
        "doc_id",
        tagged("R", "doc_id").alias("review_id"),
        "order_id", "customer_id", "restaurant_id",
        (F.col("n_chars") % 5 + 1).cast("int").alias("rating"),
        F.col("text").alias("review_text"),
        (F.col("order_timestamp") + days).alias("review_timestamp"),
    )


@frame
def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews; each text ends with remarks that name the document's severities."""
    remarks = {
        ("delivery", "minor"): "bit late", ("delivery", "moderate"): "very late", ("delivery", "severe"): "never arrived",
        ("food_quality", "minor"): "bland", ("food_quality", "moderate"): "stale", ("food_quality", "severe"): "inedible",
        ("pricing", "minor"): "pricey", ("pricing", "moderate"): "overpriced", ("pricing", "severe"): "rip off",
        ("portion_size", "minor"): "small portion", ("portion_size", "moderate"): "tiny portion",
        ("portion_size", "severe"): "left hungry",
    }
    words = [F.col("review_text")]
    for category, shift in CATEGORY_SHIFT.items():
        cases = [(_severity(shift) == level, F.lit(words_)) for (c, level), words_ in remarks.items() if c == category]
        words.append(choose(cases, F.lit("fine")))
    return _review_base(spark, sf_dir).withColumn("review_text", F.concat_ws(". ", *words)).drop("doc_id")


@frame
def fact_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review facts with sentiment from the labels and severities from the document id."""
    labels = table(spark, sf_dir, "labels")
    mood = choose(
        [
            ((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit("negative")),
            (F.col("quality") == 1, F.lit("positive")),
        ],
        F.lit("neutral"),
    )
    issues = []
    for category, shift in CATEGORY_SHIFT.items():
        issues += [
            (_severity(shift) != "none").alias(f"issue_{category}"),
            _severity(shift).alias(f"{category}_severity"),
        ]
    return _review_base(spark, sf_dir).join(labels, "doc_id", "left").select(
        "review_id", "order_id", "customer_id", "restaurant_id", "rating", "review_text",
        mood.alias("sentiment"), *issues, "review_timestamp",
    )
