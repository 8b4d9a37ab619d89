"""JSON payloads: declared schemas, parsing and encoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER_FIELDS = [
    "order_id", "timestamp", "restaurant_id", "customer_id", "order_type",
    "items", "total_amount", "payment_method", "order_status", "created_at",
]

# `items` stays text here: from_json keeps a nested array as its raw JSON, parsed in the next layer.
ORDER_PAYLOAD = T.StructType(
    [T.StructField(n, T.DoubleType() if n == "total_amount" else T.StringType()) for n in ORDER_FIELDS]
)


# Digits of a money column, and how many of them are cents.
MONEY = (18, 2)


def item_schema(precision: tuple[int, int] = MONEY) -> T.ArrayType:
    money = T.DecimalType(*precision)
    fields = {
        "item_id": T.StringType(),
        "name": T.StringType(),
        "category": T.StringType(),
        "quantity": T.IntegerType(),
        "unit_price": money,
        "subtotal": money,
    }
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields.items()]))


def parse_items(c: Column, precision: tuple[int, int] = MONEY) -> Column:
    """Items text to array<struct>; unreadable text gives NULL, an unreadable field a NULL field."""
    return F.from_json(c, item_schema(precision))


def count_items(c: Column) -> Column:
    """Length of the items array, reading one field per element only."""
    return F.size(F.from_json(c, "array<struct<item_id string>>"))


def encode_row(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))
