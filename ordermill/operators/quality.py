"""Named data-quality rules: drop, count, quarantine and reconcile.

A rule is SQL text that must be true for a row to be kept; unknown counts as failed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str]

# The vocabularies the rules check against.
ORDER_STATUSES = ("completed", "pending", "ready", "delivered", "preparing", "confirmed")
SUCCESS_STATUSES = ("completed", "delivered")
PAYMENT_METHODS = ("wallet", "card", "cash")
ORDER_TYPES = ("dine_in", "takeaway", "delivery")
SENTIMENTS = ("positive", "neutral", "negative")
SEVERITIES = ("none", "minor", "moderate", "severe")
REVIEW_CATEGORIES = ("delivery", "food_quality", "pricing", "portion_size")


def required(*columns: str) -> dict[str, str]:
    return {f"valid_{c}": f"{c} IS NOT NULL" for c in columns}


def positive(*columns: str) -> dict[str, str]:
    return {f"valid_{c}": f"{c} > 0" for c in columns}


def one_of(column: str, values: Iterable[str]) -> dict[str, str]:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return {f"valid_{column}": f"{column} IN ({listed})"}


def order_rules(statuses: Iterable[str] = ORDER_STATUSES, payments: Iterable[str] = PAYMENT_METHODS) -> dict[str, str]:
    return {
        **required("order_id", "order_timestamp", "customer_id", "restaurant_id"),
        **positive("item_count", "total_amount"),
        **one_of("order_status", statuses),
        **one_of("payment_method", payments),
    }


def readable_rules(*columns: str) -> dict[str, str]:
    """A value that its column's type has no room for fails by name, apart from one that is missing."""
    return {f"readable_{c}": f"{c}_readable" for c in columns}


def plausible_rules(*columns: str, earliest: str = "1970-01-01") -> dict[str, str]:
    """A time before ``earliest`` is a misread one; a single such row would stretch a daily series over centuries."""
    return {f"plausible_{c}": f"{c} IS NULL OR {c} >= TIMESTAMP'{earliest} 00:00:00'" for c in columns}


def order_item_rules() -> dict[str, str]:
    return {
        **required("order_id", "order_timestamp", "order_date", "restaurant_id", "item_id"),
        **positive("quantity", "unit_price", "subtotal"),
    }


def review_rules() -> dict[str, str]:
    rules = one_of("sentiment", SENTIMENTS)
    for category in REVIEW_CATEGORIES:
        rules |= one_of(f"{category}_severity", SEVERITIES)
    return rules | {"non_negative_rating": "rating >= 0"}


def dimension_rules(*keys: str) -> dict[str, str]:
    return required(*keys)


def item_consistency_rules(max_quantity: int = 20, tolerance: float = 0.05) -> dict[str, str]:
    """Line contract: sane quantity and price, subtotal equal to price times quantity."""
    return {
        **required("item_id"),
        "quantity_in_range": f"quantity > 0 AND quantity <= {max_quantity}",
        **positive("unit_price"),
        "subtotal_matches": f"subtotal > 0 AND abs(subtotal - round(unit_price * quantity, 2)) <= {tolerance}",
    }


def order_contract_rules(tolerance: float = 0.05) -> dict[str, str]:
    """Header contract, to be checked on orders that carry `item_count` and `items_total`."""
    return {
        **required("order_id", "order_timestamp", "customer_id", "restaurant_id"),
        **one_of("order_type", ORDER_TYPES),
        **one_of("order_status", ORDER_STATUSES),
        **one_of("payment_method", PAYMENT_METHODS),
        **positive("item_count"),
        "total_matches_items": f"total_amount > 0 AND abs(total_amount - round(items_total, 2)) <= {tolerance}",
    }


def review_contract_rules() -> dict[str, str]:
    return {
        **required("review_id", "order_id", "customer_id", "restaurant_id", "review_text", "review_timestamp"),
        "rating_in_range": "rating BETWEEN 1 AND 5",
    }


def passes(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def passes_all(rules: Rules) -> Column:
    return reduce(lambda a, b: a & b, (passes(r) for r in rules.values()))


def apply_expectations(df: DataFrame, rules: Rules, metrics: Observation | str | None = None) -> DataFrame:
    """Keep the rows that pass every rule.

    With `metrics` the rows seen and the failures per rule are counted in the same pass: an
    Observation for a batch job, a name for a stream (read it from the query's progress).
    """
    if metrics is not None:
        failures = [F.count_if(~passes(r)).alias(name) for name, r in rules.items()]
        df = df.observe(metrics, F.count(F.lit(1)).alias("rows_in"), *failures)
    return df.filter(passes_all(rules))


def violation_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with its failure count, plus `rows_in` and `rows_kept`; one scan."""
    measures = {
        "rows_in": F.count(F.lit(1)),
        "rows_kept": F.count_if(passes_all(rules)),
        **{name: F.count_if(~passes(r)) for name, r in rules.items()},
    }
    counted = df.agg(*[c.alias(name) for name, c in measures.items()])
    return counted.unpivot([], list(measures), "rule", "row_count")


def failed_rules(rules: Rules) -> Column:
    """The names of the rules a row fails; an empty array for a row to keep."""
    return F.array_compact(F.array(*[F.when(~passes(r), F.lit(name)) for name, r in rules.items()]))


def quarantine(df: DataFrame, rules: Rules, reasons: str = "reasons") -> DataFrame:
    """The rows that fail, each with the names of the rules it fails."""
    return df.filter(~passes_all(rules)).withColumn(reasons, failed_rules(rules))


def reconcile(left: DataFrame, right: DataFrame, key: str, left_total: Column, right_total: Column) -> DataFrame:
    """Compare one total computed two ways, per key; `difference` is 0 where they agree.

    Both sides are aggregated before they meet, and keys known to one side only are kept.
    """
    a = left.groupBy(key).agg(left_total.alias("left_total"))
    b = right.groupBy(key).agg(right_total.alias("right_total"))
    return a.join(b, key, "full").withColumn(
        "difference", F.coalesce("left_total", F.lit(0)) - F.coalesce("right_total", F.lit(0))
    )


def load_summary(df: DataFrame, rules: Rules, timestamp: str, amount: str) -> DataFrame:
    """Rows kept and rejected, time span and total amount of the kept rows; one scan."""
    ok = passes_all(rules)
    return df.agg(
        F.count_if(ok).alias("rows_kept"),
        F.count_if(~ok).alias("rows_rejected"),
        F.min(F.when(ok, F.col(timestamp))).alias("first_timestamp"),
        F.max(F.when(ok, F.col(timestamp))).alias("last_timestamp"),
        F.sum(F.when(ok, F.col(amount))).alias("total_amount"),
    )


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count")).orderBy(column)
