"""All tables in build order: a plain list of builders, each reading tables already written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.calendar import DateLike, parse_timestamp
from ordermill.operators import marts, quality, silver
from ordermill.operators.answers import enrich_by_store, prompt_version
from ordermill.operators.forecast import ForecastPlan, diagnostics_rows, forecast, forecast_rows
from ordermill.operators.reviews import REVIEW_COLUMNS, Scorer, counted_once, enrich_reviews, valid_reviews
from ordermill.session import discard, materialise
from ordermill.sources import sinks
from ordermill.sources.partitions import replace_partitions

Tables = Callable[[str], DataFrame]


Metrics = Observation | None


@dataclass(frozen=True)
class Step:
    """A table and how to build it.

    `build` may pass the observation on to a builder with rules, which then counts the failures of each.
    `rejected` gives the rows that fail, for the quarantine table.
    """

    table: str
    build: Callable[[Tables, Metrics], DataFrame]
    partition_by: Sequence[str] = ()
    comment: str | None = None
    ruled: bool = False
    rejected: Callable[[Tables], DataFrame] | None = None

    @property
    def layer(self) -> str:
        return self.table.split(".")[0]


ANSWERS = "silver.review_answers"


def build_steps(
    as_of: DateLike = None, scorer: Scorer | None = None, naive_tz: str | None = None, answers: str = ANSWERS, model: str = ""
) -> list[Step]:
    """Silver and gold tables in dependency order. Texts without an offset are times in `naive_tz`.

    A scorer is asked about new texts only: its answers are kept in the table `answers`, by text, prompt and `model`.
    """

    def from_silver(mart: Callable[..., DataFrame], *names: str, **options) -> Callable[[Tables, Metrics], DataFrame]:
        return lambda t, seen: mart(*(t(name) for name in names), **options)

    def with_rules(builder: Callable[..., DataFrame], name: str) -> Callable[[Tables, Metrics], DataFrame]:
        return lambda t, seen: builder(t(name), metrics=seen)

    unified, orders, items = "silver.orders_unified_silver", "silver.fact_orders", "silver.fact_order_items"
    reviews = "silver.fact_review"
    venues, customers, menu = "silver.dim_restaurant", "silver.dim_customer", "silver.dim_menu_item"
    preference = "gold.customer_restaurant_preference"

    def all_orders(t: Tables, seen: Metrics) -> DataFrame:
        sources = ("historical_batch", "historical_orders_raw"), ("streaming_kafka", "restaurant_orders_stream_bronze")
        return silver.unify_orders([(label, t(f"bronze.{name}")) for label, name in sources], naive_tz)

    def answered(t: Tables) -> DataFrame:
        raw = t("bronze.customer_reviews_raw")
        raw = raw.withColumn("review_timestamp", parse_timestamp(raw, "review_timestamp", naive_tz))
        rows = enrich_reviews(raw) if scorer is None else enrich_by_store(raw, scorer, answers, prompt_version(model))
        return rows.select(*REVIEW_COLUMNS)

    def enriched(t: Tables, seen: Metrics) -> DataFrame:
        return valid_reviews(answered(t), seen)

    def bad_reviews(t: Tables) -> DataFrame:
        return quality.quarantine(counted_once(answered(t)), quality.review_rules())

    def bad_rows(rows: Callable[[DataFrame], DataFrame], source: str, *keys: str) -> Callable[[Tables], DataFrame]:
        return lambda t: quality.quarantine(rows(t(source)), quality.dimension_rules(*keys))

    def bad_orders(t: Tables) -> DataFrame:
        return quality.quarantine(silver.order_headers(t(unified)), silver.header_rules())

    def bad_items(t: Tables) -> DataFrame:
        return quality.quarantine(silver.order_lines(t(unified)), quality.order_item_rules())

    # One row per order and review id is what the builders above give, so plain counts do.
    once = {"unique_ids": True}
    return [
        Step(unified, all_orders, comment="Orders of all sources, one row per order id"),
        Step(orders, with_rules(silver.fact_orders, unified), ["order_date"], "One row per valid order", True, bad_orders),
        Step(items, with_rules(silver.fact_order_items, unified), ["order_date"], "One row per valid order line", True, bad_items),
        Step(reviews, enriched, comment="Reviews with sentiment and issues", ruled=True, rejected=bad_reviews),
        Step(venues, with_rules(silver.dim_restaurant, "bronze.restaurants_raw"), comment="Venues", ruled=True,
             rejected=bad_rows(silver.restaurant_rows, "bronze.restaurants_raw", *silver.RESTAURANT_KEYS)),
        Step(customers, with_rules(silver.dim_customer, "bronze.customers_raw"), comment="Customers", ruled=True,
             rejected=bad_rows(silver.customer_rows, "bronze.customers_raw", *silver.CUSTOMER_KEYS)),
        Step(menu, with_rules(silver.dim_menu_item, "bronze.menu_items_raw"), comment="Menu items per venue", ruled=True,
             rejected=bad_rows(silver.menu_rows, "bronze.menu_items_raw", *silver.MENU_KEYS)),
        Step("gold.daily_sales_summary", from_silver(marts.daily_sales_summary, orders), comment="Sales per day"),
        Step("gold.daily_restaurant_reviews", from_silver(marts.restaurant_reviews, reviews, venues, **once),
             comment="Review counts per venue"),
        Step(preference, from_silver(marts.customer_restaurant_preference, orders, reviews, as_of=as_of, **once),
             comment="Preference score per customer and venue"),
        Step("gold.customer_360",
             from_silver(marts.customer_360, customers, orders, reviews, preference, venues, as_of=as_of, **once),
             comment="Customer profile"),
        Step("gold.restaurant_360", from_silver(marts.restaurant_360, venues, orders, reviews, as_of=as_of, **once),
             comment="Venue profile"),
        Step("gold.daily_item_popularity", from_silver(marts.daily_item_popularity, items, orders, menu), ["order_date"],
             "Item sales per venue and day"),
        Step("gold.daily_restaurant_performance",
             from_silver(marts.daily_restaurant_performance, orders, reviews, venues, as_of=as_of, **once),
             comment="Sales and reviews per venue and day, without gaps"),
    ]


BUILD_LOG, QUARANTINE = "silver.build_log", "silver.quarantined_rows"


def build_all(spark: SparkSession, steps: Sequence[Step], run: str | None = None) -> None:
    """Write every table of the list; bronze tables must exist.

    Rows written and failures per rule are counted while writing and kept in the build log under `run`
    (default: the current time). Rows that fail a rule go to the quarantine table with their reasons.
    """
    sinks.create_namespaces(spark)
    run = run or dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds")
    counted: list[tuple[str, str, int, str]] = []
    try:
        for step in steps:
            counted += [(step.table, name, int(n), run) for name, n in _write(spark, step).items()]
            if step.rejected is not None:
                _set_aside(step.rejected(spark.read.table), step.table)
    finally:
        # One row per table and rule; what was written before a failure is logged too.
        log = spark.createDataFrame(counted, "table_name string, measure string, value long, run string")
        sinks.append_merged(log, BUILD_LOG, run="run")


def _write(spark: SparkSession, step: Step) -> dict[str, int]:
    """Write one table; rows written and failures per rule."""
    written, seen = Observation(f"written {step.table}"), Observation(f"rules {step.table}") if step.ruled else None
    rows = step.build(spark.read.table, seen).observe(written, F.count(F.lit(1)).alias("rows"))
    sinks.overwrite_table(rows, step.table, partition_by=step.partition_by)
    sinks.tag_table(spark, step.table, {"quality": step.layer}, step.comment)
    return {"rows_written": written.get["rows"], **(seen.get if seen else {})}


def _set_aside(failed: DataFrame, table: str) -> None:
    """Keep rows that fail a rule, as JSON with their reasons, in place of those of the last build; none, if none fails."""
    body = [c for c in failed.columns if c != "reasons"]
    rows = failed.select(F.to_json(F.struct(*body)).alias("row"), "reasons", F.lit(table).alias("table_name"))
    replace_partitions(rows, QUARANTINE, ["table_name"], [(table,)])


def publish_forecasts(
    spark: SparkSession, performance: DataFrame, plan: ForecastPlan = ForecastPlan(), as_of: DateLike = None
) -> None:
    """Fit once, then write the forecasts over the old ones and the diagnostics to the log of all runs.

    A run that is repeated for a day replaces that day's diagnostics.
    """
    sinks.create_namespaces(spark, ["platinum"])
    mixed = materialise(forecast(performance, plan, as_of), f"forecast-{plan.value}")
    sinks.overwrite_table(forecast_rows(mixed, plan), "platinum.daily_revenue_forecast_by_restaurant")
    log = "platinum.daily_revenue_forecast_diagnostics"
    sinks.append_merged(diagnostics_rows(mixed, plan), log, run="model_run_date")
    discard(mixed)
