"""Streams: bronze ingest, one row per order, stateless silver facts, touched-day gold refresh."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.operators.answers import enrich_by_store, prompt_version
from ordermill.operators.quality import failed_rules, review_rules
from ordermill.operators.reviews import REVIEW_COLUMNS, CueRules, Scorer, fact_review
from ordermill.operators.silver import fact_order_items, fact_orders
from ordermill.sources import kafka, sinks
from ordermill.sources.partitions import in_partitions, replace_partitions
from ordermill.streaming.orders import OrderStore, days_touched, each_batch, order_store_stream


def bronze_stream(
    messages: DataFrame, table: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Topic (or any stream of the same envelope) to the bronze table."""
    return sinks.stream_to_table(kafka.bronze_orders(messages), table, checkpoint, every)


def silver_order_stream(
    bronze: DataFrame,
    table: str,
    checkpoint: str,
    source: str = "streaming_kafka",
    every: str | None = None,
    naive_tz: str | None = None,
    day: str = "order_date",
) -> StreamingQuery:
    """Bronze to unified orders, one row per order id over all days, partitioned by day.

    The table is the orders of an `OrderStore`; messages without an id are in the store's rejects. Where copies
    replace orders, marts follow the store's change log (`follow_changes`); the append streams below see new rows only.
    """
    return order_store_stream(bronze, OrderStore(table, day=day), checkpoint, source=source, every=every, naive_tz=naive_tz)


def fact_order_stream(
    unified: DataFrame, table: str, checkpoint: str, every: str | None = None, metrics: str | None = None
) -> StreamingQuery:
    """Order facts, partitioned by day so that a refresh of few days reads only those."""
    return sinks.stream_to_table(fact_orders(unified, metrics), table, checkpoint, every, partition_by=["order_date"])


def fact_item_stream(
    unified: DataFrame, table: str, checkpoint: str, every: str | None = None, metrics: str | None = None
) -> StreamingQuery:
    return sinks.stream_to_table(
        fact_order_items(unified, metrics), table, checkpoint, every, partition_by=["order_date"]
    )


def fact_review_stream(
    reviews: DataFrame,
    table: str,
    checkpoint: str,
    scorer: Scorer | None = None,
    rules: CueRules | None = None,
    every: str | None = None,
    answers: str | None = None,
    model: str = "",
) -> StreamingQuery:
    """Review facts as they arrive.

    A scorer's answers are kept in the table ``answers`` (default: named after ``table``), so a text that comes again
    or a batch that is replayed costs no second call. The facts are then partitioned by batch, and a batch that is
    replayed replaces its own. Reviews whose text got no answer fail the rules; they are in the batch's
    rejects with the reason in the store.
    """
    if scorer is None:
        return sinks.stream_to_table(fact_review(reviews, None, rules), table, checkpoint, every)
    store, version = answers or f"{table}_answers", prompt_version(model)

    def take(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = enrich_by_store(batch, scorer, store, version).select(*REVIEW_COLUMNS)
            judged = rows.withColumns({"reasons": failed_rules(review_rules()), "batch": F.lit(batch_id).cast("long")})
            good = judged.where(F.size("reasons") == 0).drop("reasons")
            replace_partitions(good, table, ["batch"], [(batch_id,)])
            replace_partitions(judged.where(F.size("reasons") > 0), f"{table}_rejects", ["batch"], [(batch_id,)])
        finally:
            batch.unpersist()

    return each_batch(reviews, take, checkpoint, every)


def refresh_daily(
    spark: SparkSession,
    facts_stream: DataFrame,
    facts_tables: str | Sequence[str],
    gold_table: str,
    mart: Callable[..., DataFrame],
    checkpoint: str,
    day: str = "order_date",
    every: str | None = None,
    dimensions: Sequence[str] = (),
) -> StreamingQuery:
    """Keep a per-day mart current: each micro-batch recomputes the days it touches.

    `mart` gets the touched days of each facts table, then the dimension tables whole. The days are
    recomputed from the tables and replace their partitions, so replaying a batch after a failure gives
    the same table; a day that is recomputed to nothing is cleared. Facts tables that have no column of the day's name are not cut to the days.
    """
    names = [facts_tables] if isinstance(facts_tables, str) else list(facts_tables)

    def recompute(batch: DataFrame, batch_id: int) -> None:
        days = days_touched(batch, day)
        if not days:
            return
        session = batch.sparkSession
        facts = [t.where(in_partitions([day], days)) if day in t.columns else t for t in map(session.table, names)]
        whole = [session.table(name) for name in dimensions]
        replace_partitions(mart(*facts, *whole).where(in_partitions([day], days)), gold_table, [day], days)

    return each_batch(facts_stream, recompute, checkpoint, every)
