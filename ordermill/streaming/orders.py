"""One row per order id over all days, kept current batch by batch, and what depends on it.

An order store is four tables. The orders lie by day. A key store in hash buckets of the id holds, for each id, how
its row ranks among copies and where it lies: a batch looks its ids up in the buckets they fall in, whatever
day a copy claims. Every order that came or changed is listed in a change log, which is what marts follow.
Messages without an id are never compared with one another; they go to the rejects whole.

A batch writes rows first, then changes, then keys. All decisions come from the keys, which stay as they were
until the last step, so a batch that is replayed after a failure decides alike and completes what is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.operators import quality, silver
from ordermill.session import discard, materialise
from ordermill.sources import sinks
from ordermill.sources.partitions import compact_partitions, in_partitions, partition_files, replace_partitions

BUCKETS = 256  # more than a batch has orders keeps a lookup small however large the store is
KEY_FILES = 32  # files of a bucket from which on it is rewritten, best key per id
Step = Callable[[DataFrame], None]


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class OrderStore:
    """The tables of a store by their common name."""

    orders: str
    buckets: int = BUCKETS
    day: str = "order_date"

    @property
    def keys(self) -> str:
        return f"{self.orders}_keys"

    @property
    def changes(self) -> str:
        return f"{self.orders}_changes"

    @property
    def rejects(self) -> str:
        return f"{self.orders}_rejects"


PLACE = ["customer_id", "restaurant_id"]


def _stored_keys(spark: SparkSession, store: OrderStore, touched: Sequence[int]) -> DataFrame:
    """The best key of each id in the touched buckets, with the place of its row."""
    held = spark.table(store.keys).where(F.col("bucket").isin(list(touched)))
    best = held.groupBy("order_id", "bucket").agg(F.min(F.struct("standing", store.day, *PLACE)).alias("best"))
    return best.select("order_id", "bucket", "best.*")


def merge_orders(survivors: DataFrame, store: OrderStore, preference: int = 0) -> None:
    """Take a batch's orders, one row per id and none without, into the store.

    An order wins over the stored one by the rule that `unify_orders` has for copies: the more preferred source
    (``preference``: its place), the newer `created_at`, the smaller hash. The row it replaces leaves its day.
    """
    spark, day = survivors.sparkSession, store.day
    placed = survivors.withColumns(
        {
            day: F.to_date("timestamp"),
            "standing": silver.standing(F.lit(preference)),
            "bucket": bucket_of("order_id", store.buckets),
        }
    )
    if spark.catalog.tableExists(store.keys):
        touched = [row[0] for row in placed.select("bucket").distinct().collect()]
        stored = _stored_keys(spark, store, touched).drop("bucket")
        stored = stored.select("order_id", F.struct(*[c for c in stored.columns if c != "order_id"]).alias("old"))
        met = placed.join(stored, "order_id", "left").where("old IS NULL OR standing < old.standing")
    else:
        kind = f"struct<standing:{dict(placed.dtypes)['standing']},{day}:date,customer_id:string,restaurant_id:string>"
        met = placed.withColumn("old", F.lit(None).cast(kind))
    winners = materialise(met, "winners")
    rows = winners.select(*survivors.columns, day)
    _write_rows(rows, winners, store)
    new = winners.select("order_id", day, *PLACE)
    old = winners.where("old IS NOT NULL").select("order_id", *[f"old.{c}" for c in (day, *PLACE)])
    sinks.append_rows(new.unionByName(old), store.changes)
    sinks.append_rows(winners.select("order_id", "standing", day, *PLACE, "bucket"), store.keys, ["bucket"])
    _tidy_keys(spark, store, [row[0] for row in winners.select("bucket").distinct().collect()])
    discard(winners)


def _write_rows(rows: DataFrame, winners: DataFrame, store: OrderStore) -> None:
    spark, day = rows.sparkSession, store.day
    if not spark.catalog.tableExists(store.orders):
        sinks.overwrite_table(rows, store.orders, partition_by=[day])
        return
    stored = spark.table(store.orders)
    left = [(row[0],) for row in winners.where("old IS NOT NULL").select(f"old.{day}").distinct().collect()]
    plain = rows
    if left:
        # Days that lose a row are written anew, with what the batch adds to them.
        here = F.coalesce(in_partitions([day], left), F.lit(False))
        others = stored.where(here).join(rows.select("order_id"), "order_id", "left_anti")
        replace_partitions(others.unionByName(rows.where(here)), store.orders, [day], left)
        plain = rows.where(~here)
    days = [(row[0],) for row in plain.select(day).distinct().collect()]
    if days:
        # Rows that a broken run of this batch has left behind are not written again.
        there = spark.table(store.orders).where(in_partitions([day], days)).select("order_id")
        sinks.append_rows(plain.join(there, "order_id", "left_anti"), store.orders, [day])


def _tidy_keys(spark: SparkSession, store: OrderStore, touched: Sequence[int]) -> None:
    """Rewrite key buckets of many files, with one row per id."""
    files = partition_files(spark, store.keys, ["bucket"], [(b,) for b in touched]) if touched else {}
    crowded = [bucket for bucket, (count, _) in files.items() if count >= KEY_FILES]
    if crowded:
        best = _stored_keys(spark, store, [b for (b,) in crowded])
        replace_partitions(best, store.keys, ["bucket"], crowded)


def reject_batch(messages: DataFrame, store: OrderStore, batch_id: int, stream: str) -> None:
    """Keep a batch's messages without an order id, each with its text and reasons, once however often it is run."""
    text = F.col("raw_json_payload") if "raw_json_payload" in messages.columns else F.to_json(F.struct(*messages.columns))
    readable = F.from_json(text, "map<string,string>").isNotNull()
    reasons = F.array(F.when(text.isNull(), "empty_message").when(~F.coalesce(readable, F.lit(False)), "unreadable_message").otherwise("valid_order_id"))
    rows = messages.where("order_id IS NULL").select(
        text.alias("row"), reasons.alias("reasons"), F.lit(stream).alias("stream"), F.lit(batch_id).cast("long").alias("batch")
    )
    replace_partitions(rows, store.rejects, ["stream", "batch"], [(stream, batch_id)])


def order_store_stream(
    bronze: DataFrame,
    store: OrderStore,
    checkpoint: str,
    stream: str = "orders",
    source: str = "streaming_kafka",
    preference: int = 0,
    every: str | None = None,
    naive_tz: str | None = None,
    compact_from: int | None = 64,
) -> StreamingQuery:
    """Bronze rows into an order store: one pass splits a batch into orders and rejects.

    No watermark: an order is compared with its copies of all days, however late it is. ``stream`` names the rejects'
    batches; a stream that starts over with a new checkpoint needs a new name. Days of ``compact_from`` or
    more files are compacted between batches.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            reject_batch(batch, store, batch_id, stream)
            survivors = silver.unify_orders([(source, batch.where("order_id IS NOT NULL"))], naive_tz)
            merge_orders(survivors, store, preference)
        finally:
            batch.unpersist()
        if compact_from is not None:
            spark = batch.sparkSession
            days = [(r[0],) for r in batch.select(F.to_date(silver.order_time(batch, naive_tz))).distinct().collect()]
            compact_partitions(spark, store.orders, [store.day], days, least_files=compact_from)

    return each_batch(bronze, take, checkpoint, every)


def each_batch(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def follow_changes(
    spark: SparkSession, store: OrderStore, steps: Sequence[Step], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Run ``steps`` in order on every batch of the change log: (order_id, day, customer_id, restaurant_id).

    Each step recomputes what the batch touches from tables that the steps before have brought up to date,
    and replaces it, so replaying a batch gives the same tables.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                for step in steps:
                    step(batch)
        finally:
            batch.unpersist()

    return each_batch(spark.readStream.table(store.changes), work, checkpoint, every)


def days_touched(changes: DataFrame, day: str) -> list[tuple]:
    return [(row[0],) for row in changes.select(day).distinct().collect()]


def facts_step(
    store: OrderStore, table: str, quarantine: str, rules: quality.Rules, build: Callable[[DataFrame], DataFrame],
    drop: Sequence[str] = (), log: str | None = None,
) -> Step:
    """Facts of the touched days and, in the same pass, the rows that fail a rule, with their reasons.

    ``build`` gives the rows before any rule. With ``log`` the rows seen and the failures per rule are kept by day,
    in place of those of the day's last run, so that their sum is that of one run over all days.
    """

    def step(changes: DataFrame) -> None:
        spark, day = changes.sparkSession, store.day
        days = days_touched(changes, day)
        rows = build(spark.table(store.orders).where(in_partitions([day], days)))
        judged = materialise(rows.withColumn("reasons", quality.failed_rules(rules)), "judged")
        good = judged.where(F.size("reasons") == 0).drop("reasons", *drop)
        replace_partitions(good, table, [day], days)
        body = F.to_json(F.struct(*rows.columns)).alias("row")
        bad = judged.where(F.size("reasons") > 0).select(body, "reasons", F.lit(table).alias("table_name"), day)
        replace_partitions(bad, quarantine, ["table_name", day], [(table, d) for (d,) in days])
        if log is not None:
            measures = [F.count(F.lit(1)).alias("rows_in")]
            measures += [F.count_if(F.array_contains("reasons", name)).alias(name) for name in rules]
            by_day = judged.groupBy(day).agg(*measures).unpivot([day], ["rows_in", *rules], "measure", "value")
            replace_partitions(by_day.withColumn("table_name", F.lit(table)), log, ["table_name", day], [(table, d) for (d,) in days])
        discard(judged)

    return step


def orders_step(store: OrderStore, table: str, quarantine: str, log: str | None = None) -> Step:
    return facts_step(store, table, quarantine, silver.header_rules(), silver.order_headers, ["total_amount_readable"], log)


def items_step(store: OrderStore, table: str, quarantine: str, log: str | None = None) -> Step:
    return facts_step(store, table, quarantine, quality.order_item_rules(), silver.order_lines, (), log)


def daily_step(
    facts: Sequence[str], gold: str, mart: Callable[..., DataFrame], day: str = "order_date", dimensions: Sequence[str] = ()
) -> Step:
    """A per-day mart of the touched days; a day without rows is cleared."""

    def step(changes: DataFrame) -> None:
        spark, days = changes.sparkSession, days_touched(changes, day)
        cut = [spark.table(name).where(in_partitions([day], days)) for name in facts]
        rows = mart(*cut, *[spark.table(name) for name in dimensions])
        replace_partitions(rows.where(in_partitions([day], days)), gold, [day], days)

    return step


# Marts per entity


def in_buckets(df: DataFrame, key: str, buckets: int, touched: Sequence[int]) -> DataFrame:
    """The rows of the touched buckets: by partition where the frame is stored in buckets, else by the key's hash."""
    place = F.col("bucket") if "bucket" in df.columns else bucket_of(key, buckets)
    return df.where(place.isin(list(touched)))


def merge_by_entity(fresh: DataFrame, ids: DataFrame, table: str, id_col: str, key: str, buckets: int, touched: Sequence[int]) -> None:
    """Bring a copy of some facts, stored in hash buckets of ``key``, up to date: ``ids`` leave it, ``fresh`` rows enter."""
    spark = fresh.sparkSession
    rows = in_buckets(fresh.withColumn("bucket", bucket_of(key, buckets)), key, buckets, touched)
    if spark.catalog.tableExists(table):
        kept = in_buckets(spark.table(table), key, buckets, touched).join(ids.select(id_col).distinct(), id_col, "left_anti")
        rows = kept.unionByName(rows)
    replace_partitions(rows, table, ["bucket"], [(b,) for b in touched])


def entity_step(
    store: OrderStore, facts: str, copy: str, key: str, marts: Sequence[tuple[str, Callable[[Callable[[str], DataFrame]], DataFrame]]],
    buckets: int = BUCKETS,
) -> Step:
    """Marts per customer or venue, stored in hash buckets of ``key``: only buckets with a changed order are recomputed.

    ``copy`` holds the facts in the same buckets, so untouched ones are not read. A mart is (table, build); ``build``
    gets a function from a table's name to that table's rows of the touched buckets, those of a plain table
    (a dimension) included where it has the key, and whole where it has not.
    """

    def step(changes: DataFrame) -> None:
        spark, day = changes.sparkSession, store.day
        touched = [row[0] for row in changes.select(bucket_of(key, buckets)).distinct().collect()]
        changed = spark.table(facts).where(in_partitions([day], days_touched(changes, day)))
        fresh = changed.join(changes.select("order_id").distinct(), "order_id", "left_semi")
        merge_by_entity(fresh, changes, copy, "order_id", key, buckets, touched)
        refresh_entities(spark, key, marts, buckets, touched)

    return step


def refresh_entities(
    spark: SparkSession, key: str, marts: Sequence[tuple[str, Callable[[Callable[[str], DataFrame]], DataFrame]]],
    buckets: int, touched: Sequence[int],
) -> None:
    """Recompute the touched buckets of marts per entity; an entity that is gone leaves its bucket."""

    def rows_of(name: str, some: Sequence[int]) -> DataFrame:
        held = spark.table(name)
        return in_buckets(held, key, buckets, some).drop("bucket") if key in held.columns else held

    for gold, build in marts:
        # A mart's first run covers all entities, those without an order too.
        some = list(touched) if spark.catalog.tableExists(gold) else list(range(buckets))
        rows = build(lambda name: rows_of(name, some)).withColumn("bucket", bucket_of(key, buckets))
        replace_partitions(rows, gold, ["bucket"], [(b,) for b in some])


def review_step_stream(
    reviews: DataFrame, copies: Sequence[tuple[str, str, Sequence[tuple]]], checkpoint: str, buckets: int = BUCKETS, every: str | None = None
) -> StreamingQuery:
    """Follow new review facts: for each (copy, key, marts), the copy's touched buckets and the marts that read them."""

    def work(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for copy, key, marts in copies:
                touched = [row[0] for row in batch.select(bucket_of(key, buckets)).distinct().collect()]
                if touched:
                    merge_by_entity(batch, batch, copy, "review_id", key, buckets, touched)
                    refresh_entities(batch.sparkSession, key, marts, buckets, touched)
        finally:
            batch.unpersist()

    return each_batch(reviews, work, checkpoint, every)
