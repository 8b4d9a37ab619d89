"""Mixing sources to target weights: hash-random order within each source, cut at the source's exact budget.

Rows get a random key from a hash of their id. A source's key range is cut into buckets of about
``bucket_rows`` rows, each bucket is sorted by itself, and the buckets' totals give every bucket its
offset: a prefix sum over the whole source without a task that holds the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, MOST = (1, 2, 3), 3
BUCKET_ROWS = 5_000  # a task sorts so many rows of a source at a time, however large the source is
KEY_DIGITS = 15  # hexadecimal digits of the hash that make the key
KEYS = 16**KEY_DIGITS


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``target`` per source from (source, source_size): shares by weight, none above ``most`` times its size.

    Water filling in closed form. Sources in the order in which the level reaches their ceiling; the first
    k stop there, where the level that the others then share stays below the next one's ceiling. Every
    product is of whole numbers, so the result does not depend on the order of additions. One row per
    source goes through these windows.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighted = ranked.withColumns(
        {
            "weight": F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"),
            "ceiling": (F.col("source_size") * most).cast("long"),
        }
    )
    rising = Window.orderBy(F.col("ceiling").cast("double") / F.col("weight"), "rank")
    before, onward = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    filled = weighted.withColumns(
        {
            "whole": F.sum("source_size").over(Window.partitionBy()),
            "stopped": F.coalesce(F.sum("ceiling").over(before), F.lit(0)),
            "sharing": F.sum("weight").over(onward),
        }
    ).withColumn("fits", F.col("weight") * (F.col("whole") - F.col("stopped")) <= F.col("ceiling") * F.col("sharing"))
    # The level is that of the first source that fits; all from there on share it.
    level = F.struct(F.col("ceiling").cast("double") / F.col("weight"), "rank", "stopped", "sharing", "whole")
    shared = filled.withColumn("level", F.min(F.when(F.col("fits"), level)).over(rising.rowsBetween(Window.unboundedPreceding, 0)))
    pool = F.col("weight") * (F.col("level.whole") - F.col("level.stopped"))
    target = F.when(F.col("level").isNull(), F.col("ceiling").cast("double")).otherwise(pool.cast("double") / F.col("level.sharing"))
    return shared.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: str = "mix",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target, taken (words, repeats counted).

    Every source takes its rounded target to the word: whole epochs, then documents in key order until the
    budget, the last one in part. A NULL text has size 0, a NULL source is a source of its own (the last).
    Ids break no ties of the key; rows alike in id, key and size are interchangeable. A NULL id hashes as
    an empty one. Other columns are ignored; no documents, or none with a word, take nothing.
    """
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, KEY_DIGITS), 16, 10)
    sized = materialise(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(text_col).alias("size"), key.cast("long").alias("key")),
        "mix-sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    plan = (
        targets(totals.select("source", "source_size"), weights, most)
        .withColumnsRenamed({"source": "name", "source_size": "total"})
        .join(totals.select("source", "rows"), F.col("name").eqNullSafe(F.col("source")))
        .withColumn("budget", F.least(F.round("target").cast("long"), F.col("total") * most))
        .select(
            "name",
            "total",
            "target",
            "budget",
            F.when(F.col("total") > 0, F.expr("budget div total")).otherwise(0).alias("epochs"),
            F.ceil(F.col("rows") / bucket_rows).cast("long").alias("buckets"),
        )
    )
    plan = materialise(plan, "mix-plan")
    placed = sized.join(plan, sized["source"].eqNullSafe(plan["name"])).select(
        "doc_id", "source", "size", "key", "total", "target", "epochs", "budget",
        F.coalesce("source", F.lit("")).alias("held"), F.col("source").isNull().alias("unnamed"),
        F.expr(f"key div ({KEYS} div buckets + 1)").alias("bucket"),
    )
    group = ["held", "unnamed", "bucket"]
    earlier = Window.partitionBy("held", "unnamed").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*group).agg(F.sum("size").alias("bucket_size"))
    offsets = offsets.select(*group, F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*group).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("offset") + F.col("upto") - F.col("size")
    left = F.col("budget") - F.col("epochs") * F.col("total")
    return (
        placed.withColumn("upto", F.sum("size").over(inside))
        .join(offsets, group)
        .select(
            "doc_id",
            "source",
            "size",
            F.col("total").alias("source_size"),
            "target",
            (F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left - start))).cast("long").alias("taken"),
        )
    )
