"""Writes: tables, partitioned tables, append logs, streams, namespaces."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

LAYERS = ("bronze", "silver", "gold", "platinum")


def create_namespaces(spark: SparkSession, layers: Sequence[str] = LAYERS, location: str | None = None) -> None:
    for layer in layers:
        where = f" LOCATION '{location.rstrip('/')}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{where}")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one partition value together, so that a day lands in few files.

    A rebalance, unlike a repartition, may be split by AQE: a very large day is not a single task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite_table(df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace a whole table with the frame, its schema and partitioning included."""
    writer = gathered(df, partition_by).write.mode("overwrite").format(fmt).option("overwriteSchema", "true")
    writer.partitionBy(*partition_by).saveAsTable(table)


def overwrite_partitions(df: DataFrame, table: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace only the partitions that occur in the frame; the first call creates the table.

    Inserting into a table takes the overwrite mode from the session, not from write options.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        overwrite_table(df, table, fmt, partition_by)
        return
    ordered = gathered(df, partition_by).select(*spark.table(table).columns)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        ordered.write.insertInto(table, overwrite=True)


def append_rows(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table; the first call creates it."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        overwrite_table(df, table, partition_by=partition_by)
        return
    gathered(df, partition_by).select(*spark.table(table).columns).write.insertInto(table)


def append_merged(df: DataFrame, table: str, fmt: str = "parquet", run: str | None = None) -> None:
    """Append to a log table, adding columns the table lacks and filling columns the frame lacks.

    With `run` the table is partitioned by that column, and a run that is repeated replaces its own rows.
    """
    spark = df.sparkSession
    by = [] if run is None else [run]
    if not spark.catalog.tableExists(table):
        df.write.format(fmt).partitionBy(*by).saveAsTable(table)
        return
    known = spark.table(table).schema
    new = [f for f in df.schema if f.name not in known.names]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    shape = spark.createDataFrame([], spark.table(table).schema)
    rows = shape.unionByName(df, allowMissingColumns=True)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic" if by else "static"):
        rows.write.insertInto(table, overwrite=bool(by))


def tag_table(spark: SparkSession, table: str, properties: Mapping[str, str], comment: str | None = None) -> None:
    entries = dict(properties) | ({"comment": comment} if comment is not None else {})
    listed = ", ".join("'{}' = '{}'".format(k, v.replace("'", r"\'")) for k, v in entries.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def stream_to_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a table exactly once. Without `every` it drains what is there and stops."""
    writer = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.toTable(table)
