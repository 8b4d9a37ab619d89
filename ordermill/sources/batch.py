"""Batch reads: JDBC tables, CSV files with declared schemas, catalog tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordermill.sources import sinks


@dataclass(frozen=True)
class JdbcSplit:
    """How to read a table in parallel: ranges of a numeric, date or timestamp column."""

    column: str
    lower: str | int
    upper: str | int
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


#: A whole-number hash of a text column per kind of database, as its own functions give it.
HASHES = {
    "postgresql": "hashtext({c})",
    "mysql": "crc32({c})",
    "mariadb": "crc32({c})",
    "oracle": "ora_hash({c})",
}


@dataclass(frozen=True)
class HashSplit:
    """How to read a table in parallel by any column: rows go by the hash of the column, worked out in the database.

    ``hashed`` is SQL of that database for a whole number from column ``{c}``; see `HASHES`. Every row meets one
    predicate: NULLs are in the first part.
    """

    column: str
    partitions: int
    hashed: str

    def predicates(self) -> list[str]:
        n, value = self.partitions, self.hashed.format(c=self.column)
        # The remainder of a negative number may be negative.
        parts = [f"MOD(MOD({value}, {n}) + {n}, {n}) = {k}" for k in range(n)]
        # Some databases hash NULL to a number.
        return [f"{parts[0]} OR {self.column} IS NULL", *[f"{part} AND {self.column} IS NOT NULL" for part in parts[1:]]]


#: In place of a split: the table is small enough for one task.
SMALL = None
Split = JdbcSplit | HashSplit | None
TEXTS = ("string", "char", "varchar")


def read_jdbc(
    spark: SparkSession,
    table: str,
    connection: Mapping[str, str],
    split: Split,
    fetch_size: int = 10_000,
) -> DataFrame:
    """One table over JDBC, read by ranges or hashes of a column; `SMALL` reads it in a single task."""
    options = {**connection, "fetchsize": str(fetch_size)}
    if isinstance(split, HashSplit):
        url = options.pop("url")
        return spark.read.jdbc(url, table, predicates=split.predicates(), properties=options)
    if split is not None:
        options |= split.options()
    return spark.read.format("jdbc").options(**options, dbtable=table).load()


def bounds_query(table: str, column: str) -> str:
    return f"(SELECT MIN({column}) AS lowest, MAX({column}) AS highest, COUNT(*) AS row_count FROM {table}) bounds"


def split_for(
    kind: str, column: str, lowest: object, highest: object, rows: int, rows_per_task: int, hashed: str | None, most: int
) -> Split:
    """The split of a column of a Spark type, from its least and greatest value and the number of rows."""
    tasks = min(most, -(-rows // rows_per_task))
    if tasks <= 1:
        return SMALL
    if kind.startswith(TEXTS):
        if hashed is None:
            raise ValueError(f"a text column needs a hash expression to be split by: {column}")
        return HashSplit(column, tasks, hashed)
    if lowest is None:
        return SMALL
    return JdbcSplit(column, str(lowest), str(highest), tasks)


def find_split(
    spark: SparkSession, table: str, connection: Mapping[str, str], column: str, rows_per_task: int = 1_000_000,
    hashed: str | None = None, most: int = 256,
) -> Split:
    """Find a split by asking the database for the column's bounds and the number of rows.

    Numbers, dates and timestamps are split by ranges, texts by hash: by the database's own function where the
    connection's URL names a kind in `HASHES`, or by ``hashed``. ``most`` bounds the connections at a time.
    """
    kind = dict(read_jdbc(spark, table, connection, SMALL).select(column).dtypes)[column]
    held = read_jdbc(spark, bounds_query(table, column), connection, SMALL).first()
    vendor = connection["url"].split(":")[1] if ":" in connection.get("url", "") else ""
    return split_for(kind, column, held[0], held[1], int(held[2]), rows_per_task, hashed or HASHES.get(vendor), most)


@dataclass(frozen=True)
class TableLoad:
    """A table to copy. How to split the read has to be said; `SMALL` says that one task will do."""

    source: str
    target: str
    split: Split
    options: Mapping[str, str] = field(default_factory=dict)


def load_tables(spark: SparkSession, loads: list[TableLoad], connection: Mapping[str, str], fmt: str = "parquet") -> dict[str, int]:
    """Copy tables into the lake, each overwriting its target; rows are counted while writing."""
    counts = {}
    for load in loads:
        seen = Observation(f"load_{load.target}")
        rows = read_jdbc(spark, load.source, {**connection, **load.options}, load.split)
        sinks.overwrite_table(rows.observe(seen, F.count(F.lit(1)).alias("rows")), load.target, fmt)
        counts[load.target] = seen.get["rows"]
    return counts


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a declared schema; the text "None" stays text."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


# Columns of the reference files.
RESTAURANTS_CSV = (
    "restaurant_id string, name string, city string, province string, country string, "
    "address string, opening_date string, phone string"
)
MENU_ITEMS_CSV = (
    "restaurant_id string, item_id string, name string, category string, price int, "
    "ingredients string, is_vegetarian string, spice_level string"
)
CUSTOMERS_CSV = (
    "customer_id string, name string, email string, phone string, city string, join_date string"
)
HISTORICAL_ORDERS_CSV = (
    "order_id string, timestamp string, restaurant_id string, customer_id string, order_type string, "
    "items string, total_amount double, payment_method string, order_status string, created_at string"
)
REVIEWS_CSV = (
    "review_id string, order_id string, customer_id string, restaurant_id string, review_text string, "
    "rating int, review_timestamp string"
)


def publish_csv(
    spark: SparkSession, path: str, schema: str, table: str, connection: Mapping[str, str]
) -> bool:
    """Replace a database table with a CSV file; a missing file is skipped and reported as False."""
    try:
        rows = read_csv(spark, path, schema)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    rows.write.format("jdbc").options(**connection, dbtable=table).mode("overwrite").save()
    return True


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_stream_table(spark: SparkSession, name: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).table(name)
