"""Partitions of a catalog table that are replaced as a whole.

New files are written beside the old ones, in a version folder that no listing of the table sees; then one step
in the catalog points the partition there. A reader has either the old files or the new ones, and a job
that dies before that step has changed nothing. `vacuum` removes files that no partition points to any more.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.session import hadoop_path
from ordermill.sources.sinks import gathered, overwrite_table, setting

VERSIONS = "_versions"
TARGET_BYTES = 128 << 20
PLAIN = re.compile(r"[\w.-]+")


def location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]


def in_partitions(by: Sequence[str], values: Sequence[tuple]) -> Column:
    """A condition of literals alone, so that the listed partitions and no others are read; NULL is a value."""
    if len(by) == 1:
        known = [v for (v,) in values if v is not None]
        wanted = F.col(by[0]).isin(known)
        return wanted | F.col(by[0]).isNull() if len(known) < len(values) else wanted
    listed = F.lit(False)
    for value in values:
        same = F.lit(True)
        for column, v in zip(by, value):
            same = same & F.col(column).eqNullSafe(F.lit(v))
        listed = listed | same
    return listed


def _folder(by: Sequence[str], value: tuple) -> str:
    parts = []
    for column, v in zip(by, value):
        if v is not None and not PLAIN.fullmatch(str(v)):
            raise ValueError(f"not a plain partition value: {v!r}")
        parts.append(f"{column}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}")
    return "/".join(parts)


def _spec(by: Sequence[str], value: tuple) -> str:
    return ", ".join(f"`{c}` = " + ("null" if v is None else f"'{v}'") for c, v in zip(by, value))


def _point(spark: SparkSession, table: str, by: Sequence[str], value: tuple, folder: str) -> None:
    spec = _spec(by, value)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{folder}'")


def replace_partitions(rows: DataFrame, table: str, by: Sequence[str], touched: Sequence[tuple]) -> None:
    """Give the ``touched`` partitions exactly the rows of the frame; one without rows is cleared.

    Rows of other partitions are an error. The first call creates the table. Each partition changes in one
    step, several of them one after another, so a call that is repeated after a failure completes it.
    """
    spark, by = rows.sparkSession, list(by)
    if not spark.catalog.tableExists(table):
        overwrite_table(rows, table, partition_by=by)
        return
    columns = spark.table(table).columns
    version = f"{location(spark, table)}/{VERSIONS}/{uuid4().hex}"
    gathered(rows, by).select(*columns).write.partitionBy(*by).parquet(version)
    written = spark.read.schema(spark.table(table).schema).parquet(version).select(*by).distinct().collect()
    written = [tuple(row) for row in written]
    strangers = set(written) - set(touched)
    if strangers:
        raise ValueError(f"rows of partitions that are not to be replaced: {sorted(map(str, strangers))[:5]}")
    for value in written:
        _point(spark, table, by, value, f"{version}/{_folder(by, value)}")
    gone = set(touched) - set(written)
    known = {tuple(r) for r in spark.table(table).where(in_partitions(by, list(gone))).select(*by).distinct().collect()} if gone else ()
    for value in known:
        # Not dropped: that would remove files which may still be read, and a partition that comes back would
        # find what is left in the folder it had at first.
        folder = f"{version}/{_folder(by, value)}"
        path, files = hadoop_path(spark, folder)
        files.mkdirs(path)
        _point(spark, table, by, value, folder)
    spark.catalog.refreshTable(table)


def partition_files(spark: SparkSession, table: str, by: Sequence[str], values: Sequence[tuple]) -> dict[tuple, tuple[int, int]]:
    """Number and bytes of the files of each listed partition that has any; folders are listed, no row is read."""
    folders = {_folder(by, value): value for value in values}
    names: dict[str, set[str]] = {}
    for file in spark.table(table).where(in_partitions(by, values)).inputFiles():
        folder, name = file.rsplit("/", 1)
        names.setdefault(folder, set()).add(name)
    out = {}
    for folder, held in names.items():
        path, files = hadoop_path(spark, folder)
        sizes = [s.getLen() for s in files.listStatus(path) if s.getPath().getName() in held]
        out[folders["/".join(folder.split("/")[-len(by) :])]] = (len(sizes), sum(sizes))
    return out


def compact_partitions(
    spark: SparkSession, table: str, by: Sequence[str], values: Sequence[tuple], target_bytes: int = TARGET_BYTES, least_files: int = 2
) -> dict[tuple, tuple[int, int]]:
    """Rewrite partitions of ``least_files`` or more small files into files of about ``target_bytes``.

    Spark's reader packs a partition's files into tasks by size; a task writes one file, and nothing is
    shuffled. Returns the files before and after of each partition that was rewritten. To be called by the
    table's only writer: what another one adds meanwhile would be left behind.
    """
    by, done = list(by), {}
    for value, (files, size) in partition_files(spark, table, by, values).items():
        planned = -(-size // target_bytes)
        if files < least_files or files <= planned:
            continue
        version = f"{location(spark, table)}/{VERSIONS}/{uuid4().hex}/{_folder(by, value)}"
        packing = {
            "spark.sql.files.maxPartitionBytes": str(target_bytes),
            "spark.sql.files.openCostInBytes": "1",
            "spark.sql.files.minPartitionNum": "1",
        }
        with ExitStack() as settings:
            for key, wanted in packing.items():
                settings.enter_context(setting(spark, key, wanted))
            spark.table(table).where(in_partitions(by, [value])).drop(*by).write.parquet(version)
        _point(spark, table, by, value, version)
        spark.catalog.refreshTable(table)
        done[value] = (files, partition_files(spark, table, by, [value])[value][0])
    return done


def _files_below(spark: SparkSession, folder: str) -> Iterator[tuple[str, float]]:
    path, files = hadoop_path(spark, folder)
    listed = files.listFiles(path, True)
    while listed.hasNext():
        status = listed.next()
        yield status.getPath().toString(), status.getModificationTime() / 1000


def vacuum(spark: SparkSession, table: str, older_than_seconds: float) -> int:
    """Remove data files that no partition points to and that are older than any reader still running."""
    spark.catalog.refreshTable(table)
    used = {re.sub("^file:/+", "file:/", name) for name in spark.table(table).inputFiles()}
    limit, removed = time.time() - older_than_seconds, 0
    for name, changed in _files_below(spark, location(spark, table)):
        if re.sub("^file:/+", "file:/", name) not in used and changed < limit:
            path, files = hadoop_path(spark, name)
            removed += bool(files.delete(path, False)) and name.endswith(".parquet")
    return removed
