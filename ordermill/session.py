"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Settable on a running session, so they can be applied to a session someone else created.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets AQE split a skewed join partition even where that costs one more exchange: a key
    # holding a third of the rows is otherwise a single straggling task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The sketch aggregate keeps objects in a hash map; the default of 128 keys makes it sort.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app_name: str = "ordermill", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("ORDERMILL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", os.path.join(tempfile.gettempdir(), "ordermill"))
        # Without call sites in error messages, a plan of many expressions is built in half the time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared scratch folder that `spark.checkpoint.dir` names; where it is unset, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so several outputs share one run.

    The files go when the application ends, or before by `discard`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    folder, files = hadoop_path(spark, path)
    files.deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files behind a frame that `materialise` gave."""
    spark = df.sparkSession
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if spark.sparkContext.applicationId not in path:
            raise ValueError(f"not a frame of the shared folder: {path}")
        folder, files = hadoop_path(spark, path)
        files.delete(folder, True)


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system it is in, whichever kind that is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
