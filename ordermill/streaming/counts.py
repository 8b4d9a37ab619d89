"""Rule counts of streams, kept in the build log batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ordermill.sources import sinks

LOG = "table_name string, measure string, value long, run string"


class RuleCountLog(StreamingQueryListener):
    """Writes the observed rule counts of every batch to a log table.

    `observed` names the metrics to keep: a stream built with ``metrics="silver.fact_orders"`` is logged under that
    name. A run is a query's id and a batch: a batch that is reported again after a restart replaces its own
    rows, and a query that starts anew counts as another one. Batches without rows are not logged.
    """

    def __init__(self, spark: SparkSession, table: str, observed: Sequence[str]):
        self.spark, self.table, self.observed, self.problems = spark, table, set(observed), []

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = [
            (name, measure, int(value), f"{progress.id}.{progress.batchId}")
            for name, row in progress.observedMetrics.items()
            if name in self.observed
            for measure, value in row.asDict().items()
        ]
        if any(value for _, _, value, _ in counts):
            try:
                sinks.append_merged(self.spark.createDataFrame(counts, LOG), self.table, run="run")
            except Exception as problem:  # a listener's error would be lost; the caller sees it here
                self.problems.append(problem)
