"""Counters of running jobs, kept in a table."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from retailflow.operators.monitoring import observed

METRICS = T.StructType(
    [
        T.StructField("component", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.LongType()),
    ]
)


class MetricsSink(StreamingQueryListener):
    """Appends what the queries of a session observe, batch by batch, to a folder.

    The counts are taken while rows pass by, so they cost no other read of a source.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = [
            (component, int(progress.batchId), metric, int(value))
            for component, counts in progress.observedMetrics.items()
            for metric, value in counts.asDict().items()
        ]
        if rows:
            self.spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def settled(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Wait until everything that an ended query observed is written."""
        with self._change:
            return self._change.wait_for(lambda: str(query.runId) in self._ended, seconds)


def counted(rows: DataFrame, component: str, rules: dict) -> DataFrame:
    """Rows whose counts the sink keeps under the name of a component."""
    return observed(rows, component, rules)


def stream_metrics(spark: SparkSession, path: str) -> DataFrame:
    """[component, metric, value] over all batches; a batch that was tried again counts once."""
    batches = spark.read.schema(METRICS).parquet(path).groupBy("component", "batch_id", "metric").agg(F.max("value").alias("value"))
    return batches.groupBy("component", "metric").agg(F.sum("value").alias("value"))
