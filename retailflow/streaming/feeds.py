"""Checkpointed readers of the outputs that a streaming job commits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from retailflow.streaming.commits import ENTRY, CommitLog

#: The one output that a follower commits.
ROWS = "rows"


def follow(
    spark: SparkSession,
    root: str,
    output: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    once: bool = False,
    max_batches: int = 64,
) -> StreamingQuery:
    """Copy what is newly committed of ``output`` below ``root`` to the commit log at ``out``.

    The reader follows the entries of the log, not its folders, so attempts that failed are never seen. Its
    checkpoint holds the entries it has read, and its own log makes a batch of it visible once: every row
    is delivered once, whenever the reader runs and whichever side is tried again.
    """
    entries = spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", max_batches).json(CommitLog(spark, root).folder)

    def copy(named: DataFrame, batch_id: int) -> None:
        session = named.sparkSession
        paths = [f"{root.rstrip('/')}/{row['path']}" for row in named.where(F.col("output") == output).collect()]
        if paths:
            CommitLog(session, out).publish(batch_id, {ROWS: session.read.schema(schema).parquet(*paths)})

    trigger = {"availableNow": True} if once else {"processingTime": "10 seconds"}
    return entries.writeStream.foreachBatch(copy).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def followed(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Everything that a follower has delivered to ``out``."""
    return CommitLog(spark, out).read(ROWS, schema)
