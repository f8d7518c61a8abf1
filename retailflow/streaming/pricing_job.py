"""The pricing stream: wire records to price updates, alerts, orders and live serving values.

The serving table comes in one of two forms. As a table it is read when the job starts, and a new version
is seen when the job is started again from its checkpoint. As the stream of published versions
(``published_serving``) its values are kept in the state, by parts of the items, so a running job prices with
the newest version from the batch after it is published.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from retailflow.config import SpeedConfig
from retailflow.operators.decisions import (
    low_stock_alerts,
    present_decisions,
    update_records,
    reorders,
    with_lookups,
    with_surge,
)
from retailflow.operators.serving import live_serving
from retailflow.operators.velocity import windowed_velocity, with_times
from retailflow.operators.monitoring import observed
from retailflow.schemas import ALERT, EVENT_TYPES, ORDER, PRICE_UPDATE, SERVING, TRAFFIC_RECORD
from retailflow.session import prepare
from retailflow.sources.wire import decode_records
from retailflow.streaming.commits import CommitLog
from retailflow.streaming.keyed_state import DECISION, ITEM_PARTS, LOOKED_UP_WINDOW, ItemPricing, ServedValues
from retailflow.streaming.metrics import counted


#: Events with equal values here are one event.
SILVER_KEY = ["visitor_id", "event", "item_id", "event_time"]
LIVE = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("velocity_window", T.StringType()),
        T.StructField("as_of", T.TimestampType()),
    ]
)
#: Outputs that other systems read, with their contracts.
OUTPUTS = {"updates": PRICE_UPDATE, "alerts": ALERT, "orders": ORDER}
#: Batches after which the live values are written as one snapshot.
COMPACT_EVERY = 16


@dataclass(frozen=True)
class StreamPaths:
    """Where the job writes; everything lives in storage that all executors reach.

    Decisions, updates, alerts, orders, live values and their snapshots are outputs of the commit log at ``root``.
    """

    root: str

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def priced_stream(
    events: DataFrame, serving: DataFrame, weights: dict | None, cfg: SpeedConfig = SpeedConfig()
) -> DataFrame:
    """Decisions of closed windows: windowed counts, serving lookup, keyed state, presentation.

    ``serving`` is a table, or the stream of ``published_serving``.
    """
    prepare(events.sparkSession)
    timely = with_times(events).withWatermark("event_time", cfg.watermark)
    if cfg.deduplicate:
        timely = timely.dropDuplicatesWithinWatermark(SILVER_KEY)
    counts = windowed_velocity(timely, cfg.window_seconds)
    if serving.isStreaming:
        windows = with_published(counts, serving, cfg)
    else:
        # All but the classifier's part of the surge test is known before the state is.
        certain = with_surge(with_lookups(counts, serving), F.lit(1.0), cfg.window_seconds, cfg.pricing)
        windows = certain.withColumnsRenamed({"is_surge": "can_surge", "uplift": "surge_uplift"})
    decided = windows.groupBy("item_id").transformWithStateInPandas(
        statefulProcessor=ItemPricing(weights, cfg),
        outputStructType=DECISION,
        outputMode="Append",
        timeMode="EventTime",
    )
    rules = {
        "records_processed": F.lit(True),
        "surge_events": F.col("is_surge"),
        "low_stock_alerts": F.col("stock") < cfg.reorder_threshold,
    }
    return counted(present_decisions(decided, cfg.display), "pricing", rules)


def with_published(windows: DataFrame, serving: DataFrame, cfg: SpeedConfig = SpeedConfig()) -> DataFrame:
    """Closed windows with what the newest version known before their batch says about them.

    The values are kept in the state of ``ITEM_PARTS`` parts of the items. Items travel without nulls, which would
    turn the ids of a whole Arrow batch into doubles.
    """
    rows = windows.unionByName(serving.where("item_id IS NOT NULL"), allowMissingColumns=True)
    parted = rows.select(
        F.pmod(F.xxhash64("item_id"), F.lit(ITEM_PARTS)).alias("part"),
        F.coalesce("item_id", F.lit(0).cast("long")).alias("item"),
        F.col("item_id").isNotNull().alias("named"),
        *[c for c in rows.columns if c != "item_id"],
    )
    looked_up = parted.groupBy("part").transformWithStateInPandas(
        statefulProcessor=ServedValues(cfg), outputStructType=LOOKED_UP_WINDOW, outputMode="Append", timeMode="None"
    )
    return looked_up.select(F.when(F.col("named"), F.col("item")).alias("item_id"), *LOOKED_UP_WINDOW.names[2:])


def published_serving(spark: SparkSession, changes: str) -> DataFrame:
    """Stream of the rows of published serving versions, as the state takes them, from the folder that lists them."""
    rows = spark.readStream.schema(T.StructType([*SERVING.fields, T.StructField("number", T.LongType())])).parquet(changes)
    return rows.select(
        "item_id",
        "number",
        F.col("price").alias("stored_price"),
        "forecast_demand",
        "max_elasticity",
        F.col("stock").cast("double").alias("stock"),
    )


def write_batch(root: str, cfg: SpeedConfig, compact_every: int = COMPACT_EVERY):
    """foreachBatch body: one pass over the decisions, all outputs committed together.

    Every ``compact_every`` batches the live values so far are written as one snapshot, so a reader needs
    the newest snapshot and the few batches after it.
    """

    def write(decided: DataFrame, batch_id: int) -> None:
        log = CommitLog(decided.sparkSession, root)
        if log.is_committed(batch_id):
            decided.write.format("noop").mode("overwrite").save()  # the state of the batch is still to be kept
            return
        staged = {}
        staged["decisions"], rows = log.stage("decisions", decided, batch_id)
        stamp = F.unix_millis("window_end")
        staged["updates"], _ = log.stage("updates", update_records(rows, stamp), batch_id)
        staged["alerts"], alerts = log.stage("alerts", low_stock_alerts(rows, stamp, cfg.reorder_threshold), batch_id)
        staged["orders"], _ = log.stage("orders", reorders(alerts), batch_id)
        newest = rows.groupBy("item_id").agg(F.max("window_start").alias("as_of"))
        live = live_serving(rows, cfg.window_seconds).join(newest, "item_id").select(*LIVE.names)
        staged["live"], live = log.stage("live", live, batch_id)
        if batch_id % compact_every == compact_every - 1:
            whole = _newest_values(_live_rows(log).unionByName(live))
            staged["snapshot"], _ = log.stage("snapshot", whole, batch_id)
        log.commit(batch_id, staged)

    return write


def _live_rows(log: CommitLog) -> DataFrame:
    """The newest snapshot and the live values of the batches after it."""
    last = log.newest("snapshot")
    if last is None:
        return log.read("live", LIVE)
    return log.read("snapshot", LIVE, last - 1).unionByName(log.read("live", LIVE, last))


def _newest_values(rows: DataFrame) -> DataFrame:
    values = F.struct(*LIVE.names[1:])
    return rows.groupBy("item_id").agg(F.max_by(values, "as_of").alias("v")).select("item_id", "v.*")


def current_live(spark: SparkSession, root: str) -> DataFrame:
    """[item_id, price, velocity, velocity_window]: the newest live values of all committed batches."""
    return _newest_values(_live_rows(CommitLog(spark, root))).drop("as_of")


def committed(spark: SparkSession, root: str, output: str) -> DataFrame:
    """All rows of an output of the job: updates, alerts or orders."""
    return CommitLog(spark, root).read(output, OUTPUTS[output])


def start_pricing(
    events: DataFrame,
    serving: DataFrame,
    root: str,
    weights: dict | None = None,
    cfg: SpeedConfig = SpeedConfig(),
    once: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Start the job; ``once`` drains what is there and stops, else a trigger ``every`` so often, or per window length."""
    paths = StreamPaths(root)
    trigger = {"availableNow": True} if once else {"processingTime": every or f"{cfg.window_seconds} seconds"}
    return (
        priced_stream(events, serving, weights, cfg)
        .writeStream.outputMode("append")
        .foreachBatch(write_batch(root, cfg))
        .option("checkpointLocation", paths.checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_rejects(raw: DataFrame, root: str, once: bool = False, name: str = "rejects") -> StreamingQuery:
    """Route wire records that do not decode or are not of the event contract to the reject folder.

    A row keeps its bytes and reason. Counts of accepted and rejected records are observed under
    ``name`` and come with the progress of each batch.
    """
    paths = StreamPaths(root)
    judged = observed(
        reject_reasons(decode_records(raw)),
        name,
        {"accepted": F.col("reject_reason").isNull(), "rejected": F.col("reject_reason").isNotNull()},
    )
    return (
        judged.where("reject_reason IS NOT NULL")
        .select("value", "reject_reason")
        .writeStream.format("parquet")
        .option("path", paths.rejects)
        .option("checkpointLocation", f"{paths.checkpoint}-rejects")
        .trigger(**({"availableNow": True} if once else {"processingTime": "60 seconds"}))
        .start()
    )


def reject_reasons(decoded: DataFrame) -> DataFrame:
    """Adds to the reasons of decoding that of an event outside the contract."""
    unknown = F.coalesce(~F.col("event").isin(*EVENT_TYPES), F.lit(True))
    return decoded.withColumn("reject_reason", F.coalesce("reject_reason", F.when(unknown, "unknown_event")))


def accepted_events(raw: DataFrame) -> DataFrame:
    """Typed events of the wire records that the stream prices; accepted and rejected ones are counted as they pass."""
    rejected = F.col("reject_reason").isNotNull()
    judged = counted(reject_reasons(decode_records(raw)), "ingest", {"records_processed": ~rejected, "errors": rejected})
    return judged.where("reject_reason IS NULL").select(*TRAFFIC_RECORD.names)


def drain(query: StreamingQuery) -> None:
    """Wait for a bounded run and surface its error."""
    query.awaitTermination()
    failure = query.exception()
    if failure is not None:
        raise failure
