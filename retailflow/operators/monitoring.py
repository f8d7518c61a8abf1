"""Delivery checks and run counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER_BLOCK = 1_000_000  # consecutive arrivals of one item that are checked together


def verify_delivery(events: DataFrame, expected: Column, now_ms: Column) -> DataFrame:
    """[received, missing, max_lag_ms] of delivered records; ``event_time`` in epoch milliseconds."""
    return events.agg(
        F.count(F.lit(1)).alias("received"),
        F.max(now_ms - F.col("event_time")).alias("lag"),
    ).select(
        "received",
        (expected - F.col("received")).alias("missing"),
        F.greatest(F.coalesce("lag", F.lit(0)), F.lit(0)).cast("bigint").alias("max_lag_ms"),
    )


def order_violations(events: DataFrame, arrival: str = "event_id", block: int = ORDER_BLOCK) -> DataFrame:
    """[item_id, n_events, violations]: events older than the previous arrival of the same item.

    Arrivals with one number come in order of their time; every row counts. Arrivals are compared inside blocks of the arrival number first, so a hot item is spread over many
    tasks; the block borders, one row per item and block, are compared afterwards.
    """
    located = events.select(
        "item_id", "event_time", arrival, F.floor(F.col(arrival) / block).alias("block")
    )
    in_block = Window.partitionBy("item_id", "block").orderBy(arrival, "event_time")
    stepped = located.withColumn("previous", F.lag("event_time").over(in_block))
    blocks = stepped.groupBy("item_id", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_time") < F.col("previous")).alias("inside"),
        F.min_by("event_time", F.struct(arrival, "event_time")).alias("first_time"),
        F.max_by("event_time", F.struct(arrival, "event_time")).alias("last_time"),
    )
    across = Window.partitionBy("item_id").orderBy("block")
    border = F.col("first_time") < F.lag("last_time").over(across)
    return (
        blocks.select("item_id", "n", (F.col("inside") + F.coalesce(border.cast("int"), F.lit(0))).alias("bad"))
        .groupBy("item_id")
        .agg(F.sum("n").alias("n_events"), F.sum("bad").alias("violations"))
    )


def run_metrics(counters: list[tuple[str, DataFrame, dict[str, Column]]]) -> DataFrame:
    """[component, metric, value]: conditional counts of several tables, one pass each."""
    parts = [
        table.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
        .unpivot([], list(rules), "metric", "value")
        .select(F.lit(component).alias("component"), "metric", "value")
        for component, table, rules in counters
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionAll(part)
    return merged


def observed(df: DataFrame, name: str, rules: dict[str, Column]) -> DataFrame:
    """Counts taken while the rows pass by, without another job."""
    return df.observe(name, *[F.count_if(rule).alias(metric) for metric, rule in rules.items()])
