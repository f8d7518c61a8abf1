"""Windowed demand, per-item history and the surge score."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.config import HISTORY_STEPS, SpeedConfig
from retailflow.functions.surgenet import surge_probabilities
from retailflow.operators.events import event_timestamp
from retailflow.session import written

_SPEED = SpeedConfig()
#: Length of the blocks that long histories are cut into: a week.
HISTORY_BLOCK_SECONDS = 7 * 24 * 60 * 60


def with_times(events: DataFrame) -> DataFrame:
    """Events with their time as a timestamp; a column that is one already keeps its watermark."""
    if isinstance(events.schema["event_time"].dataType, T.TimestampType):
        return events
    return events.withColumn("event_time", event_timestamp(events))


def windowed_velocity(events: DataFrame, window_seconds: int = _SPEED.window_seconds) -> DataFrame:
    """Tumbling-window counts per item and the last known price of the window.

    The counts and the price are partially aggregated before the only shuffle, so a hot item costs
    one row per task. Equal times are settled by event id where there is one, else by price.
    """
    timed = with_times(events)
    settle = "event_id" if "event_id" in timed.columns else "price"
    seen_at = F.when(F.col("price").isNotNull(), F.struct("event_time", settle))
    return (
        timed.groupBy(F.window("event_time", f"{window_seconds} seconds").alias("w"), "item_id")
        .agg(
            F.count_if(F.col("event") == "transaction").alias("velocity"),
            F.count_if(F.col("event") == "view").alias("view_count"),
            F.count_if(F.col("event") == "addtocart").alias("addtocart_count"),
            F.max_by("price", seen_at).alias("last_price"),
        )
        .select(
            "item_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "velocity",
            "view_count",
            "addtocart_count",
            "last_price",
        )
    )


def feature_history(
    windows: DataFrame, ttl_seconds: int = _SPEED.history_ttl_seconds, block_seconds: int = HISTORY_BLOCK_SECONDS
) -> DataFrame:
    """Adds ``sequence``: the last 50 steps of 4 features, flat, front-padded with the first step.

    The history of an item starts anew after a silence longer than the lifetime, measured in event
    time. Histories are cut into blocks of time, so an item with a long one is spread over many tasks; each block
    borrows the 49 rows before it, from as many earlier blocks as hold them, which are all that its own rows
    can reach. The results do not depend on the length of a block.
    """
    columns = windows.columns
    rows = written(windows.withColumn("_block", F.floor(F.unix_seconds("window_start") / block_seconds)), "windows")
    lent = _lent_rows(rows, HISTORY_STEPS - 1)
    every = rows.withColumn("_own", F.lit(True)).unionByName(lent.withColumn("_own", F.lit(False)))

    in_block = Window.partitionBy("item_id", "_block").orderBy("window_start")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    recent = in_block.rowsBetween(1 - HISTORY_STEPS, Window.currentRow)
    silence = F.unix_seconds("window_start") - F.unix_seconds(F.lag("window_start").over(in_block))
    step = F.array(*[F.col(c).cast("double") for c in ("velocity", "view_count", "addtocart_count")], F.lit(0.0))
    numbered = every.select(
        "*", F.row_number().over(in_block).alias("_row"), (F.coalesce(silence, F.lit(0)) > ttl_seconds).alias("_restart")
    )
    gathered = numbered.select(
        *columns,
        "_own",
        F.least(
            F.lit(HISTORY_STEPS),
            F.col("_row") - F.max(F.when(F.col("_restart") | (F.col("_row") == 1), F.col("_row"))).over(so_far) + 1,
        ).alias("_known"),
        F.collect_list(step).over(recent).alias("_steps"),
    ).where("_own")
    own = F.slice("_steps", F.size("_steps") - F.col("_known") + 1, F.col("_known"))
    padded = F.concat(F.array_repeat(own[0], F.lit(HISTORY_STEPS) - F.col("_known")), own)
    return gathered.select(*columns, F.flatten(padded).alias("sequence"))


def _lent_rows(rows: DataFrame, reach: int) -> DataFrame:
    """The last ``reach`` rows before each block of an item, as rows of that block.

    Blocks are counted first, one narrow row each; a row is then lent to every later block whose first row is at most
    ``reach`` rows after it.
    """
    counts = rows.groupBy("item_id", "_block").agg(F.count(F.lit(1)).alias("_n"))
    by_time = Window.partitionBy("item_id").orderBy("_block")
    before = F.coalesce(F.sum("_n").over(by_time.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counts.withColumn("_before", before)
    next_blocks = F.collect_list(F.struct("_block", "_before")).over(by_time.rowsBetween(1, reach))
    lenders = placed.withColumn("_later", next_blocks).where(F.size("_later") > 0)
    place = F.row_number().over(Window.partitionBy("item_id", "_block").orderBy("window_start"))
    tails = rows.withColumn("_place", place).join(lenders, ["item_id", "_block"]).where(F.col("_place") > F.col("_n") - reach)
    each = tails.withColumn("_to", F.explode("_later")).where(
        F.col("_to._before") < F.col("_before") + F.col("_place") + reach
    )
    return each.select(*[c for c in rows.columns if c != "_block"], F.col("_to._block").alias("_block")).select(*rows.columns)


def surge_scorer(spark: SparkSession, weights: dict | None):
    """Vectorised scoring UDF over ``sequence``; the weights are shipped once per executor.

    The network is a few thousand numbers whatever the data size. Missing or misshapen weights score 0.
    """
    shipped = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("float")
    def score(histories: pd.Series) -> pd.Series:
        return pd.Series(surge_probabilities(shipped.value, histories.to_list()))

    return score


def surge_score(histories: DataFrame, weights: dict | None) -> DataFrame:
    return histories.withColumn("surge_prob", surge_scorer(histories.sparkSession, weights)("sequence"))
