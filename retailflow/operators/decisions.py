"""Price decisions per item and window, and what follows from them: updates, alerts, orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.config import (
    MESSAGE_CHARS,
    REORDER_THRESHOLD,
    SUPPLIER_EMAIL,
    TARGET_STOCK,
    DisplayConfig,
    PricingConfig,
    SpeedConfig,
)
from retailflow.functions import pricing
from retailflow.functions.pricefold import PieceSummary, carry_base_prices, closing_price
from retailflow.session import written

# Texts of alerts and orders.
LOW_STOCK_MESSAGE = "SKU %d stock %d below threshold %d"
ORDER_SUBJECT = "[AUTO-REORDER] SKU %d low stock (%d units)"
ORDER_BODY = (
    "Automated reorder triggered for SKU %d. Current stock %d is below threshold %d. "
    "Please ship %d units to restore target %d."
)

_SPEED = SpeedConfig()
#: Length of the pieces that the price walk is cut into: a week.
PRICE_BLOCK_SECONDS = 7 * 24 * 60 * 60
SUMMARY = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("_block", T.LongType()),
        T.StructField("stored", T.DoubleType()),
        T.StructField("closing", T.DoubleType()),
        T.StructField("lifts", T.ArrayType(T.DoubleType())),
        T.StructField("runs", T.ArrayType(T.LongType())),
    ]
)


def with_lookups(windows: DataFrame, serving: DataFrame) -> DataFrame:
    """Window rows with the serving values of their item; absent values stay NULL.

    Left to Spark's size check: a serving table under the broadcast threshold is broadcast, a larger
    one is joined by item.
    """
    looked_up = serving.select(
        "item_id",
        F.col("price").alias("stored_price"),
        "forecast_demand",
        "max_elasticity",
        "stock",
    )
    return windows.join(looked_up, "item_id", "left")


def with_surge(
    windows: DataFrame, prob: Column, window_seconds: int, cfg: PricingConfig = PricingConfig()
) -> DataFrame:
    """Adds baseline, window_baseline, surge_prob, is_surge and uplift."""
    return (
        windows.withColumn("baseline", F.coalesce("forecast_demand", F.lit(0.0)))
        .withColumn("window_baseline", pricing.window_baseline(F.col("baseline"), window_seconds))
        .withColumn("surge_prob", prob.cast("double"))
        .withColumn(
            "is_surge", pricing.surge_flag(F.col("surge_prob"), F.col("velocity"), F.col("window_baseline"), cfg)
        )
        .withColumn(
            "uplift",
            pricing.uplift(
                F.col("velocity"),
                F.col("window_baseline"),
                F.coalesce("max_elasticity", F.lit(0.0)),
                F.col("is_surge"),
                cfg,
            ),
        )
    )


def replay_prices(
    windows: DataFrame, display: DisplayConfig = DisplayConfig(), block_seconds: int = PRICE_BLOCK_SECONDS
) -> DataFrame:
    """Adds base_price and new_price by walking the windows of every item in time order.

    The shown price of one window is the base of the next one without a live price. An item's windows are cut into
    pieces by blocks of time, so a long history is spread over many tasks. A piece with a live price closes
    with a price of its own; any other is summarised as what it does to its opening price: the
    lifts in order and how many windows without one lie between them. A second walk over these summaries, one short row a
    piece, gives every piece its opening price, and the pieces are then priced each for itself. The results do
    not depend on the length of a block.
    """
    rows = written(windows.withColumn("_block", F.floor(F.unix_seconds("window_start") / block_seconds)), "walk")
    openings = written(_opening_prices(rows, display), "openings")
    opened = rows.join(openings, ["item_id", "_block"])
    ordered = opened.repartition("item_id", "_block").sortWithinPartitions("item_id", "_block", "window_start")
    priced = [T.StructField("base_price", T.DoubleType()), T.StructField("new_price", T.DoubleType())]

    columns = windows.columns

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, price = None, None  # of the piece that the frame before ended in
        for frame in frames:
            names, first = _pieces(frame)
            live, stored, lift = _prices(frame)
            goes_on = names[0] == name
            # A piece opens with the price shown before it, as if that were live.
            opens = first & ~(goes_on & (np.arange(len(first)) == 0))
            opening = frame["_opening"].to_numpy(dtype="float64", na_value=np.nan)
            number = np.cumsum(first)
            base, shown, last = carry_base_prices(
                number, np.where(opens & np.isnan(live), opening, live), stored, lift, display, (1, price) if goes_on else None
            )
            name, price = names[-1], last[1]
            yield frame[columns].assign(base_price=base, new_price=shown)

    return ordered.mapInPandas(fold, T.StructType([*windows.schema.fields, *priced]))


def _pieces(frame: pd.DataFrame) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Item and block of each row, and where another piece begins."""
    item, block = frame["item_id"].to_numpy(), frame["_block"].to_numpy()
    first = np.append(True, (item[1:] != item[:-1]) | (block[1:] != block[:-1]))
    return list(zip(item.tolist(), block.tolist(), strict=True)), first


def _prices(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    live, stored = (frame[c].to_numpy(dtype="float64", na_value=np.nan) for c in ("last_price", "stored_price"))
    return live, stored, frame["uplift"].to_numpy(dtype="float64")


def _opening_prices(rows: DataFrame, display: DisplayConfig) -> DataFrame:
    """[item_id, _block, _opening]: the price shown before each piece; null for the first piece of an item."""
    ordered = rows.repartition("item_id", "_block").sortWithinPartitions("item_id", "_block", "window_start")

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_piece = None
        for frame in frames:
            pieces, first = _pieces(frame)
            live, stored, lift = _prices(frame)
            bounds = np.append(np.flatnonzero(first), len(frame))
            done = []
            for low, high in zip(bounds, bounds[1:]):
                if open_piece is None or open_piece.name != pieces[low]:
                    if open_piece is not None:
                        done.append(open_piece.row())
                    open_piece = PieceSummary(pieces[low], stored[low])
                open_piece.take(live[low:high], lift[low:high], display)
            yield pd.DataFrame(done, columns=SUMMARY.names)
        if open_piece is not None:
            yield pd.DataFrame([open_piece.row()], columns=SUMMARY.names)

    summaries = written(ordered.select("item_id", "_block", "window_start", "last_price", "stored_price", "uplift").mapInPandas(summarise, SUMMARY), "pieces")
    in_order = summaries.repartition("item_id").sortWithinPartitions("item_id", "_block")

    def resolve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        item = price = None
        for frame in frames:
            openings = []
            for row in frame.itertuples(index=False):
                same = row.item_id == item
                openings.append(price if same else np.nan)
                start = price if same else (0.0 if np.isnan(row.stored) else row.stored)
                price = row.closing if not np.isnan(row.closing) else closing_price(start, row.lifts, row.runs, display)
                item = row.item_id
            yield pd.DataFrame({"item_id": frame["item_id"], "_block": frame["_block"], "_opening": openings})

    return in_order.mapInPandas(resolve, "item_id long, _block long, _opening double")


def present_decisions(priced: DataFrame, display: DisplayConfig = DisplayConfig()) -> DataFrame:
    """Price-update records of rows that carry base_price and uplift."""
    economic = pricing.economic_price(F.col("base_price"), F.col("uplift"))
    shown = priced.withColumn("shown", pricing.present_price(economic, F.col("base_price"), display))
    return shown.select(
        "item_id",
        "window_start",
        "window_end",
        "base_price",
        F.col("shown.display_price").alias("new_price"),
        F.col("velocity").cast("double").alias("velocity"),
        "baseline",
        "surge_prob",
        "is_surge",
        "stock",
        pricing.reason_text(F.col("surge_prob"), F.col("shown.note"), F.col("shown.anchor_price")).alias("reason"),
    )


def decide_prices(
    windows: DataFrame,
    serving: DataFrame,
    prob: Column,
    window_seconds: int = _SPEED.window_seconds,
    cfg: PricingConfig = PricingConfig(),
    display: DisplayConfig = DisplayConfig(),
) -> DataFrame:
    """Batch form of the pricing job: lookups, surge test, price walk, presentation."""
    surging = with_surge(with_lookups(windows, serving), prob, window_seconds, cfg)
    needed = surging.select(
        "item_id", "window_start", "window_end", "velocity", "last_price", "stored_price", "stock",
        "baseline", "surge_prob", "is_surge", "uplift",
    )
    return present_decisions(replay_prices(needed, display), display)


def update_records(decisions: DataFrame, event_time: Column) -> DataFrame:
    """Contract form of price updates; ``event_time`` in epoch milliseconds."""
    return decisions.select(
        event_time.cast("bigint").alias("event_time"),
        "item_id", "base_price", "new_price", "velocity", "baseline", "surge_prob", "reason",
    )


def low_stock_alerts(stocked: DataFrame, event_time: Column, threshold: int = REORDER_THRESHOLD) -> DataFrame:
    """One alert per row whose item has a known stock below the threshold."""
    return stocked.where(F.col("stock") < threshold).select(
        event_time.cast("bigint").alias("event_time"),
        "item_id",
        F.lit("LOW_STOCK").alias("alert_type"),
        F.col("stock").cast("int").alias("stock_level"),
        F.lit(threshold).alias("reorder_threshold"),
        F.format_string(LOW_STOCK_MESSAGE, "item_id", "stock", F.lit(threshold)).alias("message"),
    )


def reorders(
    alerts: DataFrame, target_stock: int = TARGET_STOCK, supplier_email: str = SUPPLIER_EMAIL
) -> DataFrame:
    """Purchase orders that refill to the target; keyed by item and alert time for idempotent sinks."""
    qty = F.greatest(F.lit(target_stock) - F.col("stock_level"), F.lit(0))
    return alerts.select(
        "event_time",
        F.col("item_id").alias("sku"),
        qty.alias("qty"),
        F.lit(supplier_email).alias("supplier_email"),
        F.format_string(ORDER_SUBJECT, "item_id", "stock_level").alias("subject"),
        F.format_string(
            ORDER_BODY, "item_id", "stock_level", "reorder_threshold", qty, F.lit(target_stock)
        ).alias("body"),
    )


# Symbols of the alert log.
ALERT_ICONS = {"LOW_STOCK": "⚠️", "SURGE": "🔥"}
OTHER_ICON = "ℹ️"
NO_TIME = "—"


def alert_log(alerts: DataFrame) -> DataFrame:
    """Readable log rows: clock time in UTC, symbol, message cut to 80 characters."""
    icon = None
    for kind, symbol in ALERT_ICONS.items():
        matches = F.col("alert_type") == kind
        icon = F.when(matches, symbol) if icon is None else icon.when(matches, symbol)
    moment = F.timestamp_millis(F.col("event_time").try_cast("bigint"))
    return alerts.select(
        F.coalesce(F.date_format(moment, "HH:mm:ss"), F.lit(NO_TIME)).alias("time"),
        F.col("item_id").alias("sku"),
        F.col("alert_type").alias("alert"),
        icon.otherwise(OTHER_ICON).alias("icon"),
        F.substring(F.coalesce("message", F.lit("")), 1, MESSAGE_CHARS).alias("message"),
    )
