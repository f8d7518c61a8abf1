"""The serving table, one row per item, and the views read from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.config import REORDER_THRESHOLD, TICKER_EVENTS, TOP_SKUS, PricingConfig, SpeedConfig
from retailflow.functions import pricing
from retailflow.schemas import SERVING

_SPEED = SpeedConfig()


def window_label(window_seconds: int) -> str:
    return f"{window_seconds}s"


def _gold_columns(
    forecast: DataFrame, graph: DataFrame, inventory: DataFrame | None, pricing_table: DataFrame | None
) -> list[DataFrame]:
    sources = [
        forecast.select("item_id", "forecast_demand"),
        graph.select("item_id", F.col("elasticity_weight").alias("max_elasticity"), "community"),
    ]
    if inventory is not None:
        sources.append(inventory.select("item_id", "stock"))
    if pricing_table is not None:
        sources.append(pricing_table.select("item_id", F.col("catalog_price").alias("price")))
    return sources


def _stack(sources: list[DataFrame]) -> DataFrame:
    stacked = sources[0]
    for source in sources[1:]:
        stacked = stacked.unionByName(source, allowMissingColumns=True)
    return stacked


def sku_universe(
    forecast: DataFrame, graph: DataFrame, inventory: DataFrame | None = None, pricing_table: DataFrame | None = None
) -> DataFrame:
    """Every item that any source knows."""
    return _stack([s.select("item_id") for s in _gold_columns(forecast, graph, inventory, pricing_table)]).distinct()


def publish_serving(
    forecast: DataFrame, graph: DataFrame, inventory: DataFrame | None = None, pricing_table: DataFrame | None = None
) -> DataFrame:
    """One wide row per item from whichever sources know it.

    The full outer merge is written as a union and one partially aggregated shuffle by item: each
    column has at most one value per item, except edges, whose maximum is the value the pricing needs.
    """
    stacked = _stack(_gold_columns(forecast, graph, inventory, pricing_table))
    merged = stacked.groupBy("item_id").agg(
        *[F.max(c).alias(c) for c in stacked.columns if c != "item_id"]
    )
    return _conform(merged)


def _conform(rows: DataFrame) -> DataFrame:
    present = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SERVING.fields
        ]
    )


def merge_serving(existing: DataFrame, published: DataFrame) -> DataFrame:
    """Nightly merge: published values win, absent ones keep the old value, a live price is never overwritten."""
    old, new = existing.alias("old"), published.alias("new")
    columns = ["item_id"]
    for name in SERVING.names[1:]:
        first, second = ("old", "new") if name in ("price", "velocity", "velocity_window") else ("new", "old")
        columns.append(F.coalesce(f"{first}.{name}", f"{second}.{name}").alias(name))
    return old.join(new, "item_id", "full").select(*columns)


def seed_prices(live: DataFrame, catalog: DataFrame) -> DataFrame:
    """[item_id, price]: the live price where there is one, else the catalog seed."""
    return (
        live.select("item_id", F.col("price").alias("live"))
        .join(catalog.select("item_id", "catalog_price"), "item_id", "full")
        .select("item_id", F.coalesce("live", "catalog_price").alias("price"))
    )


def live_serving(updates: DataFrame, window_seconds: int = _SPEED.window_seconds) -> DataFrame:
    """Newest shown price and velocity per item."""
    return updates.groupBy("item_id").agg(
        F.max_by("new_price", "window_start").alias("price"),
        F.max_by("velocity", "window_start").alias("velocity"),
    ).withColumn("velocity_window", F.lit(window_label(window_seconds)))


def upsert_live(serving: DataFrame, live: DataFrame) -> DataFrame:
    """Serving table with the live columns replaced for the items that have new ones."""
    old, new = serving.alias("old"), live.alias("new")
    live_columns = ("price", "velocity", "velocity_window")
    return old.join(new, "item_id", "full").select(
        "item_id",
        *[
            F.coalesce(f"new.{c}", f"old.{c}").alias(c) if c in live_columns else F.col(f"old.{c}").alias(c)
            for c in SERVING.names[1:]
        ],
    )


def serving_lookup(serving: DataFrame, skus: DataFrame) -> DataFrame:
    """Serving rows of the wanted items; unknown items are absent."""
    return serving.join(skus.select("item_id").distinct(), "item_id", "left_semi")


def elasticity_lookup(lists: DataFrame, skus: DataFrame) -> DataFrame:
    """Related-item lists of the wanted items."""
    return lists.join(skus.select("item_id").distinct(), "item_id", "left_semi")


def _active(serving: DataFrame, window: str) -> DataFrame:
    return serving.where(F.col("velocity").isNotNull() & (F.col("velocity_window") == window))


def active_skus(serving: DataFrame, window: str = "60s") -> DataFrame:
    """Items with a live velocity, in numeric order."""
    return _active(serving, window).select("item_id").distinct().orderBy("item_id")


def kpi_summary(
    serving: DataFrame,
    window: str = "60s",
    window_seconds: int = _SPEED.window_seconds,
    cfg: PricingConfig = PricingConfig(),
    reorder_threshold: int = REORDER_THRESHOLD,
) -> DataFrame:
    """One row of headline numbers over the active items."""
    baseline = pricing.window_baseline(F.col("forecast_demand"), window_seconds)
    surging = pricing.demand_ratio(F.col("velocity"), baseline) > cfg.surge_threshold
    return _active(serving, window).agg(
        F.count(F.lit(1)).alias("active_skus"),
        F.avg("price").alias("avg_price"),
        F.sum("forecast_demand").alias("total_forecast"),
        F.count_if(surging).alias("surge_count"),
        F.count_if(F.col("stock") < reorder_threshold).alias("low_stock_count"),
    )


def _busiest(serving: DataFrame, window: str, n: int) -> DataFrame:
    return _active(serving, window).orderBy(F.desc("velocity"), "item_id").limit(n)


def forecast_vs_actual(serving: DataFrame, window: str = "60s", n: int = TOP_SKUS) -> DataFrame:
    """Forecast next to live velocity for the busiest items."""
    return _busiest(serving, window, n).select(
        "item_id",
        F.coalesce("forecast_demand", F.lit(0.0)).alias("forecast"),
        F.coalesce("velocity", F.lit(0.0)).alias("actual"),
    )


def price_snapshot(serving: DataFrame, window: str = "60s", n: int = TOP_SKUS) -> DataFrame:
    """Current price of the busiest items."""
    return _busiest(serving, window, n).select("item_id", F.coalesce("price", F.lit(0.0)).alias("price"))


def recent_updates(updates: DataFrame, n: int = TICKER_EVENTS) -> DataFrame:
    """The newest n updates of a feed."""
    return updates.orderBy(F.desc("event_time"), F.desc("item_id")).limit(n)


def price_ticker(updates: DataFrame, n: int = TICKER_EVENTS) -> DataFrame:
    """[item_id, series]: time-ordered prices of the newest n updates, so a series holds at most n points."""
    point = F.struct("event_time", "new_price")
    return recent_updates(updates, n).groupBy("item_id").agg(F.sort_array(F.collect_list(point)).alias("series"))


def tail_updates(updates: DataFrame, last_time: int, last_item: int, n: int = TICKER_EVENTS) -> DataFrame:
    """The next n updates after the last one seen, in order of (time, item).

    An item has at most one update for each time, so the pair of the last row of a page is an exact
    cursor: pages follow each other without loss or repetition, also where a time is cut by the page.
    """
    later = (F.col("event_time") > last_time) | ((F.col("event_time") == last_time) & (F.col("item_id") > last_item))
    return updates.where(later).orderBy("event_time", "item_id").limit(n)
