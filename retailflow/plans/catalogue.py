"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.config import SpeedConfig
from retailflow.functions import pricing
from retailflow.operators import affinity, decisions, demand, events, monitoring, serving, velocity
from retailflow.paths import Lake
from retailflow.plans.nightly import publish_version, run_nightly
from retailflow.schemas import PRICE_UPDATE, SERVING, TRAFFIC_RECORD
from retailflow.session import prepare, scratch, written
from retailflow.sources import files, models, wire
from retailflow.sources.tables import Tables
from retailflow.streaming import feeds, metrics, pricing_job

# The test clicks are sparse: six-hour windows hold several events of an item, and a history of an
# item ends after twelve silent hours.
WINDOW_SECONDS = 6 * 60 * 60
WINDOW_LABEL = f"{WINDOW_SECONDS}s"
HISTORY_TTL = 12 * 60 * 60
SPEED = SpeedConfig(window_seconds=WINDOW_SECONDS, history_ttl_seconds=HISTORY_TTL)

# A fixed "now" keeps lag numbers repeatable: 2024-02-01T00:00:00Z.
NOW_MS = 1_706_745_600_000
LAST_SEEN_MS, LAST_SEEN_ITEM = 1_705_276_800_000, 40  # 2024-01-15T00:00:00Z, in the middle of a page
HALF = "2024-01-16"  # the clicks before and from here on reach a running job apart
CAMPAIGNS = (
    events.CampaignWindow("2024-01-05T12:00:00", "2024-01-06T12:00:00", 8.0),
    events.CampaignWindow("2024-01-06T00:00:00", "2024-01-07T00:00:00", 3.0),
    events.CampaignWindow("2024-01-18T20:00:00", "2024-01-18T20:30:00", 12.0),
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a query under its function name; times leave as zone-free timestamps."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return _plain_times(build(Tables(spark, folder.rstrip("/"))))

    run.__doc__ = build.__doc__
    _QUERIES[build.__name__] = run
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _plain_times(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


# ---------------------------------------------------------------- shared inputs


def silver(t: Tables) -> DataFrame:
    return events.clean_events(t.clicks())


def click_windows(t: Tables) -> DataFrame:
    return velocity.windowed_velocity(silver(t), WINDOW_SECONDS)


def latest_mean_forecast(features: DataFrame) -> DataFrame:
    """Trailing 30-day mean on the newest day: a forecast that SQL can check."""
    return demand.forecast_split(features)[1].select("item_id", F.col("velocity_30d").alias("forecast_demand"))


def click_forecast(t: Tables) -> DataFrame:
    return latest_mean_forecast(demand.rolling_features(silver(t)))


def click_edges(t: Tables) -> DataFrame:
    bought = silver(t).where(F.col("event") == "transaction").select("visitor_id", "item_id")
    return affinity.co_purchase(bought)


def order_edges(t: Tables) -> DataFrame:
    return affinity.co_purchase(t.order_baskets())


def click_graph(t: Tables) -> DataFrame:
    """Click edges with the community of the source item."""
    edges = written(click_edges(t), "edges")
    labels = written(affinity.communities(edges), "labels")
    named = labels.select(F.col("id").alias("item_id"), F.col("label").alias("community"))
    return edges.join(named, "item_id", "left")


def click_serving(t: Tables) -> DataFrame:
    """Serving rows from the click forecast, click graph and property history, published anew for each query."""
    properties = t.item_properties()
    rows = serving.publish_serving(
        click_forecast(t), click_graph(t), demand.build_inventory(properties), demand.build_catalog_price(properties)
    )
    return written(rows, "serving")


def conversion_share():
    """Surge score that SQL can check: the share of transactions among the window's events."""
    return F.col("velocity") / (F.col("velocity") + F.col("view_count") + F.col("addtocart_count"))


def click_decisions(t: Tables, published: DataFrame | None = None) -> DataFrame:
    """``published`` are the serving rows, where they are there already."""
    rows = click_serving(t) if published is None else published
    return decisions.decide_prices(click_windows(t), rows, conversion_share(), WINDOW_SECONDS)


def click_updates(t: Tables) -> DataFrame:
    return decisions.update_records(click_decisions(t), F.unix_millis("window_end"))


def live_table(t: Tables) -> DataFrame:
    """Serving rows after the whole click history was priced; they are published once and read by both steps."""
    published = click_serving(t)
    return serving.upsert_live(published, serving.live_serving(click_decisions(t, published), WINDOW_SECONDS))


def click_alerts(t: Tables) -> DataFrame:
    stocked = decisions.with_lookups(click_windows(t), click_serving(t))
    return decisions.low_stock_alerts(stocked, F.unix_millis("window_end"))


def stage_bronze(t: Tables) -> Lake:
    """Click and property files as the nightly job finds them."""
    lake = Lake(scratch(t.spark, "lake"))
    rows = t.click_text().select("timestamp", "visitorid", "event", "itemid", F.lit("").alias("transactionid"))
    rows.write.option("header", True).csv(lake.bronze("events"))
    t.item_properties().write.option("header", True).csv(lake.bronze("item_properties"))
    return lake


def stage_wire(t: Tables) -> str:
    path = scratch(t.spark, "wire")
    wire.encode_records(t.clicks().select(*TRAFFIC_RECORD.names)).write.parquet(path)
    return path


def fixed_weights(units: int = 32, lean: float = 0.0) -> dict:
    """Repeatable weights of the right shape; none are published. ``lean`` shifts all raw scores."""
    draw = np.random.default_rng(7)
    shapes = {
        "w_input": (4 * units, 4), "w_hidden": (4 * units, units), "b_input": (4 * units,),
        "b_hidden": (4 * units,), "w_head": (1, units), "b_head": (1,),
    }
    weights = {name: draw.normal(0, 0.3, shape).astype("float32") for name, shape in shapes.items()}
    weights["b_head"] += np.float32(lean)
    return weights


#: Shift at which the fixed weights find surges in the test clicks.
SURGING = 1.0


# ---------------------------------------------------------------- sources and sinks


@query
def read_bronze_events(t: Tables) -> DataFrame:
    return files.read_bronze_events(t.spark, stage_bronze_events(t))


def stage_bronze_events(t: Tables) -> str:
    path = scratch(t.spark, "bronze-events")
    rows = t.click_text().select("timestamp", "visitorid", "event", "itemid", F.lit("").alias("transactionid"))
    rows.write.option("header", True).csv(path)
    return path


@query
def read_item_properties(t: Tables) -> DataFrame:
    path = scratch(t.spark, "bronze-properties")
    t.item_properties().write.option("header", True).csv(path)
    return files.read_item_properties(t.spark, path)


@query
def parse_events(t: Tables) -> DataFrame:
    return wire.parse_events(wire.encode_records(t.clicks().select(*TRAFFIC_RECORD.names)))


@query
def stream_source(t: Tables) -> DataFrame:
    """Staged wire files drained by a stream with a bound per trigger."""
    staged, out = stage_wire(t), scratch(t.spark, "stream-out")
    running = (
        wire.parse_events(wire.stream_wire(t.spark, staged))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch(t.spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    pricing_job.drain(running)
    return t.spark.read.schema(TRAFFIC_RECORD).parquet(out)


@query
def encode_updates(t: Tables) -> DataFrame:
    """Price updates as keyed wire records; the payload is shown as text."""
    encoded = wire.encode_records(click_updates(t).select(*PRICE_UPDATE.names))
    return encoded.select(
        "key",
        F.hex(F.expr("substring(value, 1, 5)")).alias("frame"),
        F.expr("substring(value, 6, length(value) - 5)").cast("string").alias("payload"),
    )


@query
def tail_updates(t: Tables) -> DataFrame:
    return serving.tail_updates(click_updates(t), LAST_SEEN_MS, LAST_SEEN_ITEM)


@query
def publish_serving(t: Tables) -> DataFrame:
    return click_serving(t)


@query
def serving_lookup(t: Tables) -> DataFrame:
    """Serving rows of all items bought in the click stream."""
    wanted = silver(t).where(F.col("event") == "transaction").select("item_id")
    return serving.serving_lookup(click_serving(t), wanted)


@query
def active_skus(t: Tables) -> DataFrame:
    return serving.active_skus(live_table(t), WINDOW_LABEL)


@query
def live_serving(t: Tables) -> DataFrame:
    return serving.live_serving(click_decisions(t), WINDOW_SECONDS)


# ---------------------------------------------------------------- events


@query
def clean_events(t: Tables) -> DataFrame:
    """The stream delivered twice: duplicates must fold."""
    return events.clean_events(t.clicks().unionAll(t.clicks()))


@query
def normalize_events(t: Tables) -> DataFrame:
    return events.normalize_events(t.click_text())


@query
def reject_counts(t: Tables) -> DataFrame:
    return events.reject_counts(events.normalize_events(t.click_text()))


@query
def silver_violations(t: Tables) -> DataFrame:
    """The gate over uncleaned events."""
    return events.silver_violations(t.clicks())


@query
def first_events(t: Tables) -> DataFrame:
    return events.first_events(t.clicks(), 1000)


@query
def surge_windows(t: Tables) -> DataFrame:
    clicks = t.clicks()
    moment = events.event_timestamp(clicks)
    return clicks.select("event_id", "event_time", events.campaign_multiplier(moment, CAMPAIGNS).alias("multiplier"))


@query
def chrono_split(t: Tables) -> DataFrame:
    clicks = t.clicks()
    in_train = events.chrono_cut(clicks, 0.8, "event_time", "event_id")
    return clicks.select("event_id", "event_time", F.when(in_train, "train").otherwise("test").alias("split"))


# ---------------------------------------------------------------- demand


@query
def daily_sales(t: Tables) -> DataFrame:
    return demand.daily_sales(t.sales())


@query
def features(t: Tables) -> DataFrame:
    return demand.rolling_features(t.sales()).withColumns(
        {c: F.round(c, 6) for c in ("velocity_7d", "velocity_30d")}
    )


@query
def inventory(t: Tables) -> DataFrame:
    return demand.build_inventory(t.item_properties())


@query
def catalog_price(t: Tables) -> DataFrame:
    return demand.build_catalog_price(t.item_properties())


@query
def forecast_split(t: Tables) -> DataFrame:
    known, newest = demand.forecast_split(demand.rolling_features(t.sales()))
    return (
        known.select("item_id", "ds", F.lit("train").alias("part"))
        .unionAll(newest.select("item_id", "ds", F.lit("score").alias("part")))
    )


@query
def forecast(t: Tables) -> DataFrame:
    """Boosted-tree demand per item of the click stream."""
    return demand.train_forecast(files.write_zone(demand.rolling_features(silver(t)), scratch(t.spark, "features")))[1]


@query
def forecast_rmse(t: Tables) -> DataFrame:
    """Error of the trailing 7-day mean as next-day forecast over the sales history."""
    scored = demand.rolling_features(t.sales())
    return demand.forecast_rmse(scored, "velocity_7d").withColumn("rmse", F.round("rmse", 6))


# ---------------------------------------------------------------- affinity


@query
def co_purchase(t: Tables) -> DataFrame:
    return affinity.co_purchase(t.customer_baskets())


@query
def affinity_vertices(t: Tables) -> DataFrame:
    return affinity.affinity_vertices(order_edges(t))


@query
def pagerank(t: Tables) -> DataFrame:
    return affinity.page_rank(order_edges(t)).withColumn("pagerank", F.round("pagerank", 6))


@query
def communities(t: Tables) -> DataFrame:
    return affinity.communities(order_edges(t))


@query
def affinity_graph(t: Tables) -> DataFrame:
    graph = affinity.affinity_graph(affinity.co_purchase(t.order_baskets()))
    return graph.withColumn("pagerank", F.round("pagerank", 6))


@query
def elasticity_lists(t: Tables) -> DataFrame:
    return affinity.elasticity_lists(order_edges(t))


@query
def max_elasticity(t: Tables) -> DataFrame:
    return affinity.max_elasticity(affinity.co_purchase(t.customer_baskets()))


# ---------------------------------------------------------------- pricing


@query
def velocity_windows(t: Tables) -> DataFrame:
    return click_windows(t)


_QUERIES["velocity"] = _QUERIES.pop("velocity_windows")


@query
def sequences(t: Tables) -> DataFrame:
    history = velocity.feature_history(click_windows(t), HISTORY_TTL)
    return history.select("item_id", "window_start", F.to_json("sequence").alias("sequence"))


@query
def surge_score(t: Tables) -> DataFrame:
    history = velocity.feature_history(click_windows(t), HISTORY_TTL)
    return velocity.surge_score(history, fixed_weights()).select("item_id", "window_start", "surge_prob")


@query
def charm_price(t: Tables) -> DataFrame:
    lines = t.table("lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        pricing.charm_price(price).alias("charm_99"),
        pricing.charm_price(price, 0.95).alias("charm_95"),
        pricing.charm_price(price, 0.0).alias("charm_00"),
    )


@query
def present_price(t: Tables) -> DataFrame:
    """Each line's unit price next to the discounted one."""
    lines = t.table("lineitem")
    base = F.col("l_extendedprice") / F.col("l_quantity")
    shown = pricing.present_price(base * (F.lit(1.1) - F.col("l_discount") * F.lit(2.0)), base)
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", shown.alias("shown")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "shown.*"
    )


@query
def dynamic_price(t: Tables) -> DataFrame:
    """Quantity as velocity against a baseline, return flag as surge flag."""
    lines = t.table("lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        pricing.dynamic_price(
            F.col("l_extendedprice") / F.col("l_quantity"),
            F.col("l_quantity"),
            F.col("l_tax") * F.lit(200.0),
            F.col("l_discount") * F.lit(5.0),
            F.col("l_returnflag") == "R",
        ).alias("new_price"),
    )


@query
def surge_flag(t: Tables) -> DataFrame:
    surging = decisions.with_surge(
        decisions.with_lookups(click_windows(t), click_serving(t)), conversion_share(), WINDOW_SECONDS
    )
    return surging.select(
        "item_id", "window_start", "baseline", "window_baseline", "surge_prob", "is_surge", "uplift"
    )


@query
def price_replay(t: Tables) -> DataFrame:
    return click_decisions(t).select("item_id", "window_start", "base_price", "new_price")


@query
def price_updates(t: Tables) -> DataFrame:
    return click_updates(t)


@query
def low_stock_alerts(t: Tables) -> DataFrame:
    return click_alerts(t)


@query
def reorders(t: Tables) -> DataFrame:
    return decisions.reorders(click_alerts(t))


@query
def alert_log(t: Tables) -> DataFrame:
    return decisions.alert_log(click_alerts(t))


# ---------------------------------------------------------------- serving views


@query
def sku_universe(t: Tables) -> DataFrame:
    properties = t.item_properties()
    return serving.sku_universe(
        click_forecast(t),
        click_edges(t).withColumn("community", F.lit(None).cast("bigint")),  # names no item of its own
        demand.build_inventory(properties),
        demand.build_catalog_price(properties),
    )


@query
def seed_prices_nx(t: Tables) -> DataFrame:
    return serving.seed_prices(serving.live_serving(click_decisions(t), WINDOW_SECONDS), t.catalog())


@query
def kpi_summary(t: Tables) -> DataFrame:
    summary = serving.kpi_summary(live_table(t), WINDOW_LABEL, WINDOW_SECONDS)
    return summary.withColumns({c: F.round(c, 6) for c in ("avg_price", "total_forecast")})


@query
def forecast_vs_actual(t: Tables) -> DataFrame:
    return serving.forecast_vs_actual(live_table(t), WINDOW_LABEL)


@query
def price_snapshot(t: Tables) -> DataFrame:
    return serving.price_snapshot(live_table(t), WINDOW_LABEL)


@query
def price_ticker(t: Tables) -> DataFrame:
    ticker = serving.price_ticker(click_updates(t))
    return ticker.select("item_id", F.explode("series").alias("point"), F.size("series").alias("n_points")).select(
        "item_id", "point.event_time", "point.new_price", "n_points"
    )


# ---------------------------------------------------------------- monitoring


@query
def verify_delivery(t: Tables) -> DataFrame:
    """What reached the accepted stream of everything that was sent."""
    delivered = events.accepted(events.normalize_events(t.click_text()))
    sent = t.clicks().agg(F.count(F.lit(1))).scalar()
    return monitoring.verify_delivery(delivered, sent, F.lit(NOW_MS))


@query
def order_violations(t: Tables) -> DataFrame:
    """Order lines as arrivals: ship dates against the order number of the part's lines."""
    lines = t.table("lineitem").select(
        (F.col("l_partkey") + 1).alias("item_id"),
        F.col("l_shipdate").alias("event_time"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
    )
    return monitoring.order_violations(lines, block=10_000)


@query
def run_metrics(t: Tables) -> DataFrame:
    normalized = events.normalize_events(t.click_text())
    rejected = F.col("reject_reason").isNotNull()
    low = F.col("stock") < SPEED.reorder_threshold
    return monitoring.run_metrics(
        [
            ("ingest", normalized, {"records_processed": ~rejected, "errors": rejected}),
            (
                "pricing",
                click_decisions(t),
                {"records_processed": F.lit(True), "surge_events": F.col("is_surge"), "low_stock_alerts": low},
            ),
            ("publish", click_serving(t), {"records_processed": F.lit(True)}),
        ]
    )


# ---------------------------------------------------------------- jobs


@query
def nightly_batch(t: Tables) -> DataFrame:
    """Files to serving table; the forecast is shown as known or not, its value depends on the trees."""
    published = run_nightly(t.spark, stage_bronze(t))
    return published.select(
        "item_id", F.round("max_elasticity", 6).alias("max_elasticity"), "community", "stock", "price",
        (F.col("forecast_demand") >= 0).alias("has_forecast"),
    )


@query
def pricing_stream(t: Tables) -> DataFrame:
    """Wire files drained by the pricing job, without a trained classifier."""
    root = scratch(t.spark, "pricing")
    live = pricing_job.accepted_events(wire.stream_wire(t.spark, stage_wire(t)))
    pricing_job.drain(pricing_job.start_pricing(live, click_serving(t), root, cfg=SPEED, once=True))
    return pricing_job.committed(t.spark, root, "updates")


def scored_stream(t: Tables) -> str:
    """Root folder of the pricing job drained with a classifier."""
    root = scratch(t.spark, "scored")
    live = pricing_job.accepted_events(wire.stream_wire(t.spark, stage_wire(t)))
    pricing_job.drain(pricing_job.start_pricing(live, click_serving(t), root, fixed_weights(lean=SURGING), SPEED, once=True))
    return root


@query
def scored_pricing_stream(t: Tables) -> DataFrame:
    """Wire files drained by the pricing job with a classifier; equal to the batch form in closed windows."""
    return pricing_job.committed(t.spark, scored_stream(t), "updates")


@query
def scored_price_updates(t: Tables) -> DataFrame:
    """The whole price chain in batch form: history, score, surge, uplift, price walk."""
    accepted = pricing_job.accepted_events(wire.encode_records(t.clicks().select(*TRAFFIC_RECORD.names)))
    windows = velocity.windowed_velocity(accepted, WINDOW_SECONDS)
    history = velocity.surge_score(velocity.feature_history(windows, HISTORY_TTL), fixed_weights(lean=SURGING))
    scored = written(history.drop("sequence"), "scored")
    decided = decisions.decide_prices(scored, click_serving(t), F.col("surge_prob"), WINDOW_SECONDS)
    return decisions.update_records(decided, F.unix_millis("window_end"))


@query
def stream_orders(t: Tables) -> DataFrame:
    """Orders that the pricing job writes for the low-stock alerts of its batches."""
    return pricing_job.committed(t.spark, scored_stream(t), "orders")


@query
def stream_live(t: Tables) -> DataFrame:
    """Newest live values after all batches of the pricing job."""
    return pricing_job.current_live(t.spark, scored_stream(t)).select("item_id", "velocity", "velocity_window")


@query
def stream_rejects(t: Tables) -> DataFrame:
    """Wire records rejected by reason; every hundredth record is cut short and another one garbled."""
    path, root = scratch(t.spark, "wire"), scratch(t.spark, "rejects")
    encoded = wire.encode_records(t.clicks().select(*TRAFFIC_RECORD.names, "event_id"))
    number = F.get_json_object(F.expr("substring(value, 6)").cast("string"), "$.event_id").cast("bigint") % 100
    cut = F.when(number == 0, F.expr("substring(value, 1, 3)")).when(number == 1, F.expr("substring(value, 1, 12)"))
    encoded.withColumn("value", F.coalesce(cut, "value")).write.parquet(path)
    pricing_job.drain(pricing_job.start_rejects(wire.stream_wire(t.spark, path), root, once=True))
    rejected = t.spark.read.parquet(pricing_job.StreamPaths(root).rejects)
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def merge_serving(t: Tables) -> DataFrame:
    """A nightly publication merged into the table with live prices."""
    return serving.merge_serving(live_table(t), click_serving(t))


@query
def elasticity_lookup(t: Tables) -> DataFrame:
    """Related-item lists of all items bought in the click stream."""
    wanted = silver(t).where(F.col("event") == "transaction").select("item_id")
    return serving.elasticity_lookup(affinity.elasticity_lists(order_edges(t)), wanted)


@query
def follow_updates(t: Tables) -> DataFrame:
    """All updates of the pricing job as a checkpointed reader gets them, in two runs."""
    root, out, seen = (scratch(t.spark, name) for name in ("pricing", "followed", "reader"))
    live = pricing_job.accepted_events(wire.stream_wire(t.spark, stage_wire(t)))
    pricing_job.drain(pricing_job.start_pricing(live, click_serving(t), root, cfg=SPEED, once=True))
    for _ in range(2):
        pricing_job.drain(feeds.follow(t.spark, root, "updates", PRICE_UPDATE, out, seen, once=True))
    return feeds.followed(t.spark, out, PRICE_UPDATE)


@query
def deduplicated_stream(t: Tables) -> DataFrame:
    """Every record sent twice, interleaved, through the job that drops repeats: the updates of one delivery."""
    path, root = scratch(t.spark, "wire"), scratch(t.spark, "deduplicated")
    events = t.clicks().select(*TRAFFIC_RECORD.names).distinct()  # what the key cannot tell apart is one event
    wire.encode_records(events.unionAll(events).repartition(8, "visitor_id")).write.parquet(path)
    live = pricing_job.accepted_events(wire.stream_wire(t.spark, path))
    once = replace(SPEED, deduplicate=True)
    pricing_job.drain(pricing_job.start_pricing(live, click_serving(t), root, cfg=once, once=True))
    return pricing_job.committed(t.spark, root, "updates")


@query
def refreshed_stream(t: Tables) -> DataFrame:
    """One running job over both halves of the clicks; a version with twice the forecasts is published between them."""
    lake, root, path = Lake(scratch(t.spark, "lake")), scratch(t.spark, "refreshed"), scratch(t.spark, "wire")
    first = click_serving(t)
    publish_version(first, lake)
    known = t.clicks().select(*TRAFFIC_RECORD.names)
    early = events.event_timestamp(known) < F.lit(HALF).cast("timestamp")
    send = lambda rows: wire.encode_records(rows).coalesce(4).write.mode("append").parquet(path)
    send(known.where(early))
    live = pricing_job.accepted_events(wire.stream_wire(t.spark, path))
    versions = pricing_job.published_serving(t.spark, lake.serving("changes"))
    running = pricing_job.start_pricing(live, versions, root, cfg=SPEED, every="1 second")
    try:
        running.processAllAvailable()
        publish_version(first.withColumn("forecast_demand", F.col("forecast_demand") * 2), lake)
        send(known.where(~early))
        running.processAllAvailable()
    finally:
        running.stop()
    return pricing_job.committed(t.spark, root, "updates").select("event_time", "item_id", "velocity", "baseline")


@query
def stream_metrics(t: Tables) -> DataFrame:
    """Counters of the running job, component by component, as its listener kept them."""
    root = scratch(t.spark, "counted")
    sink = metrics.MetricsSink(t.spark, pricing_job.StreamPaths(root).metrics)
    t.spark.streams.addListener(sink)
    try:
        live = pricing_job.accepted_events(wire.stream_wire(t.spark, stage_wire(t)))
        running = pricing_job.start_pricing(live, click_serving(t), root, cfg=SPEED, once=True)
        pricing_job.drain(running)
        sink.settled(running)
    finally:
        t.spark.streams.removeListener(sink)
    return metrics.stream_metrics(t.spark, sink.path)


@query
def sales_forecast(t: Tables) -> DataFrame:
    """The forecast of the sales history held against what it must do, row by row of checks.

    The trees err less on the days they have seen than the trailing 7-day mean does, forecasts are as many as
    items, none is negative, and the stored model gives the forecasts of the fresh one.
    """
    path = scratch(t.spark, "model")
    features = files.write_zone(demand.rolling_features(t.sales()), scratch(t.spark, "features"))
    model, fresh, _ = demand.train_forecast(features, path)
    known, newest = demand.forecast_split(features)
    again = demand.score_forecast(models.load_forecast(path), newest)
    error = lambda c: F.sqrt(F.avg((F.col(c) - F.col("label")) * (F.col(c) - F.col("label"))))
    errors = model.transform(demand.model_inputs(known)).agg((error("prediction") <= error("velocity_7d")).alias("learns"))
    both = fresh.join(again.withColumnRenamed("forecast_demand", "again"), "item_id", "full")
    same = F.abs(F.col("forecast_demand") - F.col("again")) < 1e-9
    checks = both.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.coalesce(F.min(F.col("forecast_demand")) >= 0, F.lit(False)).alias("not_negative"),
        (F.count_if(same) == F.count(F.lit(1))).alias("stored_equals_fresh"),
    )
    return checks.crossJoin(F.broadcast(errors))  # one row each


@query
def campaign_join(t: Tables) -> DataFrame:
    """Clicks with the multiplier of the first of very many windows, one for each part, that holds their time."""
    clicks, parts = t.clicks(), t.table("part")
    hours = lambda n: F.make_interval(hours=n.cast("int"))
    start = F.lit("2024-01-01").cast("timestamp") + hours(F.pmod(F.col("p_partkey") * 37, F.lit(744)))
    length = F.pmod(F.col("p_partkey"), F.lit(5)) * 2 - 2  # some windows are empty, some a single moment
    windows = parts.where("p_partkey % 10 = 3 OR p_partkey % 10 = 5").select(
        F.col("p_partkey").alias("ordinal"), start.alias("start"), (start + hours(length)).alias("end"),
        (F.pmod(F.col("p_partkey"), F.lit(9)) + 2).cast("double").alias("multiplier"),
    )
    joined = events.with_campaigns(clicks, windows, events.event_timestamp(clicks))
    return joined.select("event_id", "event_time", "multiplier")


@query
def stored_models(t: Tables) -> DataFrame:
    """Classifier weights from files: a good set, one of wrong shape and none at all, with the surges that each finds."""
    paths = [scratch(t.spark, name) for name in ("weights", "misshapen", "absent")]
    good = fixed_weights(lean=SURGING)
    models.save_weights(t.spark, good, paths[0])
    models.save_weights(t.spark, good | {"w_head": good["w_head"][:, :-1]}, paths[1])
    history = written(velocity.feature_history(click_windows(t), HISTORY_TTL), "history")
    fresh = written(velocity.surge_score(history, good).select("item_id", "window_start", F.col("surge_prob").alias("fresh")), "fresh")
    found = None
    for name, path in zip(("good", "misshapen", "absent"), paths, strict=True):
        weights, report = models.load_weights(t.spark, path)
        scored = velocity.surge_score(history, weights).join(fresh, ["item_id", "window_start"])
        counts = scored.agg(
            F.count(F.lit(1)).alias("n_windows"),
            F.count_if(F.col("surge_prob") == F.col("fresh")).alias("n_equal"),
            F.count_if(F.col("surge_prob") == 0).alias("n_zero"),
        )
        state = report.where("part = 'all'").select(F.lit(name).alias("model"), "state")
        rows = state.crossJoin(F.broadcast(counts))  # one row each
        found = rows if found is None else found.unionByName(rows)
    return found
