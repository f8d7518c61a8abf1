"""The nightly batch: bronze to silver to gold to the serving table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.operators.affinity import affinity_graph, co_purchase, elasticity_lists
from retailflow.operators.demand import (
    build_catalog_price,
    build_inventory,
    forecast_split,
    rolling_features,
    score_forecast,
    train_forecast,
)
from retailflow.operators.events import clean_events, validate_silver
from retailflow.operators.serving import merge_serving, publish_serving
from retailflow.paths import Lake
from retailflow.sources.files import read_bronze_events, read_item_properties, write_zone
from retailflow.sources.models import load_forecast

Forecaster = Callable[[DataFrame, Lake], DataFrame]


def boosted_forecast(features: DataFrame, lake: Lake) -> DataFrame:
    """Forecasts of the boosted trees; the model and its report are kept in the gold zone."""
    _, forecasts, report = train_forecast(features, lake.gold("forecast_model"))
    write_zone(report, lake.gold("forecast_report"))
    return forecasts


def stored_forecast(features: DataFrame, lake: Lake) -> DataFrame:
    """Forecasts by the model that an earlier run kept in the gold zone; nothing is trained."""
    return score_forecast(load_forecast(lake.gold("forecast_model")), forecast_split(features)[1])


def run_nightly(
    spark: SparkSession,
    lake: Lake,
    forecaster: Forecaster = boosted_forecast,
) -> DataFrame:
    """Run all stages over ``lake`` and return the newly published version of the serving table.

    The version before it, if there is one, is merged in and left as it is, so a failed run or an open
    reader loses nothing.

    Every stage writes its table and the next one reads it, so a lost executor costs one stage. The
    quality gate stands between silver and everything derived from it.
    """
    bronze = read_bronze_events(spark, lake.bronze("events"))
    silver = write_zone(clean_events(bronze), lake.silver("events_cleaned"))
    validate_silver(silver)

    features = write_zone(rolling_features(silver), lake.gold("features"))
    forecast = write_zone(forecaster(features, lake), lake.gold("forecast"))

    bought = silver.where(F.col("event") == "transaction").select("visitor_id", "item_id")
    edges = write_zone(co_purchase(bought), lake.gold("co_purchase"))
    graph = write_zone(affinity_graph(edges), lake.gold("product_graph"))
    write_zone(elasticity_lists(graph), lake.gold("elasticity_lists"))

    properties = read_item_properties(spark, lake.bronze("item_properties"))
    inventory = write_zone(build_inventory(properties), lake.gold("inventory"))
    prices = write_zone(build_catalog_price(properties), lake.gold("pricing"))

    published = publish_serving(forecast, graph, inventory, prices)
    existing = current_serving(spark, lake)
    if existing is not None:
        published = merge_serving(existing, published)
    return publish_version(published, lake)


def publish_version(rows: DataFrame, lake: Lake) -> DataFrame:
    """Write a new version of the serving table, then name it in the list of published versions.

    Last its rows go to the changes, which running pricing jobs follow.
    """
    spark = rows.sparkSession
    known = published_versions(spark, lake)
    number = 1 if known is None else known.agg(F.max("number")).first()[0] + 1
    version = f"v{number}-{uuid.uuid4().hex}"
    written = write_zone(rows, lake.serving(version))
    entry = spark.range(1).select(F.lit(number).alias("number"), F.lit(version).alias("version"))
    entry.coalesce(1).write.mode("append").parquet(lake.serving("published"))
    written.withColumn("number", F.lit(number).cast("long")).write.mode("append").parquet(lake.serving("changes"))
    return written


def published_versions(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """[number, version] of all complete versions; None before the first."""
    try:
        return spark.read.parquet(lake.serving("published"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_serving(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """The newest complete version of the serving table."""
    known = published_versions(spark, lake)
    if known is None:
        return None
    version = known.agg(F.max_by("version", F.struct("number", "version"))).first()[0]
    return spark.read.parquet(lake.serving(version))
