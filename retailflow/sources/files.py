"""CSV bronze files and Parquet zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.functions.numeric import as_long
from retailflow.schemas import BRONZE_EVENTS, BRONZE_ITEM_PROPERTIES


def read_bronze_events(spark: SparkSession, path: str) -> DataFrame:
    """Click files (header, all text) under contract names; text that is no number turns NULL."""
    raw = spark.read.schema(BRONZE_EVENTS).option("header", True).option("enforceSchema", False).csv(path)
    return raw.select(
        as_long("timestamp").alias("event_time"),
        as_long("visitorid").alias("visitor_id"),
        "event",
        as_long("itemid").alias("item_id"),
    )


def read_item_properties(spark: SparkSession, path: str) -> DataFrame:
    """A folder of property history parts, all text."""
    return spark.read.schema(BRONZE_ITEM_PROPERTIES).option("header", True).csv(path)


def write_zone(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a Parquet table and read it back, which also ends the lineage of what follows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
