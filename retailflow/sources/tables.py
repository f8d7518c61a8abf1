"""Domain frames over the star-schema test tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.functions.numeric import round2


@dataclass(frozen=True)
class Tables:
    """Events become the click stream, order lines the sales and property history, parts the catalogue."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def clicks(self) -> DataFrame:
        """Raw stream records with the arrival number; views carry no price."""
        kind = F.col("event_type")
        return self.table("events").select(
            "event_id",
            F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time"),
            F.col("user_id").alias("visitor_id"),
            F.when(kind == "click", "addtocart")
            .when(kind == "purchase", "transaction")
            .otherwise(kind)
            .alias("event"),
            F.get_json_object("props", "$.k").try_cast("bigint").alias("item_id"),
            F.when(kind != "view", F.col("value")).alias("price"),
        )

    def click_text(self) -> DataFrame:
        """The same rows as the text columns of a click file."""
        return self.clicks().select(
            "event_id",
            F.col("event_time").cast("string").alias("timestamp"),
            F.col("visitor_id").cast("string").alias("visitorid"),
            "event",
            F.col("item_id").cast("string").alias("itemid"),
            F.coalesce(F.col("price").cast("string"), F.lit("")).alias("price"),
        )

    def sales(self) -> DataFrame:
        """One transaction per order line, without the buyer."""
        return self.table("lineitem").select(
            F.col("l_shipdate").cast("timestamp").alias("event_time"),
            F.col("l_orderkey").alias("order_id"),
            F.lit("transaction").alias("event"),
            (F.col("l_partkey") + 1).alias("item_id"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        )

    def customer_baskets(self) -> DataFrame:
        """[visitor_id, item_id] of everything a customer ever bought.

        Joined by shuffle: the size of the orders' file says little about their rows in memory, which would all
        pass through the driver if they were broadcast.
        """
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias("visitor_id")).hint("merge")
        lines = self.table("lineitem").select("l_orderkey", (F.col("l_partkey") + 1).alias("item_id"))
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("visitor_id", "item_id")

    def order_baskets(self) -> DataFrame:
        """[visitor_id, item_id] with the order as the basket: a sparse graph."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("visitor_id"), (F.col("l_partkey") + 1).alias("item_id")
        )

    def item_properties(self) -> DataFrame:
        """Property history as text: unit price and availability at each shipment."""
        lines = self.table("lineitem")
        stamp = F.unix_millis(F.col("l_shipdate").cast("timestamp")).cast("string").alias("timestamp")
        item = (F.col("l_partkey") + 1).cast("string").alias("itemid")
        unit_price = round2(F.col("l_extendedprice") / F.col("l_quantity"))
        price = lines.select(
            stamp, item, F.lit("790").alias("property"), F.concat(F.lit("n"), unit_price.cast("string")).alias("value")
        )
        available = lines.select(
            stamp,
            item,
            F.lit("available").alias("property"),
            F.when(F.col("l_returnflag") == "R", "0").otherwise("1").alias("value"),
        )
        return price.unionAll(available)

    def catalog(self) -> DataFrame:
        return self.table("part").select(
            (F.col("p_partkey") + 1).alias("item_id"), F.col("p_retailprice").alias("catalog_price")
        )
