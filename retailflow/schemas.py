"""Fixed table and record schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The contract's enumerations.
EVENT_TYPES = ("view", "addtocart", "transaction")

# Property codes of the item property history.
PROPERTY_AVAILABLE = "available"
PROPERTY_PRICE = "790"

SILVER_COLUMNS = ("event_time", "visitor_id", "event", "item_id", "price")

BRONZE_EVENTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("timestamp", "visitorid", "event", "itemid", "transactionid")]
)

BRONZE_ITEM_PROPERTIES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("timestamp", "itemid", "property", "value")]
)

TRAFFIC_RECORD = T.StructType(
    [
        T.StructField("event_time", T.LongType()),
        T.StructField("visitor_id", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
    ]
)

PRICE_UPDATE = T.StructType(
    [
        T.StructField("event_time", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("base_price", T.DoubleType()),
        T.StructField("new_price", T.DoubleType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("baseline", T.DoubleType()),
        T.StructField("surge_prob", T.DoubleType()),
        T.StructField("reason", T.StringType()),
    ]
)

SERVING = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("forecast_demand", T.DoubleType()),
        T.StructField("max_elasticity", T.DoubleType()),
        T.StructField("community", T.LongType()),
        T.StructField("stock", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("velocity_window", T.StringType()),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("event_time", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("stock_level", T.IntegerType()),
        T.StructField("reorder_threshold", T.IntegerType()),
        T.StructField("message", T.StringType()),
    ]
)

ORDER = T.StructType(
    [
        T.StructField("event_time", T.LongType()),
        T.StructField("sku", T.LongType()),
        T.StructField("qty", T.IntegerType()),
        T.StructField("supplier_email", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)
