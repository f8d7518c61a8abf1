"""Keyed wire records: 5 framing bytes before the payload, key = item id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.config import SpeedConfig
from retailflow.schemas import TRAFFIC_RECORD

# One magic byte and a four-byte schema id.
FRAME_BYTES = 5
JSON_FRAME = "0000000000"

WIRE_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])

_SPEED = SpeedConfig()


def _payload():
    return F.expr(f"substring(value, {FRAME_BYTES + 1}, length(value) - {FRAME_BYTES})")


def decode_records(raw: DataFrame, schema: T.StructType = TRAFFIC_RECORD, avro_schema: str | None = None) -> DataFrame:
    """Columns of ``schema``, the raw ``value`` and ``reject_reason`` of every wire record.

    Payloads are JSON, or Avro where the Avro package is on the class path. A record shorter than its
    frame or with a payload that does not decode keeps its bytes and a reason; others have no reason.
    """
    if avro_schema is None:
        corrupt = "_corrupt_record"
        wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        record = F.from_json(_payload().cast("string"), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
        broken = F.col("record").isNull() | F.col(f"record.{corrupt}").isNotNull()
    else:
        from pyspark.sql.avro.functions import from_avro

        record = from_avro(_payload(), avro_schema, {"mode": "PERMISSIVE"})
        broken = F.col("record").isNull()
    empty = F.forall(F.array(*[F.col(f"record.{c}").isNull() for c in schema.names]), lambda x: x)
    short = F.coalesce(F.length("value"), F.lit(0)) <= FRAME_BYTES
    reason = F.when(short, "short_frame").when(broken | empty, "bad_payload")
    decoded = raw.select("value", record.alias("record")).withColumn("reject_reason", reason)
    columns = [F.when(F.col("reject_reason").isNull(), F.col(f"record.{c}")).alias(c) for c in schema.names]
    return decoded.select(*columns, "value", "reject_reason")


def parse_events(raw: DataFrame, schema: T.StructType = TRAFFIC_RECORD, avro_schema: str | None = None) -> DataFrame:
    """Typed columns of the wire records that decode."""
    return decode_records(raw, schema, avro_schema).where("reject_reason IS NULL").select(*schema.names)


def encode_records(records: DataFrame, avro_schema: str | None = None) -> DataFrame:
    """[key, value] of a keyed topic, partitioned by item."""
    row = F.struct(*records.columns)
    if avro_schema is None:
        payload = F.to_json(row).cast("binary")
    else:
        from pyspark.sql.avro.functions import to_avro

        payload = to_avro(row, avro_schema)
    return records.select(
        F.col("item_id").cast("string").alias("key"),
        F.concat(F.unhex(F.lit(JSON_FRAME)), payload).alias("value"),
    )


def read_wire(spark: SparkSession, path: str) -> DataFrame:
    """Bounded read of staged wire files."""
    return spark.read.schema(WIRE_SCHEMA).parquet(path)


def stream_wire(spark: SparkSession, path: str, max_files: int = _SPEED.max_files_per_trigger) -> DataFrame:
    """Unbounded read of staged wire files with a bound per trigger."""
    return (
        spark.readStream.schema(WIRE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)
    )


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    from_start: bool = False,
    max_records: int = _SPEED.max_records_per_trigger,
) -> DataFrame:
    """Unbounded read of a Kafka topic; needs the Kafka package on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest" if from_start else "latest")
        .option("maxOffsetsPerTrigger", max_records)
        .load()
    )


def write_topic(encoded: DataFrame, servers: str, topic: str) -> None:
    """Write keyed records to a Kafka topic; needs the Kafka package on the class path."""
    (
        encoded.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "lz4")
        .option("topic", topic)
        .save()
    )
