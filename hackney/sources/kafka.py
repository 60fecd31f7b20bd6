"""Kafka topic frames: JSON values with string keys, integer values.

The Kafka connector jar is not bundled here; these helpers build and read
the ``(key, value)`` frames the ``kafka`` source/sink use, so jobs run the
same on a topic or on files.  ``read_topic`` / ``write_topic`` wrap the
connector for clusters that have it on the class path.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Topic names.
RAW_TRIP_TOPIC = "trips-raw-stream-topic"
RAW_FARE_TOPIC = "fares-raw-stream-topic"
REFINED_TRIP_TOPIC = "trips-refined-stream-topic"
REFINED_FARE_TOPIC = "fares-refined-stream-topic"
MERGED_TRIP_FARES_TOPIC = "trips-fares-join-topic"
TRENDING_PICKUP_GRID_TOPIC = "trending-pickup-grid-topic"
DRIVER_PAYMENT_STATEMENT_TOPIC = "driver-payment-statement-topic"
DRIVER_PAYMENT_SUMMARY_TOPIC = "driver-payment-summary-topic"

# Topics that hold the changes of a table: the last record of a key counts.
CHANGELOG_TOPICS = (MERGED_TRIP_FARES_TOPIC, TRENDING_PICKUP_GRID_TOPIC, DRIVER_PAYMENT_SUMMARY_TOPIC)

_S, _D = T.StringType(), T.DoubleType()

# What a record carries besides key and value: columns of folder topics, headers
# (as text) of Kafka records.  ``txn`` names what the record was made from, so a
# record written twice is known; ``batch_id`` is the micro-batch that wrote it.
META_SCHEMA = T.StructType([
    T.StructField("txn", _S), T.StructField("batch_id", T.LongType()),
    T.StructField("fare_seq", T.LongType()), T.StructField("trip_seq", T.LongType()),
    T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType())])

# Refined trip as read back from JSON: numbers as the JSON reader sees them.
REFINED_TRIP_SCHEMA = T.StructType([
    T.StructField("medallion", _S), T.StructField("hack_license", _S),
    T.StructField("vendor_id", _S), T.StructField("rate_code", _S),
    T.StructField("store_and_fwd_flag", _S), T.StructField("pickup_datetime", _S),
    T.StructField("dropoff_datetime", _S), T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_time_in_secs", T.LongType()), T.StructField("trip_distance", _D),
    T.StructField("pickup_location", T.ArrayType(_D)),
    T.StructField("dropoff_location", T.ArrayType(_D)),
])

REFINED_FARE_SCHEMA = T.StructType(
    [T.StructField(c, _S) for c in ("medallion", "hack_license", "vendor_id",
                                    "pickup_datetime", "payment_type")]
    + [T.StructField(c, T.DecimalType(38, 10)) for c in
       ("fare_amount", "surcharge", "mta_tax", "tip_amount", "tolls_amount", "total_amount")])

STATEMENT_SCHEMA = T.StructType([
    T.StructField("hack_license", _S), T.StructField("pickup_datetime", _S),
    T.StructField("total_amount", _D), T.StructField("payable_amount", _D)])


MERGED_SCHEMA = T.StructType(
    [T.StructField(c, _S) for c in ("medallion", "hack_license", "vendor_id", "payment_type")]
    + [T.StructField(c, _D) for c in ("fare_amount", "surcharge", "mta_tax", "tip_amount", "tolls_amount", "total_amount")]
    + [T.StructField("rate_code", _S), T.StructField("store_and_fwd_flag", _S),
       T.StructField("passenger_count", T.IntegerType()), T.StructField("trip_time_in_secs", T.LongType()),
       T.StructField("trip_distance", _D), T.StructField("pickup_datetime", _S), T.StructField("dropoff_datetime", _S),
       T.StructField("pickup_location", T.ArrayType(_D)), T.StructField("dropoff_location", T.ArrayType(_D))])


def to_kafka_frame(df: DataFrame, key_col: str | None, value_cols: Iterable[str],
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``key`` (string, ``""`` when ``key_col`` is None) and JSON ``value``."""
    key: Column = F.col(key_col).cast("string") if key_col else F.lit("")
    return df.select(*keep, key.alias("key"),
                     F.to_json(F.struct(*value_cols)).alias("value"))


def from_kafka_json(frame: DataFrame, schema: T.StructType,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode the JSON ``value`` (string or bytes) into top-level columns;
    ``key`` is kept as a string."""
    rec = F.from_json(F.col("value").cast("string"), schema)
    return frame.select(*keep, F.col("key").cast("string").alias("key"),
                        rec.alias("_rec")).select(*keep, "key", "_rec.*")


def to_int_frame(df: DataFrame, key_col: str = "key", value_col: str = "value",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``(key, value)`` as 4-byte big-endian integers, the integer-serde
    form (negative values in two's complement)."""
    def four(c):
        h = F.lpad(F.hex(c.cast("int").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")
        return F.unhex(h)
    return df.select(four(F.col(key_col)).alias("key"), four(F.col(value_col)).alias("value"), *keep)


def with_headers(frame: DataFrame) -> DataFrame:
    """``key, value, headers``: the frame's `META_SCHEMA` columns as headers, a
    null one left out."""
    held = [F.struct(F.lit(c).alias("key"), F.col(c).cast("string").cast("binary").alias("value"))
            for c in META_SCHEMA.names if c in frame.columns]
    if not held:
        return frame.select("key", "value")
    return frame.select("key", "value", F.filter(F.array(*held), lambda h: h["value"].isNotNull()).alias("headers"))


def from_headers(frame: DataFrame) -> DataFrame:
    """``frame`` with its ``headers`` as `META_SCHEMA` columns (null if absent;
    of several headers of a name the first counts)."""
    def header(name: str, kind: T.DataType) -> Column:
        held = F.get(F.filter("headers", lambda h: h["key"] == name), 0)["value"]
        return held.cast("string").cast(kind).alias(name)
    others = [c for c in frame.columns if c != "headers"]
    return frame.select(*others, *(header(f.name, f.dataType) for f in META_SCHEMA.fields))


def read_topic(spark: SparkSession, servers: str, topic: str, stream: bool = True,
               starting_offsets: str = "earliest",
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """``seq`` (offset), ``ts`` (record time), ``partition``, ``key``, ``value``
    as strings, and the `META_SCHEMA` columns from the headers.  An offset is
    unique within its partition only.

    ``max_offsets_per_trigger`` bounds a micro-batch, so catching up on a
    large backlog from ``earliest`` proceeds in sized steps.
    """
    reader = spark.readStream if stream else spark.read
    reader = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
                    .option("subscribe", topic).option("startingOffsets", starting_offsets)
                    .option("includeHeaders", "true"))
    if stream and max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    df = reader.load()
    return from_headers(df.select(F.col("offset").alias("seq"), F.col("timestamp").alias("ts"), "partition",
                                  F.col("key").cast("string").alias("key"),
                                  F.col("value").cast("string").alias("value"), "headers"))


def write_topic(frame: DataFrame, servers: str, topic: str, checkpoint: str | None = None,
                output_mode: str = "append", trigger: dict | None = None):
    """Write a ``(key, value)`` frame to a topic (batch or streaming)."""
    if not frame.isStreaming:
        (frame.write.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("topic", topic).save())
        return None
    w = (frame.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("topic", topic).option("checkpointLocation", checkpoint)
              .outputMode(output_mode))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
