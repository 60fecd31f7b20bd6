"""Index-document shapes for refined trips and fares.

The document index maps trip fields to keyword / date / integer / float /
geo_point and fare amounts to float.  These functions project records to
exactly those fields; :func:`hackney.streaming.services.write_documents` ships
them.  A document's id is its record's topic, partition and offset, so a record
delivered again replaces its document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.functions.fields import parse_time
from hackney.operators.parse import FARE_AMOUNTS

# Index names and document types.
TRIP_INDEX = "nyc_tlc_trips"
FARE_INDEX = "nyc_tlc_fares"
TRIP_DOC_TYPE = "trip"
FARE_DOC_TYPE = "fare"


def document_id(topic: str, partition: str = "partition", offset: str = "seq") -> Column:
    """``topic+partition+offset`` of a record: the same at every delivery."""
    return F.concat_ws("+", F.lit(topic), F.col(partition).cast("string"), F.col(offset).cast("string"))


def trip_documents(trips: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Mapped trip fields; ``geo_point`` as ``[lon, lat]``, NULL when absent.
    ``keep`` names further columns (the document id)."""
    def geo(c):
        return F.when(F.size(c) == 2, c.cast("array<float>"))
    return trips.select(
        *keep, "medallion", "hack_license", "vendor_id", "rate_code", "store_and_fwd_flag",
        "pickup_datetime", "dropoff_datetime",
        F.col("passenger_count").cast("int").alias("passenger_count"),
        # integer field: a duration beyond INT range (two far-apart dates on a
        # bad line) becomes NULL instead of failing the task
        F.col("trip_time_in_secs").try_cast("int").alias("trip_time_in_secs"),
        F.col("trip_distance").cast("float").alias("trip_distance"),
        geo(F.col("pickup_location")).alias("pickup_location"),
        geo(F.col("dropoff_location")).alias("dropoff_location"))


def fare_documents(fares: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Mapped fare fields, amounts as FLOAT.  The pickup time is a date field
    of the index, so a text that is no time becomes NULL."""
    pickup = F.col("pickup_datetime")
    return fares.select(
        *keep, "medallion", "hack_license", "vendor_id",
        F.when(parse_time(pickup).isNotNull(), pickup).alias("pickup_datetime"), "payment_type",
        *[F.col(a).cast("float").alias(a) for a in FARE_AMOUNTS])
