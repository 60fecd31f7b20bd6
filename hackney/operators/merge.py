"""Trip/fare correlation: latest-per-key tables, left joins, merged record.

Batch plans
-----------
* ``latest_by_key``: ``groupBy(key).agg(max_by(struct, seq))``.  ``max_by``
  has a partial (map-side) phase, so a key holding a third of all rows is
  reduced per task before the one shuffle on ``key``.
* ``table_left_join``: both sides are latest-per-key, hence unique per key,
  so the join is 1:1 and inherits the aggregates' hash partitioning on
  ``key`` (no extra exchange; sort-merge unless AQE sees a small side).
* ``interval_left_join``: equi-join on ``(key, time bucket)`` plus the exact
  range predicate.  Each left row falls in one bucket (default width twice
  the window); each right row is copied to the buckets its +-window range
  touches (about two), so every matching pair meets exactly once, the
  sort-merge join buffers one key's rows of one bucket only, and a hot key
  is split by time.  AQE's skew-join handling splits whatever hot
  ``(key, bucket)`` remains.  The left (preserved) side is never copied, so
  an unmatched fare comes out exactly once.

Streaming plans are in :mod:`hackney.streaming.jobs`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.functions.fields import float_as_json_double
from hackney.operators.parse import FARE_AMOUNTS

# The trip/fare correlation window.
JOIN_WITHIN_SECONDS = 600

# Columns the merged record reads from each side (besides key and seq).
FARE_MERGE_COLUMNS = ["medallion", "hack_license", "vendor_id", "payment_type",
                      "pickup_datetime", *FARE_AMOUNTS]
TRIP_MERGE_COLUMNS = ["rate_code", "store_and_fwd_flag", "passenger_count",
                      "trip_time_in_secs", "trip_distance", "dropoff_datetime",
                      "pickup_location", "dropoff_location"]


def latest_by_key(df: DataFrame, key: str = "key", order: str = "seq") -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` value.

    ``order`` must be unique per key (a source offset, or the ``place`` of a
    text line); Kafka offsets are per
    partition, and a key always maps to one partition, so they qualify.
    """
    others = [c for c in df.columns if c != key]
    latest = (df.groupBy(key)
                .agg(F.max_by(F.struct(*others), F.col(order)).alias("_row")))
    return latest.select(key, *[F.col("_row")[c].alias(c) for c in others])


def _prefixed(df: DataFrame, prefix: str, key: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c == key else prefix + c) for c in df.columns])


def table_left_join(fares: DataFrame, trips: DataFrame, key: str = "key") -> DataFrame:
    """Latest fare per key LEFT JOIN latest trip per key, merged.

    Inputs are raw record streams (several rows per key allowed, ``seq``
    orders them).  Only the fields the merged record reads are carried
    through the aggregates' shuffle (a packed ``max_by`` row is opaque to
    Catalyst's column pruning).
    """
    fares = fares.select(key, "seq", *FARE_MERGE_COLUMNS)
    trips = trips.select(key, "seq", *TRIP_MERGE_COLUMNS)
    f = _prefixed(latest_by_key(fares, key), "f_", key)
    t = _prefixed(latest_by_key(trips, key), "t_", key)
    return merge_record(f.join(t, on=key, how="left"), key=key)


def interval_left_join(fares: DataFrame, trips: DataFrame, fare_time: str, trip_time: str,
                       within_seconds: int = JOIN_WITHIN_SECONDS,
                       key: str = "key", bucket_seconds: int | None = None) -> DataFrame:
    """Every fare LEFT JOIN every trip of the same key whose time lies within
    ``within_seconds`` of the fare's (both ends included), merged.

    ``fare_time``/``trip_time`` name timestamp columns of the inputs; they
    come out as ``fare_ts``/``trip_ts``.  ``bucket_seconds`` (default twice
    the window) trades trip copies in the shuffle against how finely a hot
    key is split by time.
    """
    b_us = (bucket_seconds or 2 * within_seconds) * 1_000_000
    w_us = within_seconds * 1_000_000
    f = _prefixed(fares, "f_", key)
    t = _prefixed(trips, "t_", key)
    ft, tt = F.col("f_" + fare_time), F.col("t_" + trip_time)
    f = f.withColumn("_bucket", F.floor(F.unix_micros(ft) / F.lit(b_us)))
    lo = F.floor((F.unix_micros(tt) - F.lit(w_us)) / F.lit(b_us))
    hi = F.floor((F.unix_micros(tt) + F.lit(w_us)) / F.lit(b_us))
    t = (t.withColumn("_t_bucket", F.explode(F.sequence(lo, hi)))
          .withColumnRenamed(key, "_t_key"))
    span = F.make_dt_interval(secs=F.lit(within_seconds))
    cond = ((F.col(key) == F.col("_t_key")) & (F.col("_bucket") == F.col("_t_bucket"))
            & tt.between(ft - span, ft + span))
    joined = f.join(t, cond, "left")
    return merge_record(joined, key=key,
                        extra=[ft.alias("fare_ts"), tt.alias("trip_ts")])


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def merge_record(joined: DataFrame, key: str = "key",
                 extra: list[Column] | None = None) -> DataFrame:
    """Build the trip+fare record from ``f_``/``t_`` prefixed columns.

    Fare fields are always present (amounts as DOUBLE, 0 when missing).
    Trip fields, and the pickup time, are filled only when a trip matched.
    Trip FLOAT values come out as the DOUBLE they read back as after JSON.
    An empty dropoff array gives ``[NULL, NULL]``.
    """
    matched = F.col("t_seq").isNotNull()
    pl, dl = F.col("t_pickup_location"), F.col("t_dropoff_location")

    def point(loc: Column) -> Column:
        return F.array(float_as_json_double(F.get(loc, 0)),
                       float_as_json_double(F.get(loc, 1)))

    cols = [
        F.col(key),
        F.col("f_seq").alias("fare_seq"),
        F.col("t_seq").alias("trip_seq"),
        F.col("f_medallion").alias("medallion"),
        F.col("f_hack_license").alias("hack_license"),
        _text(F.col("f_vendor_id")).alias("vendor_id"),
        _text(F.col("f_payment_type")).alias("payment_type"),
        *[F.coalesce(F.col("f_" + a).cast("double"), F.lit(0.0)).alias(a) for a in FARE_AMOUNTS],
        F.when(matched, _text(F.col("t_rate_code"))).alias("rate_code"),
        F.when(matched, _text(F.col("t_store_and_fwd_flag"))).alias("store_and_fwd_flag"),
        F.when(matched, F.coalesce(F.col("t_passenger_count"), F.lit(0))).alias("passenger_count"),
        F.when(matched, F.coalesce(F.col("t_trip_time_in_secs"), F.lit(0).cast("bigint")))
         .alias("trip_time_in_secs"),
        F.when(matched, F.coalesce(float_as_json_double(F.col("t_trip_distance")), F.lit(0.0)))
         .alias("trip_distance"),
        F.when(matched, F.col("f_pickup_datetime")).alias("pickup_datetime"),
        F.when(matched, F.col("t_dropoff_datetime")).alias("dropoff_datetime"),
        F.when(matched, point(pl)).alias("pickup_location"),
        F.when(matched, point(dl)).alias("dropoff_location"),
    ]
    return joined.select(*cols, *(extra or []))
