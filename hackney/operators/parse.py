"""Raw line -> typed trip / fare record (narrow, no shuffle).

Each function keeps the input's other columns (``seq``, ``ts``, Kafka
metadata...) and adds the record fields plus the correlation ``key``.
Invalid lines are dropped; nothing here can fail a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.functions.fields import (FARE_PICKUP_FIELD, TRIP_PICKUP_FIELD, field,
                                      key_of, minute_key, parse_decimal, parse_float,
                                      parse_int, parse_time, seconds_between,
                                      split_fields)

TRIP_COLUMNS = ["medallion", "hack_license", "vendor_id", "rate_code",
                "store_and_fwd_flag", "pickup_datetime", "dropoff_datetime",
                "passenger_count", "trip_time_in_secs", "trip_distance",
                "pickup_location", "dropoff_location"]
FARE_AMOUNTS = ["fare_amount", "surcharge", "mta_tax", "tip_amount",
                "tolls_amount", "total_amount"]
FARE_COLUMNS = ["medallion", "hack_license", "vendor_id", "pickup_datetime",
                "payment_type"] + FARE_AMOUNTS

_FIELDS = "_fields"


def _empty_point() -> Column:
    return F.array().cast(T.ArrayType(T.FloatType()))


def with_fields(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Replace the text column by its split fields (array column ``_fields``).

    The split goes through a one-row generator: predicates on parsed fields
    cannot be pushed below it, so the split is evaluated once per line
    instead of being re-inlined into every pushed-down predicate (which also
    keeps the generated code under the JVM's 64 KB method limit).
    """
    keep = [c for c in lines.columns if c != line_col]
    return lines.select(*keep, F.explode(F.array(split_fields(F.col(line_col)))).alias(_FIELDS))


def _keep(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != _FIELDS]


def _typed(df: DataFrame, cols: list[Column]) -> DataFrame:
    """Evaluate ``cols`` once per row behind a one-row generator.

    Without it, a later filter on these columns would be pushed below the
    projection with every parse expression inlined, so each regex check and
    time parse would run twice per line.
    """
    return df.select(*_keep(df), F.inline(F.array(F.struct(*cols))))


def parse_trips(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Trip lines to refined trip records.

    A line is kept when it has 12 fields (no dropoff) or at least 14, both
    times parse, and passenger count and all coordinates parse.  The trip
    duration is recomputed from the two times (the file's own field 8 is
    ignored).  Adds ``pickup_ts``/``dropoff_ts`` timestamps.
    """
    df = with_fields(lines, line_col)
    f = F.col(_FIELDS)
    t = _typed(df, [
        F.size(f).alias("_n"),
        field(f, 0).alias("medallion"),
        field(f, 1).alias("hack_license"),
        field(f, 2).alias("vendor_id"),
        field(f, 3).alias("rate_code"),
        field(f, 4).alias("store_and_fwd_flag"),
        field(f, 5).alias("pickup_datetime"),
        field(f, 6).alias("dropoff_datetime"),
        parse_int(field(f, 7)).alias("passenger_count"),
        parse_float(field(f, 9)).alias("trip_distance"),
        parse_float(field(f, 10)).alias("_plon"),
        parse_float(field(f, 11)).alias("_plat"),
        parse_float(field(f, 12)).alias("_dlon"),
        parse_float(field(f, 13)).alias("_dlat"),
        parse_time(field(f, 5)).alias("pickup_ts"),
        parse_time(field(f, 6)).alias("dropoff_ts"),
    ])
    t = t.withColumn("key", key_of(F.col("medallion"), F.col("hack_license"),
                                   F.col("pickup_ts")))
    n = F.col("_n")
    has_dropoff = n > 12
    valid = ((n >= 12) & (n != 13) & F.col("pickup_ts").isNotNull()
             & F.col("dropoff_ts").isNotNull() & F.col("passenger_count").isNotNull()
             & F.col("trip_distance").isNotNull() & F.col("_plon").isNotNull()
             & F.col("_plat").isNotNull()
             & (~has_dropoff | (F.col("_dlon").isNotNull() & F.col("_dlat").isNotNull())))
    passthrough = [c for c in lines.columns if c != line_col]
    return t.where(valid).select(
        *passthrough, "key", "medallion", "hack_license", "vendor_id", "rate_code",
        "store_and_fwd_flag", "pickup_datetime", "dropoff_datetime", "passenger_count",
        seconds_between(F.col("pickup_ts"), F.col("dropoff_ts")).alias("trip_time_in_secs"),
        "trip_distance",
        F.array("_plon", "_plat").alias("pickup_location"),
        F.when(has_dropoff, F.array("_dlon", "_dlat")).otherwise(_empty_point())
         .alias("dropoff_location"),
        "pickup_ts", "dropoff_ts")


def parse_fares(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Fare lines to refined fare records.

    A line is kept when it has at least 11 fields and all six amounts are
    plain decimal text (held as DECIMAL(38,10)).  The pickup time is not
    checked; when it does not parse the key ends in ``-`` and ``pickup_ts``
    is NULL.
    """
    df = with_fields(lines, line_col)
    f = F.col(_FIELDS)
    t = _typed(df, [
        F.size(f).alias("_n"),
        field(f, 0).alias("medallion"),
        field(f, 1).alias("hack_license"),
        field(f, 2).alias("vendor_id"),
        field(f, 3).alias("pickup_datetime"),
        field(f, 4).alias("payment_type"),
        *[parse_decimal(field(f, 5 + i)).alias(name) for i, name in enumerate(FARE_AMOUNTS)],
        parse_time(field(f, 3)).alias("pickup_ts"),
    ])
    t = t.withColumn("key", key_of(F.col("medallion"), F.col("hack_license"),
                                   F.col("pickup_ts")))
    valid = F.col("_n") >= 11
    for name in FARE_AMOUNTS:
        valid = valid & F.col(name).isNotNull()
    passthrough = [c for c in lines.columns if c != line_col]
    return t.where(valid).select(*passthrough, "key", *FARE_COLUMNS, "pickup_ts")


def line_keys(lines: DataFrame, pickup_field: int, line_col: str = "value") -> DataFrame:
    """Correlation key of every line long enough to have one."""
    df = with_fields(lines, line_col)
    f = F.col(_FIELDS)
    return (df.where(F.size(f) > pickup_field)
              .select(*_keep(df), minute_key(f, pickup_field).alias("key")))


def gate_lines(lines: DataFrame, kind: str, line_col: str = "value") -> DataFrame:
    """Keep lines whose pickup field parses; add it as ``event_ts``.

    This is the replay gate: headers and lines with a bad pickup time never
    enter the stream.  ``kind`` is ``"trip"`` or ``"fare"``.
    """
    idx = TRIP_PICKUP_FIELD if kind == "trip" else FARE_PICKUP_FIELD
    ts = parse_time(field(split_fields(F.col(line_col)), idx))
    once = lines.select(*lines.columns, F.inline(F.array(F.struct(ts.alias("event_ts")))))
    return once.where(F.col("event_ts").isNotNull())


def field_profile(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Field count and first/last field of every line (split check)."""
    df = with_fields(lines, line_col)
    f = F.col(_FIELDS)
    return df.select(*_keep(df), F.size(f).alias("n_fields"),
                     field(f, 0).alias("first_field"),
                     F.try_element_at(f, F.lit(-1)).alias("last_field"))

