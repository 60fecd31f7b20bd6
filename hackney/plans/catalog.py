"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL).

Every builder takes ``(spark, sf_dir)``, reads the given tables (raw lines
are derived from ``events``) and returns a lazy DataFrame.  Output columns
are aliased identically in the oracle text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.operators import merge, parse, payments, routes, trending
from hackney.plans import oracle as O
from hackney.sources import fixtures

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_trips(fixtures.trip_lines(spark, sf_dir))


def fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_fares(fixtures.fare_lines(spark, sf_dir))


# --------------------------------------------------------------------------
# Trending pickup grid (hopping windows)

@register("trending_pickup_grid", O.with_ctes(
    "select window_start, window_end, grid_id, count(*) as pickups from "
    + O.hopping("grid_id", "(select ts, grid_id from cells where grid_id > -1)", "ts",
                O.MINUTE_US, 5 * O.MINUTE_US)
    + " group by window_start, window_end, grid_id"))
def q_trending_pickup_grid(spark, sf_dir):
    return trending.trending(trips(spark, sf_dir), time_col="ts")


@register("trending_pickup_grid_daily", O.with_ctes(
    "select window_start, window_end, grid_id, count(*) as pickups from "
    + O.hopping("grid_id", "(select ts, grid_id from cells where grid_id > -1)", "ts",
                6 * O.HOUR_US, O.DAY_US)
    + " group by window_start, window_end, grid_id"))
def q_trending_pickup_grid_daily(spark, sf_dir):
    return trending.trending(trips(spark, sf_dir), time_col="ts",
                             window="1 day", slide="6 hours")


@register("trending_pickup_grid_pickup_time", O.with_ctes(
    "select window_start, window_end, grid_id, count(*) as pickups from "
    + O.hopping("grid_id", "(select t.pu_ts, c.grid_id from cells c join trips t on c.seq = t.seq "
                "where c.grid_id > -1)", "pu_ts", O.MINUTE_US, 5 * O.MINUTE_US)
    + " group by window_start, window_end, grid_id"))
def q_trending_pickup_grid_pickup_time(spark, sf_dir):
    """Backfill time base: windows on the parsed pickup time, not record time."""
    return trending.trending(trips(spark, sf_dir), time_col="pickup_ts")


@register("trending_grid_kv", O.with_ctes(
    "select grid_id as key, cast(count(*) as integer) as value from "
    + O.hopping("grid_id", "(select ts, grid_id from cells where grid_id > -1)", "ts",
                O.MINUTE_US, 5 * O.MINUTE_US)
    + " group by window_start, window_end, grid_id"))
def q_trending_grid_kv(spark, sf_dir):
    return trending.as_key_value(trending.trending(trips(spark, sf_dir), time_col="ts"))


@register("pickup_cells", O.with_ctes(
    "select seq, key, grid_id from cells where grid_id > -1"))
def q_pickup_cells(spark, sf_dir):
    return trending.pickup_cells(trips(spark, sf_dir), keep=("seq", "key"))


# --------------------------------------------------------------------------
# Raw lines, keys, refined records

def _both_lines(spark, sf_dir, fn_trip, fn_fare):
    t = fn_trip(fixtures.trip_lines(spark, sf_dir)).withColumn("kind", F.lit("trip"))
    f = fn_fare(fixtures.fare_lines(spark, sf_dir)).withColumn("kind", F.lit("fare"))
    return t.unionByName(f)


@register("raw_fields", O.with_ctes(
    "select seq, 'trip' as kind, cast(len(f) as integer) as n_fields, f[1] as first_field, f[-1] as last_field from trip_split "
    "union all "
    "select seq, 'fare' as kind, cast(len(f) as integer) as n_fields, f[1] as first_field, f[-1] as last_field from fare_split"))
def q_raw_fields(spark, sf_dir):
    prof = _both_lines(spark, sf_dir, parse.field_profile, parse.field_profile)
    return prof.select("seq", "kind", "n_fields", "first_field", "last_field")


@register("raw_line_gate", O.with_ctes(
    f"select seq, 'trip' as kind, try_strptime(f[6], {O.TIME_FMT}) as event_ts from trip_split "
    f"where try_strptime(f[6], {O.TIME_FMT}) is not null "
    "union all "
    f"select seq, 'fare' as kind, try_strptime(f[4], {O.TIME_FMT}) as event_ts from fare_split "
    f"where try_strptime(f[4], {O.TIME_FMT}) is not null"))
def q_raw_line_gate(spark, sf_dir):
    g = _both_lines(spark, sf_dir, lambda d: parse.gate_lines(d, "trip"),
                    lambda d: parse.gate_lines(d, "fare"))
    return g.select("seq", "kind", "event_ts")


@register("trip_fare_keys", O.with_ctes(
    f"select seq, 'trip' as kind, {O._key('f[6]')} as key from trip_split where len(f) > 5 "
    "union all "
    f"select seq, 'fare' as kind, {O._key('f[4]')} as key from fare_split where len(f) > 3"))
def q_trip_fare_keys(spark, sf_dir):
    k = _both_lines(spark, sf_dir, lambda d: parse.line_keys(d, 5),
                    lambda d: parse.line_keys(d, 3))
    return k.select("seq", "kind", "key")


def _json_double(x: str) -> str:
    return f"cast(cast({x} as varchar) as double)"


_TRIP_OUT = ("seq, key, medallion, hack_license, vendor_id, rate_code, store_and_fwd_flag, "
             "pickup_datetime, dropoff_datetime, passenger_count, trip_time_in_secs, "
             f"{_json_double('trip_distance')} as trip_distance, "
             f"{_json_double('plon')} as pickup_lon, {_json_double('plat')} as pickup_lat, "
             f"{_json_double('dlon')} as dropoff_lon, {_json_double('dlat')} as dropoff_lat")


def flat_trips(df: DataFrame) -> DataFrame:
    """Refined trips with locations flattened to DOUBLE (JSON read-back values)."""
    from hackney.functions.fields import float_as_json_double as jd
    return df.select(
        "seq", "key", "medallion", "hack_license", "vendor_id", "rate_code",
        "store_and_fwd_flag", "pickup_datetime", "dropoff_datetime", "passenger_count",
        "trip_time_in_secs", jd(F.col("trip_distance")).alias("trip_distance"),
        jd(F.get("pickup_location", 0)).alias("pickup_lon"),
        jd(F.get("pickup_location", 1)).alias("pickup_lat"),
        jd(F.get("dropoff_location", 0)).alias("dropoff_lon"),
        jd(F.get("dropoff_location", 1)).alias("dropoff_lat"))


@register("refined_trips", O.with_ctes(f"select {_TRIP_OUT} from trips"))
def q_refined_trips(spark, sf_dir):
    return flat_trips(trips(spark, sf_dir))


_FARE_OUT = ("seq, key, medallion, hack_license, vendor_id, pickup_datetime, payment_type, "
             + ", ".join(f"cast({a} as double) as {a}" for a in parse.FARE_AMOUNTS))


def flat_fares(df: DataFrame) -> DataFrame:
    return df.select("seq", "key", "medallion", "hack_license", "vendor_id", "pickup_datetime",
                     "payment_type", *[F.col(a).cast("double").alias(a) for a in parse.FARE_AMOUNTS])


@register("refined_fares", O.with_ctes(f"select {_FARE_OUT} from fares"))
def q_refined_fares(spark, sf_dir):
    return flat_fares(fares(spark, sf_dir))


# --------------------------------------------------------------------------
# Payments

@register("eligible_fares", O.with_ctes(
    "select seq, key, payment_type, "
    + ", ".join(f"cast({a} as double) as {a}" for a in parse.FARE_AMOUNTS)
    + " from fares where upper(payment_type) not in ('CAS')"))
def q_eligible_fares(spark, sf_dir):
    e = payments.eligible(fares(spark, sf_dir))
    return e.select("seq", "key", "payment_type",
                    *[F.col(a).cast("double").alias(a) for a in parse.FARE_AMOUNTS])


_STATEMENT_SQL = ("select ts, hack_license, pickup_datetime, cast(total_amount as double) as total_amount, "
                  "cast(tip_amount as double) + 0.9::double * cast(fare_amount as double) as payable_amount "
                  "from fares where upper(payment_type) not in ('CAS')")


@register("driver_payment_statement", O.with_ctes(
    "select hack_license, pickup_datetime, round(total_amount, 3) as total_amount, "
    "round(payable_amount, 3) as payable_amount from statement",
    f"statement as ({_STATEMENT_SQL})"))
def q_driver_payment_statement(spark, sf_dir):
    s = payments.statement(fares(spark, sf_dir))
    return s.select("hack_license", "pickup_datetime",
                    F.round("total_amount", 3).alias("total_amount"),
                    F.round("payable_amount", 3).alias("payable_amount"))


def _summary_sql(size_us: int) -> str:
    return O.with_ctes(
        f"select make_timestamp((epoch_us(ts) // {size_us}) * {size_us}) as window_start, "
        f"make_timestamp((epoch_us(ts) // {size_us}) * {size_us} + {size_us}) as window_end, "
        "hack_license, round(sum(total_amount), 3) as total_amount, "
        "round(sum(payable_amount), 3) as payable_amount from statement group by all",
        f"statement as ({_STATEMENT_SQL})")


def _summary(spark, sf_dir, window):
    s = payments.statement(fares(spark, sf_dir), keep=("ts",))
    return summary_out(payments.summary(s, time_col="ts", window=window, stamp=False))


def summary_out(sums: DataFrame) -> DataFrame:
    return sums.select("window_start", "window_end", "hack_license",
                       F.round("total_amount", 3).alias("total_amount"),
                       F.round("payable_amount", 3).alias("payable_amount"))


@register("driver_payment_summary", _summary_sql(2 * O.MINUTE_US))
def q_driver_payment_summary(spark, sf_dir):
    return _summary(spark, sf_dir, "2 minutes")


@register("driver_payment_summary_daily", _summary_sql(O.DAY_US))
def q_driver_payment_summary_daily(spark, sf_dir):
    return _summary(spark, sf_dir, "1 day")


# --------------------------------------------------------------------------
# Latest per key and trip/fare joins

_LATEST_TRIP_SQL = "latest_trip as (select * from trips qualify row_number() over (partition by key order by seq desc) = 1)"
_LATEST_FARE_SQL = "latest_fare as (select * from fares qualify row_number() over (partition by key order by seq desc) = 1)"


@register("latest_trips", O.with_ctes(f"select {_TRIP_OUT} from latest_trip", _LATEST_TRIP_SQL))
def q_latest_trips(spark, sf_dir):
    return flat_trips(merge.latest_by_key(trips(spark, sf_dir).select("seq", "key", *parse.TRIP_COLUMNS)))


@register("latest_fares", O.with_ctes(f"select {_FARE_OUT} from latest_fare", _LATEST_FARE_SQL))
def q_latest_fares(spark, sf_dir):
    return flat_fares(merge.latest_by_key(fares(spark, sf_dir).select("seq", "key", *parse.FARE_COLUMNS)))


def _merged_sql(source: str, extra: str = "") -> str:
    m = "t.seq is not null"
    amounts = ", ".join(f"coalesce(cast(f.{a} as double), 0.0::double) as {a}" for a in parse.FARE_AMOUNTS)
    return (f"select f.key, f.seq as fare_seq, t.seq as trip_seq, f.medallion, f.hack_license, "
            f"coalesce(f.vendor_id, '') as vendor_id, coalesce(f.payment_type, '') as payment_type, {amounts}, "
            f"case when {m} then coalesce(t.rate_code, '') end as rate_code, "
            f"case when {m} then coalesce(t.store_and_fwd_flag, '') end as store_and_fwd_flag, "
            f"case when {m} then coalesce(t.passenger_count, 0) end as passenger_count, "
            f"case when {m} then coalesce(t.trip_time_in_secs, 0) end as trip_time_in_secs, "
            f"case when {m} then coalesce({_json_double('t.trip_distance')}, 0.0::double) end as trip_distance, "
            f"case when {m} then f.pickup_datetime end as pickup_datetime, "
            f"case when {m} then t.dropoff_datetime end as dropoff_datetime, "
            f"case when {m} then {_json_double('t.plon')} end as pickup_lon, "
            f"case when {m} then {_json_double('t.plat')} end as pickup_lat, "
            f"case when {m} then {_json_double('t.dlon')} end as dropoff_lon, "
            f"case when {m} then {_json_double('t.dlat')} end as dropoff_lat{extra} "
            f"from {source}")


def flat_merged(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c not in ("pickup_location", "dropoff_location")]
    return df.select(*cols,
                     F.get("pickup_location", 0).alias("pickup_lon"),
                     F.get("pickup_location", 1).alias("pickup_lat"),
                     F.get("dropoff_location", 0).alias("dropoff_lon"),
                     F.get("dropoff_location", 1).alias("dropoff_lat"))


@register("trip_fares_table_join", O.with_ctes(
    _merged_sql("latest_fare f left join latest_trip t on f.key = t.key"),
    _LATEST_TRIP_SQL, _LATEST_FARE_SQL))
def q_trip_fares_table_join(spark, sf_dir):
    return flat_merged(merge.table_left_join(fares(spark, sf_dir), trips(spark, sf_dir)))


# The fixture's trip record time runs (seq % 13) minutes after
# the fare's, so some pairs fall inside the 10-minute join window and some not.
TRIP_TIME_SHIFT = "timestampadd(MINUTE, cast(seq % 13 as int), ts)"


@register("trip_fares_interval_join", O.with_ctes(
    _merged_sql("fares f left join trips_shifted t on f.key = t.key "
                "and t.trip_ts between f.ts - interval 10 minutes and f.ts + interval 10 minutes",
                extra=", f.ts as fare_ts, t.trip_ts as trip_ts"),
    "trips_shifted as (select *, ts + to_minutes(cast(seq % 13 as integer)) as trip_ts from trips)"))
def q_trip_fares_interval_join(spark, sf_dir):
    t = trips(spark, sf_dir).withColumn("trip_ts", F.expr(TRIP_TIME_SHIFT))
    return flat_merged(merge.interval_left_join(fares(spark, sf_dir), t,
                                                fare_time="ts", trip_time="trip_ts"))


# --------------------------------------------------------------------------
# Grid geometry, distance, heading, routes

def _center_sql(cell: str) -> tuple[str, str]:
    lon = (f"round(cast(cast(74.05::double - ({cell} % 250) * 0.0014::double - 0.0014::double / 2 as float) "
           f"* cast(-1.0 as float) as double), 6)")
    lat = (f"round(cast(cast(41.0::double - (({cell} - {cell} % 250) // 250) * 0.00125::double "
           f"- 0.00125::double / 2 as float) as double), 6)")
    return lon, lat


_CLON, _CLAT = _center_sql("grid_id")


@register("grid_cell_centers", O.with_ctes(
    f"select grid_id, {_CLON} as center_lon, {_CLAT} as center_lat, count(*) as pickups "
    "from cells where grid_id > -1 group by grid_id"))
def q_grid_cell_centers(spark, sf_dir):
    """Centre of every cell trips start in, with its pickup count."""
    from hackney.functions.geo import cell_center_lat, cell_center_lon
    counts = (trending.pickup_cells(trips(spark, sf_dir), keep=())
              .groupBy("grid_id").agg(F.count(F.lit(1)).alias("pickups")))
    return counts.select(
        "grid_id",
        F.round(cell_center_lon(F.col("grid_id")).cast("double"), 6).alias("center_lon"),
        F.round(cell_center_lat(F.col("grid_id")).cast("double"), 6).alias("center_lat"),
        "pickups")


_HEADING_SQL = ("case when plon = dlon and plat = dlat and cos(cast(plat as double)) < 0 then 359 "
                "else cast(trunc(degrees(atan2(cast(dlat - plat as double), "
                "cast(dlon - plon as double) * cos(cast(plat as double))))) as integer) + 179 end")
_DIST_SQL = ("110.25::double * sqrt(cast(plat - dlat as double) * cast(plat - dlat as double) + "
             "(cast(plon - dlon as double) * cos(cast(dlat as double))) * "
             "(cast(plon - dlon as double) * cos(cast(dlat as double))))")


@register("trip_geo", O.with_ctes(
    f"select seq, key, round({_DIST_SQL}, 6) as distance_km, {_HEADING_SQL} as heading "
    "from trips where has_dropoff"))
def q_trip_geo(spark, sf_dir):
    from hackney.functions.geo import heading, planar_distance
    t = trips(spark, sf_dir).where(F.size("dropoff_location") == 2)
    p0, p1 = F.get("pickup_location", 0), F.get("pickup_location", 1)
    d0, d1 = F.get("dropoff_location", 0), F.get("dropoff_location", 1)
    return t.select("seq", "key",
                    F.round(planar_distance(p0, p1, d0, d1), 6).alias("distance_km"),
                    heading(p0, p1, d0, d1).alias("heading"))


def _walk_sql() -> str:
    """Recursive walk over distinct endpoint pairs (DuckDB)."""
    d = "::double"
    base = f"(cast(x - sx as double) + 0.5{d}) * slope + cast(sy as double)"
    yr, yf = f"({base} - 0.5{d})", f"({base} + 0.5{d})"
    yd = "cast(y as double)"
    band_r = f"({yr} > {yd} - 0.05{d} and {yr} < {yd} + 0.05{d})"
    band_f = f"({yf} > {yd} - 0.05{d} and {yf} < {yd} + 0.05{d})"
    fx1 = f"(case when {band_f} then x + 1 else x end)"
    fy1 = f"(case when {band_f} then y - 1 else y end)"
    above = f"({yf} > cast({fy1} as double))"
    nx = (f"case when slope > 0{d} then (case when {band_r} or {yr} < {yd} then x + 1 else x end) "
          f"else (case when {above} then {fx1} + 1 else {fx1} end) end")
    ny = (f"case when slope > 0{d} then (case when {band_r} or not ({yr} < {yd}) then y + 1 else y end) "
          f"else (case when {above} then {fy1} else {fy1} - 1 end) end")
    return (
        "ends as (select seq, key, " + O.gx("plon") + " as x1, " + O.gy("plat") + " as y1, "
        + O.gx("dlon") + " as x2, " + O.gy("dlat") + " as y2 from trips where has_dropoff and "
        + O.in_nyc("plon", "plat") + " and " + O.in_nyc("dlon", "dlat") + "),\n"
        "pairs as (select distinct x1, y1, x2, y2 from ends),\n"
        "norm as (select x1, y1, x2, y2, case when x1 <= x2 then x1 else x2 end as sx, "
        "case when x1 <= x2 then y1 else y2 end as sy, case when x1 <= x2 then x2 else x1 end as ex, "
        "case when x1 <= x2 then y2 else y1 end as ey from pairs),\n"
        f"norm2 as (select *, cast(ey - sy as double) / (cast(ex - sx as double) + 0.00000001{d}) as slope from norm),\n"
        "walk as (select x1, y1, x2, y2, sx, sy, ex, ey, slope, 0 as pos, sx as x, sy as y from norm2 "
        "union all "
        f"select x1, y1, x2, y2, sx, sy, ex, ey, slope, pos + 1, {nx}, {ny} from walk "
        "where x < ex or y <> ey)")


@register("route_cells", "with recursive " + O.with_ctes(
    "select e.seq, e.key, w.pos, w.x + 250 * w.y as cell from ends e join walk w "
    "on e.x1 = w.x1 and e.y1 = w.y1 and e.x2 = w.x2 and e.y2 = w.y2",
    _walk_sql())[len("with "):])
def q_route_cells(spark, sf_dir):
    return routes.trip_route_cells(trips(spark, sf_dir), keep=("seq", "key"))


@register("route_cell_traffic", "with recursive " + O.with_ctes(
    "select w.x + 250 * w.y as cell, count(*) as trips from ends e join walk w "
    "on e.x1 = w.x1 and e.y1 = w.y1 and e.x2 = w.x2 and e.y2 = w.y2 group by all",
    _walk_sql())[len("with "):])
def q_route_cell_traffic(spark, sf_dir):
    return routes.cell_traffic(trips(spark, sf_dir))


# --------------------------------------------------------------------------
# JSON edge and index documents

@register("json_round_trip", O.with_ctes(f"select {_TRIP_OUT} from trips"))
def q_json_round_trip(spark, sf_dir):
    from hackney.sources import kafka
    t = trips(spark, sf_dir)
    frame = kafka.to_kafka_frame(t, key_col="key", value_cols=parse.TRIP_COLUMNS, keep=("seq",))
    back = kafka.from_kafka_json(frame, kafka.REFINED_TRIP_SCHEMA, keep=("seq",))
    return flat_trips(back)


@register("trip_documents", O.with_ctes(
    "select medallion, hack_license, vendor_id, rate_code, store_and_fwd_flag, pickup_datetime, "
    "dropoff_datetime, passenger_count, cast(trip_time_in_secs as integer) as trip_time_in_secs, "
    f"{_json_double('trip_distance')} as trip_distance, "
    f"{_json_double('plon')} as pickup_lon, {_json_double('plat')} as pickup_lat, "
    f"{_json_double('dlon')} as dropoff_lon, {_json_double('dlat')} as dropoff_lat from trips"))
def q_trip_documents(spark, sf_dir):
    from hackney.functions.fields import float_as_json_double as jd
    from hackney.operators.documents import trip_documents
    d = trip_documents(trips(spark, sf_dir))
    return d.select(
        "medallion", "hack_license", "vendor_id", "rate_code", "store_and_fwd_flag",
        "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_time_in_secs",
        jd(F.col("trip_distance")).alias("trip_distance"),
        jd(F.get("pickup_location", 0)).alias("pickup_lon"),
        jd(F.get("pickup_location", 1)).alias("pickup_lat"),
        jd(F.get("dropoff_location", 0)).alias("dropoff_lon"),
        jd(F.get("dropoff_location", 1)).alias("dropoff_lat"))


@register("fare_documents", O.with_ctes(
    "select medallion, hack_license, vendor_id, case when pu_ts is not null then pickup_datetime end as pickup_datetime, "
    "payment_type, " + ", ".join(f"cast({a} as float) as {a}" for a in parse.FARE_AMOUNTS) + " from fares"))
def q_fare_documents(spark, sf_dir):
    from hackney.operators.documents import fare_documents
    return fare_documents(fares(spark, sf_dir))


# The streaming queries register themselves here, with the oracles above.
from hackney.plans import streams  # noqa: E402, F401
