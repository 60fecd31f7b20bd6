"""DuckDB SQL that states each registered query independently of Spark.

Each query is ``WITH <shared CTEs> SELECT ...`` over the pre-registered
``events`` view.  The CTEs rebuild the raw lines (same rule as
:mod:`hackney.sources.fixtures`) and parse them with DuckDB's own functions,
so the Spark plan and this text only share the specification.
"""

from __future__ import annotations

# The line-derivation rule (DuckDB dialect).
_BASE = """b as (select event_id as seq, ts, cast(2013000000+user_id as varchar) med, cast(2013500000+user_id % 40 as varchar) hack,
 case when event_id % 2=0 then 'VTS' else 'CMT' end vendor, strftime(ts,'%Y-%m-%d %H:%M:%S') pu, strftime((ts + to_seconds((event_id % 47)*60 + event_id % 60)),'%Y-%m-%d %H:%M:%S') dof,
 cast(1+event_id % 6 as varchar) pax, cast(round(value*100) as bigint) c,
 concat('-',concat(cast((74080000 - ((event_id*29) % 10)*40000) // 1000000 as varchar),'.',lpad(cast((74080000 - ((event_id*29) % 10)*40000) % 1000000 as varchar),6,'0'))) lon, concat(cast((40450000 + ((event_id*53) % 12)*50000) // 1000000 as varchar),'.',lpad(cast((40450000 + ((event_id*53) % 12)*50000) % 1000000 as varchar),6,'0')) lat,
 concat('-',concat(cast((74080000 - ((event_id*31) % 10)*40000) // 1000000 as varchar),'.',lpad(cast((74080000 - ((event_id*31) % 10)*40000) % 1000000 as varchar),6,'0'))) lon2, concat(cast((40450000 + ((event_id*59) % 12)*50000) // 1000000 as varchar),'.',lpad(cast((40450000 + ((event_id*59) % 12)*50000) % 1000000 as varchar),6,'0')) lat2 from events)"""

_TRIP_LINES = """trip_lines as (select seq, ts, case when seq % 101=0 then 'medallion, hack_license, vendor_id, rate_code, store_and_fwd_flag, pickup_datetime, dropoff_datetime, passenger_count, trip_time_in_secs, trip_distance, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude'
 when seq % 109=0 then concat_ws(',',case when seq % 10=3 then concat('2014',substr(med,5)) else med end,hack,vendor,'1','',pu,dof,pax)
 else concat_ws(',',case when seq % 10=3 then concat('2014',substr(med,5)) else med end,hack,vendor,'1','',case when seq % 113=0 then 'not-a-date' else pu end,dof,case when seq % 103=0 then 'x' else pax end,'0',concat(cast((c) // 100 as varchar),'.',lpad(cast((c) % 100 as varchar),2,'0')),lon,lat,case when seq % 107=0 then '' else lon2 end,case when seq % 107=0 then '' else lat2 end) end as value from b)"""

_FARE_LINES = """fare_lines as (select seq, ts, case when seq % 101=0 then 'medallion, hack_license, vendor_id, pickup_datetime, payment_type, fare_amount, surcharge, mta_tax, tip_amount, tolls_amount, total_amount'
 when seq % 109=0 then concat_ws(',',case when seq % 10=7 then concat('2015',substr(med,5)) else med end,hack,vendor,pu)
 else concat_ws(',',case when seq % 10=7 then concat('2015',substr(med,5)) else med end,hack,vendor,case when seq % 113=0 then 'not-a-date' else pu end,case seq % 5 when 0 then 'CSH' when 1 then 'CRD' when 2 then 'CAS' when 3 then 'cas' else 'DIS' end,case when seq % 103=0 then 'x' else concat(cast((c) // 100 as varchar),'.',lpad(cast((c) % 100 as varchar),2,'0')) end,'0.5','0.5',concat(cast((c % 500) // 100 as varchar),'.',lpad(cast((c % 500) % 100 as varchar),2,'0')),'0',concat(cast((c + 100 + c % 500) // 100 as varchar),'.',lpad(cast((c + 100 + c % 500) % 100 as varchar),2,'0'))) end as value from b)"""

TIME_FMT = "'%Y-%m-%d %H:%M:%S'"
INT_RE = "'[+-]?[0-9]+'"
DEC_RE = "'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'"


def _flt(x: str) -> str:
    t = f"regexp_replace({x}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    return f"(case when regexp_full_match({t}, {DEC_RE}) then try_cast({t} as float) end)"


def _int(x: str) -> str:
    return f"(case when regexp_full_match({x}, {INT_RE}) then try_cast({x} as integer) end)"


def _dec(x: str) -> str:
    return f"(case when regexp_full_match({x}, {DEC_RE}) then try_cast({x} as decimal(38,10)) end)"


def _key(pickup_idx1: str) -> str:
    return (f"f[1] || f[2] || coalesce(strftime(try_strptime({pickup_idx1}, {TIME_FMT}), "
            f"'%Y%m%d%H%M'), '-')")


_TRIP_SPLIT = """trip_split as (select seq, ts, string_split(regexp_replace(value, ',+$', ''), ',') as f from trip_lines)"""
_FARE_SPLIT = """fare_split as (select seq, ts, string_split(regexp_replace(value, ',+$', ''), ',') as f from fare_lines)"""

_TRIP_TYPED = f"""trip_typed as (select seq, ts, f, len(f) as n,
  try_strptime(f[6], {TIME_FMT}) as pu_ts, try_strptime(f[7], {TIME_FMT}) as do_ts,
  {_int('f[8]')} as pax, {_flt('f[10]')} as dist,
  {_flt('f[11]')} as plon, {_flt('f[12]')} as plat, {_flt('f[13]')} as dlon, {_flt('f[14]')} as dlat
  from trip_split)"""

_TRIPS = f"""trips as (select seq, ts, {_key('f[6]')} as key,
  f[1] as medallion, f[2] as hack_license, f[3] as vendor_id, f[4] as rate_code, f[5] as store_and_fwd_flag,
  f[6] as pickup_datetime, f[7] as dropoff_datetime, pax as passenger_count,
  cast(epoch(do_ts) - epoch(pu_ts) as bigint) as trip_time_in_secs, dist as trip_distance,
  plon, plat, case when n > 12 then dlon end as dlon, case when n > 12 then dlat end as dlat,
  n > 12 as has_dropoff, pu_ts, do_ts
  from trip_typed
  where n >= 12 and n <> 13 and pu_ts is not null and do_ts is not null and pax is not null
    and dist is not null and plon is not null and plat is not null
    and (n <= 12 or (dlon is not null and dlat is not null)))"""

_FARE_TYPED = f"""fare_typed as (select seq, ts, f, len(f) as n,
  {_dec('f[6]')} as fare_amount, {_dec('f[7]')} as surcharge, {_dec('f[8]')} as mta_tax,
  {_dec('f[9]')} as tip_amount, {_dec('f[10]')} as tolls_amount, {_dec('f[11]')} as total_amount
  from fare_split)"""

_FARES = f"""fares as (select seq, ts, {_key('f[4]')} as key,
  f[1] as medallion, f[2] as hack_license, f[3] as vendor_id, f[4] as pickup_datetime, f[5] as payment_type,
  fare_amount, surcharge, mta_tax, tip_amount, tolls_amount, total_amount,
  try_strptime(f[4], {TIME_FMT}) as pu_ts
  from fare_typed
  where n >= 11 and fare_amount is not null and surcharge is not null and mta_tax is not null
    and tip_amount is not null and tolls_amount is not null and total_amount is not null)"""

# Grid expressions on FLOAT lon/lat with DOUBLE literals.
def in_nyc(lon: str, lat: str) -> str:
    return (f"(cast({lon} as double) >= -74.05::double and cast({lon} as double) <= -73.7::double "
            f"and cast({lat} as double) >= 40.5::double and cast({lat} as double) <= 41.0::double)")


def gx(lon: str) -> str:
    return f"cast(floor((74.05::double - cast(abs({lon}) as double)) / 0.0014::double) as integer)"


def gy(lat: str) -> str:
    return f"cast(floor((41.0::double - cast({lat} as double)) / 0.00125::double) as integer)"


def cell(lon: str, lat: str) -> str:
    return f"({gx(lon)} + 250 * {gy(lat)})"


_CELLS = f"""cells as (select seq, ts, key, case when {in_nyc('plon', 'plat')} then {cell('plon', 'plat')} else -1 end as grid_id
  from trips)"""

_ORDER = [("b", _BASE), ("trip_lines", _TRIP_LINES), ("fare_lines", _FARE_LINES),
          ("trip_split", _TRIP_SPLIT), ("fare_split", _FARE_SPLIT),
          ("trip_typed", _TRIP_TYPED), ("fare_typed", _FARE_TYPED),
          ("trips", _TRIPS), ("fares", _FARES), ("cells", _CELLS)]


def with_ctes(body: str, *extra: str) -> str:
    """``WITH`` all shared CTEs (plus ``extra`` ones, in order) then ``body``."""
    ctes = [text for _, text in _ORDER] + list(extra)
    return "with " + ",\n".join(ctes) + "\n" + body


def hopping(cols: str, source: str, ts: str, slide_us: int, size_us: int) -> str:
    """Sub-select of ``cols`` plus ``window_start``/``window_end`` for every
    hopping window that holds ``ts`` (epoch-aligned, start included): each
    row of ``source`` becomes ``size / slide`` rows."""
    k = size_us // slide_us
    return (f"(select {cols}, make_timestamp((epoch_us({ts}) // {slide_us} - k) * {slide_us}) as window_start, "
            f"make_timestamp((epoch_us({ts}) // {slide_us} - k) * {slide_us} + {size_us}) as window_end "
            f"from (select *, unnest(range({k})) as k from {source}))")


MINUTE_US = 60_000_000
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US
