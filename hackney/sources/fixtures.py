"""Raw trip and fare lines derived from the ``events`` table.

The real monthly trip/fare files are not shipped, so test and bench inputs
are derived deterministically from ``events`` (``event_id`` plays the source
offset ``seq``, ``ts`` the record time).  The lines cover good rows, headers,
short rows, bad dates, bad numbers, trips without a dropoff and unmatched
keys on either side.  The derivation is a single narrow projection: it grows
with ``events`` and needs no shuffle.

Output schema of both functions: ``seq bigint, ts timestamp, value string``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hackney.sources.tables import read_table

# The line-derivation rule shared with the DuckDB oracle.
_BASE = """
with b as (select event_id as seq, cast(ts as timestamp) as ts, cast(2013000000+user_id as string) med, cast(2013500000+user_id % 40 as string) hack,
 case when event_id % 2=0 then 'VTS' else 'CMT' end vendor, date_format(ts,'yyyy-MM-dd HH:mm:ss') pu, date_format(timestampadd(SECOND,cast((event_id % 47)*60 + event_id % 60 as int),ts),'yyyy-MM-dd HH:mm:ss') dof,
 cast(1+event_id % 6 as string) pax, cast(round(value*100) as bigint) c,
 concat('-',concat(cast((74080000 - ((event_id*29) % 10)*40000) div 1000000 as string),'.',lpad(cast((74080000 - ((event_id*29) % 10)*40000) % 1000000 as string),6,'0'))) lon, concat(cast((40450000 + ((event_id*53) % 12)*50000) div 1000000 as string),'.',lpad(cast((40450000 + ((event_id*53) % 12)*50000) % 1000000 as string),6,'0')) lat,
 concat('-',concat(cast((74080000 - ((event_id*31) % 10)*40000) div 1000000 as string),'.',lpad(cast((74080000 - ((event_id*31) % 10)*40000) % 1000000 as string),6,'0'))) lon2, concat(cast((40450000 + ((event_id*59) % 12)*50000) div 1000000 as string),'.',lpad(cast((40450000 + ((event_id*59) % 12)*50000) % 1000000 as string),6,'0')) lat2 from {events})
"""

_TRIPS = _BASE + """select seq, ts, case when seq % 101=0 then 'medallion, hack_license, vendor_id, rate_code, store_and_fwd_flag, pickup_datetime, dropoff_datetime, passenger_count, trip_time_in_secs, trip_distance, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude'
 when seq % 109=0 then concat_ws(',',case when seq % 10=3 then concat('2014',substr(med,5)) else med end,hack,vendor,'1','',pu,dof,pax)
 else concat_ws(',',case when seq % 10=3 then concat('2014',substr(med,5)) else med end,hack,vendor,'1','',case when seq % 113=0 then 'not-a-date' else pu end,dof,case when seq % 103=0 then 'x' else pax end,'0',concat(cast((c) div 100 as string),'.',lpad(cast((c) % 100 as string),2,'0')),lon,lat,case when seq % 107=0 then '' else lon2 end,case when seq % 107=0 then '' else lat2 end) end as value from b
"""

_FARES = _BASE + """select seq, ts, case when seq % 101=0 then 'medallion, hack_license, vendor_id, pickup_datetime, payment_type, fare_amount, surcharge, mta_tax, tip_amount, tolls_amount, total_amount'
 when seq % 109=0 then concat_ws(',',case when seq % 10=7 then concat('2015',substr(med,5)) else med end,hack,vendor,pu)
 else concat_ws(',',case when seq % 10=7 then concat('2015',substr(med,5)) else med end,hack,vendor,case when seq % 113=0 then 'not-a-date' else pu end,case seq % 5 when 0 then 'CSH' when 1 then 'CRD' when 2 then 'CAS' when 3 then 'cas' else 'DIS' end,case when seq % 103=0 then 'x' else concat(cast((c) div 100 as string),'.',lpad(cast((c) % 100 as string),2,'0')) end,'0.5','0.5',concat(cast((c % 500) div 100 as string),'.',lpad(cast((c % 500) % 100 as string),2,'0')),'0',concat(cast((c + 100 + c % 500) div 100 as string),'.',lpad(cast((c + 100 + c % 500) % 100 as string),2,'0'))) end as value from b
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def trip_lines_from_events(spark: SparkSession, events_df: DataFrame) -> DataFrame:
    return spark.sql(_TRIPS, events=events_df)


def fare_lines_from_events(spark: SparkSession, events_df: DataFrame) -> DataFrame:
    return spark.sql(_FARES, events=events_df)


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip lines (``seq, ts, value``) for the tables in ``sf_dir``."""
    return trip_lines_from_events(spark, events(spark, sf_dir))


def fare_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw fare lines (``seq, ts, value``) for the tables in ``sf_dir``."""
    return fare_lines_from_events(spark, events(spark, sf_dir))
