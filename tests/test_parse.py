"""Parsing, keys and the raw-line traps (split, short rows, dates, numbers)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hackney.operators import parse

GOOD_TRIP = ("2013008681,2013007085,VTS,1,,2013-12-01 00:00:00,2013-12-01 00:06:00,6,360,1.24,"
             "-73.983803,40.743511,-73.990311,40.729755")
GOOD_FARE = "2013008681,2013007085,VTS,2013-12-01 00:00:00,CSH,6.5,0.5,0.5,0,0,7.5"
TRIP_HEADER = ("medallion, hack_license, vendor_id, rate_code, store_and_fwd_flag, pickup_datetime, "
               "dropoff_datetime, passenger_count, trip_time_in_secs, trip_distance, "
               "pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude")
FARE_HEADER = ("medallion, hack_license, vendor_id, pickup_datetime, payment_type, fare_amount, "
               "surcharge, mta_tax, tip_amount, tolls_amount, total_amount")
KEY = "20130086812013007085201312010000"


def _trips(lines, *values):
    df = lines([(i, "2013-12-01 00:00:00", v) for i, v in enumerate(values)])
    return parse.parse_trips(df).orderBy("seq").collect()


def _fares(lines, *values):
    df = lines([(i, "2013-12-01 00:00:00", v) for i, v in enumerate(values)])
    return parse.parse_fares(df).orderBy("seq").collect()


def test_good_trip_every_field(lines):
    (r,) = _trips(lines, GOOD_TRIP)
    assert r.key == KEY
    assert (r.medallion, r.hack_license, r.vendor_id, r.rate_code, r.store_and_fwd_flag) == \
        ("2013008681", "2013007085", "VTS", "1", "")
    assert (r.pickup_datetime, r.dropoff_datetime) == ("2013-12-01 00:00:00", "2013-12-01 00:06:00")
    assert r.passenger_count == 6
    assert r.trip_time_in_secs == 360
    assert r.trip_distance == pytest.approx(1.24, abs=1e-6)
    assert r.pickup_location == pytest.approx([-73.983803, 40.743511], abs=1e-5)
    assert r.dropoff_location == pytest.approx([-73.990311, 40.729755], abs=1e-5)


def test_good_fare_every_field(lines):
    (r,) = _fares(lines, GOOD_FARE)
    assert r.key == KEY
    assert (r.medallion, r.hack_license, r.vendor_id, r.pickup_datetime, r.payment_type) == \
        ("2013008681", "2013007085", "VTS", "2013-12-01 00:00:00", "CSH")
    assert [float(getattr(r, a)) for a in parse.FARE_AMOUNTS] == [6.5, 0.5, 0.5, 0.0, 0.0, 7.5]


def test_headers_rejected(lines):
    assert _trips(lines, TRIP_HEADER) == []
    assert _fares(lines, FARE_HEADER) == []
    # the trip parser also rejects a fare header
    assert _trips(lines, FARE_HEADER) == []


def test_t1_trailing_empty_fields_dropped(lines):
    # ",," at the end: 12 fields -> valid trip without a dropoff location
    no_drop = GOOD_TRIP.rsplit(",", 2)[0] + ",,"
    (r,) = _trips(lines, no_drop)
    assert r.dropoff_location == []
    prof = parse.field_profile(lines([(0, "2013-12-01 00:00:00", "a,,b,,")])).first()
    assert (prof.n_fields, prof.first_field, prof.last_field) == (3, "a", "b")


def test_t2_short_and_13_field_rows_dropped(lines):
    f = GOOD_TRIP.split(",")
    thirteen = ",".join(f[:13])
    eleven = ",".join(f[:11])
    assert _trips(lines, thirteen, eleven) == []
    assert _fares(lines, ",".join(GOOD_FARE.split(",")[:10])) == []


def test_t3_duration_recomputed_may_be_negative(lines):
    f = GOOD_TRIP.split(",")
    f[8] = "99999"
    f[5], f[6] = "2013-12-01 00:10:00", "2013-12-01 00:04:30"
    (r,) = _trips(lines, ",".join(f))
    assert r.trip_time_in_secs == -330


@pytest.mark.parametrize("bad", ["2013-13-01 00:00:00", "2013-12-01 00:00:00x", "not-a-date", ""])
def test_t4_strict_dates(lines, bad):
    f = GOOD_TRIP.split(",")
    f[5] = bad
    assert _trips(lines, ",".join(f)) == []


@pytest.mark.parametrize("pax,ok", [("6", True), ("+6", True), (" 6", False), ("6.5", False),
                                    ("x", False), ("99999999999", False)])
def test_t5_integer_guard(lines, pax, ok):
    f = GOOD_TRIP.split(",")
    f[7] = pax
    assert bool(_trips(lines, ",".join(f))) == ok


@pytest.mark.parametrize("dist,ok", [("1.24", True), (" 1.24 ", True), ("1e2", True), (".5", True),
                                     ("1.5f", False), ("NaN", False), ("abc", False)])
def test_t5_float_guard(lines, dist, ok):
    f = GOOD_TRIP.split(",")
    f[9] = dist
    assert bool(_trips(lines, ",".join(f))) == ok


@pytest.mark.parametrize("amt,ok", [("6.5", True), ("-1", True), ("1E+2", True), (" 6.5", False),
                                    ("6.5.1", False), ("", False)])
def test_t5_decimal_guard(lines, amt, ok):
    f = GOOD_FARE.split(",")
    f[5] = amt
    assert bool(_fares(lines, ",".join(f))) == ok


def test_t7_fare_bad_pickup_keeps_row_key_dash(lines):
    f = GOOD_FARE.split(",")
    f[3] = "not-a-date"
    (r,) = _fares(lines, ",".join(f))
    assert r.key == "20130086812013007085-"
    assert r.pickup_ts is None


def test_t8_key_minute_without_separator(lines):
    f = GOOD_TRIP.split(",")
    f[5] = "2013-12-01 07:08:59"
    (r,) = _trips(lines, ",".join(f))
    assert r.key == "2013008681" "2013007085" "201312010708"


def test_gate_keeps_lines_with_pickup_time(lines):
    df = lines([(0, "2013-12-01 00:00:00", GOOD_TRIP), (1, "2013-12-01 00:00:00", TRIP_HEADER)])
    rows = parse.gate_lines(df, "trip").collect()
    assert [r.seq for r in rows] == [0]
    assert rows[0].event_ts == dt.datetime(2013, 12, 1, 0, 0)


def test_no_codegen_blowup_on_fixture(spark):
    # The full fixture + parser must stay compiled (no interpreted fallback)
    from hackney.sources import fixtures
    df = parse.parse_trips(fixtures.trip_lines(spark, "/root/testdata/sf0.001"))
    assert df.where(F.col("passenger_count") > 0).count() > 0


def test_extreme_dates_do_not_fail_tasks(lines):
    from hackney.operators import documents
    f = GOOD_TRIP.split(",")
    f[5], f[6] = "0001-01-01 00:00:00", "9999-12-31 23:59:59"
    df = lines([(0, "2013-12-01 00:00:00", ",".join(f))])
    trips = parse.parse_trips(df)
    (r,) = trips.select("trip_time_in_secs").collect()   # (year 1 has no Python local time)
    assert r.trip_time_in_secs > 2**31
    (d,) = documents.trip_documents(trips).select("trip_time_in_secs").collect()
    assert d.trip_time_in_secs is None
