"""Merged record, payments, grid, distance/heading and route walk."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hackney.functions import geo
from hackney.operators import merge, parse, payments, routes, trending
from test_parse import GOOD_FARE, GOOD_TRIP, KEY


def _pair(lines):
    t = parse.parse_trips(lines([(1, "2013-12-01 00:00:00", GOOD_TRIP)]))
    f = parse.parse_fares(lines([(2, "2013-12-01 00:00:00", GOOD_FARE)]))
    return t, f


def test_merge_record_matched_t9_t11(lines):
    t, f = _pair(lines)
    (r,) = merge.table_left_join(f, t).collect()
    assert r.key == KEY and r.medallion == "2013008681"
    assert r.trip_distance == 1.24            # T9: float read back as 1.24, not 1.2400000095
    assert r.pickup_datetime == "2013-12-01 00:00:00"   # T11: only on a match
    import numpy as np
    assert r.pickup_location == [float(str(np.float32(v))) for v in (-73.983803, 40.743511)]
    assert r.passenger_count == 6 and r.trip_time_in_secs == 360
    assert (r.fare_amount, r.total_amount) == (6.5, 7.5)


def test_merge_record_unmatched_and_empty_dropoff_t10_t12(lines):
    t, f = _pair(lines)
    lone = parse.parse_fares(lines([(3, "2013-12-01 00:00:00",
                                     GOOD_FARE.replace("2013008681", "1111111111"))]))
    rows = {r.medallion: r for r in merge.table_left_join(f.unionByName(lone), t).collect()}
    u = rows["1111111111"]
    assert u.trip_seq is None and u.pickup_datetime is None and u.rate_code is None
    assert u.fare_amount == 6.5
    no_drop = parse.parse_trips(lines([(1, "2013-12-01 00:00:00",
                                        GOOD_TRIP.rsplit(",", 2)[0] + ",,")]))
    (m,) = merge.table_left_join(f, no_drop).collect()
    assert m.dropoff_location == [None, None]          # T12


def test_latest_by_key_takes_highest_seq(lines):
    a = GOOD_FARE
    b = GOOD_FARE.replace(",CSH,", ",CRD,")
    f = parse.parse_fares(lines([(5, "2013-12-01 00:00:00", b), (3, "2013-12-01 00:00:00", a)]))
    (r,) = merge.latest_by_key(f).collect()
    assert (r.seq, r.payment_type) == (5, "CRD")


def test_interval_join_edges(lines):
    f = parse.parse_fares(lines([(1, "2013-12-01 00:00:00", GOOD_FARE)]))
    trips = lines([(10, "2013-12-01 00:10:00", GOOD_TRIP), (11, "2013-12-01 00:10:01", GOOD_TRIP),
                   (12, "2013-11-30 23:50:00", GOOD_TRIP)])
    t = parse.parse_trips(trips)
    got = sorted(r.trip_seq for r in merge.interval_left_join(f, t, "ts", "ts").collect())
    assert got == [10, 12]        # 10:00 after and before match, 10:01 does not
    t2 = parse.parse_trips(lines([(11, "2013-12-01 00:10:01", GOOD_TRIP)]))
    (r,) = merge.interval_left_join(f, t2, "ts", "ts").collect()
    assert r.trip_seq is None and r.fare_seq == 1


def test_payable_and_t13_exclusion(lines):
    rows = [(0, "2013-12-01 00:00:00", GOOD_FARE),
            (1, "2013-12-01 00:00:00", GOOD_FARE.replace(",CSH,", ",cas,")),
            (2, "2013-12-01 00:00:00", GOOD_FARE.replace(",CSH,", ",CAS,"))]
    f = parse.parse_fares(lines(rows))
    (s,) = payments.statement(f).collect()
    assert s.payable_amount == pytest.approx(5.85) and s.total_amount == 7.5
    assert payments.statement(f, excluded=("CSH",)).count() == 2   # cash code as a parameter


def test_pickup_cell_reference_value(lines):
    t = parse.parse_trips(lines([(1, "2013-12-01 00:00:00", GOOD_TRIP)]))
    (c,) = trending.pickup_cells(t).collect()
    assert c.grid_id == 51297


def test_t17_t18_box_edges(spark):
    df = spark.createDataFrame([(-73.7, 40.7), (-74.05, 40.7), (-73.8, 40.5), (-73.8, 41.0)],
                               "lon float, lat float")
    got = [r.c for r in df.select(geo.area_cell(F.col("lon"), F.col("lat")).alias("c")).collect()]
    assert got[0] == -1 and got[1] == -1          # -73.7f and -74.05f widen to just outside
    assert got[2] >= 0 and got[3] >= 0
    assert max(got) > 99999                       # lat 40.5 is row 400


def test_center_round_trip(spark):
    ids = spark.range(0, 100250, 97).select(F.col("id").cast("int").alias("id"))
    back = ids.select("id", geo.grid_cell(geo.cell_center_lon(F.col("id")),
                                          geo.cell_center_lat(F.col("id"))).alias("b"))
    bad = back.where(F.col("id") != F.col("b")).count()
    assert bad == 0


def _java_heading(lon1, lat1, lon2, lat2):
    import numpy as np
    f = np.float32
    x = float(f(lat2) - f(lat1))
    y = float(f(lon2) - f(lon1)) * math.cos(float(f(lat1)))
    return int(math.degrees(math.atan2(x, y))) + 179


def test_t20_heading_and_distance(spark):
    pts = [(-73.98, 40.75, -73.98, 40.75), (-73.98, 40.75, -73.90, 40.75),
           (-73.98, 40.75, -73.98, 40.80), (-73.98, 40.75, -74.0, 40.70)]
    df = spark.createDataFrame(pts, "a float, b float, c float, d float")
    got = df.select(geo.heading(*[F.col(c) for c in "abcd"]).alias("h"),
                    geo.planar_distance(*[F.col(c) for c in "abcd"]).alias("d")).collect()
    for (p, r) in zip(pts, got):
        assert r.h == _java_heading(*p)
    assert got[0].h == 359 and got[0].d == 0.0


def _walk_py(x1, y1, x2, y2):
    """Plain loop of the way-cells walk (specification for the fold)."""
    if x1 <= x2:
        sx, sy, ex, ey = x1, y1, x2, y2
    else:
        sx, sy, ex, ey = x2, y2, x1, y1
    slope = (ey - sy) / ((ex - sx) + 0.00000001)
    x, y = sx, sy
    out = [x + 250 * y]
    steps = 0
    while x < ex or y != ey:
        steps += 1
        assert steps <= (ex - sx) + abs(ey - sy) + 1, "walk exceeded its step bound"
        if slope > 0:
            yy = (x - sx + 0.5) * slope + sy - 0.5
            if yy > y - 0.05 and yy < y + 0.05:
                x += 1
                y += 1
            elif yy < y:
                x += 1
            else:
                y += 1
        else:
            yy = (x - sx + 0.5) * slope + sy + 0.5
            if yy > y - 0.05 and yy < y + 0.05:
                x += 1
                y -= 1
            if yy > y:
                x += 1
            else:
                y -= 1
        out.append(x + 250 * y)
    return out


coord = st.tuples(st.integers(0, 249), st.integers(0, 400))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(coord, coord), min_size=1, max_size=80))
def test_walk_matches_plain_loop(spark, pairs):
    rows = [(a[0], a[1], b[0], b[1]) for a, b in pairs]
    df = spark.createDataFrame(rows, "x1 int, y1 int, x2 int, y2 int")
    got = df.select(routes.walk_cells(*[F.col(c) for c in routes.PAIR]).alias("w")).collect()
    for row, g in zip(rows, got):
        assert g.w == _walk_py(*row)


def test_walk_step_bound_exhaustive_offsets():
    # every offset within +-60 columns/rows from several start rows
    for sy in (0, 137, 400):
        for dx in range(0, 61):
            for dy in range(-60, 61):
                _walk_py(0, sy, dx, sy + dy)


def test_document_shapes(lines):
    from hackney.operators import documents
    t = parse.parse_trips(lines([(1, "2013-12-01 00:00:00", GOOD_TRIP.rsplit(",", 2)[0] + ",,")]))
    (d,) = documents.trip_documents(t).collect()
    assert d.dropoff_location is None and len(d.pickup_location) == 2
    assert isinstance(d.trip_time_in_secs, int) and d.trip_time_in_secs == 360
    f = parse.parse_fares(lines([(2, "2013-12-01 00:00:00", GOOD_FARE)]))
    fd = documents.fare_documents(f)
    assert dict(fd.dtypes)["total_amount"] == "float" and fd.first().total_amount == 7.5
