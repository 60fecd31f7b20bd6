"""Plan shapes the scale design depends on."""

from pyspark.sql import functions as F

from hackney.operators import merge, parse, payments, routes, trending
from hackney.sources import fixtures, lines as line_src

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _trips(spark):
    return parse.parse_trips(fixtures.trip_lines(spark, SF))


def _fares(spark):
    return parse.parse_fares(fixtures.fare_lines(spark, SF))


def _partial_before_exchange(plan: str, fn: str) -> bool:
    # tree text: the partial aggregate appears below (after) the hash exchange
    ex = plan.find("Exchange hashpartitioning")
    return ex >= 0 and plan.find(f"partial_{fn}", ex) > ex


def test_aggregates_combine_before_shuffle(spark):
    assert _partial_before_exchange(_plan(trending.trending(_trips(spark))), "count")
    s = payments.summary(payments.statement(_fares(spark), keep=("ts",)), stamp=False)
    assert _partial_before_exchange(_plan(s), "sum")
    assert _partial_before_exchange(_plan(merge.latest_by_key(_trips(spark))), "max_by")
    assert _partial_before_exchange(_plan(routes.cell_traffic(_trips(spark))), "count")


def test_no_broadcast_from_estimates(spark):
    j = merge.table_left_join(_fares(spark), _trips(spark))
    p = _plan(j)       # initial adaptive plan, before runtime statistics
    assert "BroadcastExchange" not in p and "SortMergeJoin" in p
    # aggregates on key feed the join directly: exactly one hash exchange per side
    assert p.count("Exchange hashpartitioning(key") == 2


def test_interval_join_is_bucketed_equi_join(spark):
    j = merge.interval_left_join(_fares(spark), _trips(spark), "ts", "ts")
    p = _plan(j)
    assert "SortMergeJoin [key" in p and "_bucket" in p and "LeftOuter" in p


def test_route_join_sort_merge(spark):
    p = _plan(routes.trip_route_cells(_trips(spark)))
    assert "SortMergeJoin" in p and "BroadcastExchange" not in p


def test_scan_prunes_columns(spark):
    p = _plan(_trips(spark))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_text_line_source(spark, tmp_path):
    f = tmp_path / "trips.csv"
    good = ("2013008681,2013007085,VTS,1,,2013-12-01 00:00:00,2013-12-01 00:06:00,6,360,1.24,"
            "-73.983803,40.743511,-73.990311,40.729755")
    header = "medallion, hack_license, vendor_id, rate_code, store_and_fwd_flag, pickup_datetime"
    f.write_text("\n".join([header, good, good.replace("00:00:00", "00:01:00", 1)]) + "\n")
    gated = line_src.read_lines(spark, str(f), "trip")
    assert gated.count() == 2
    every = line_src.read_lines(spark, str(f))
    assert every.count() == 3
    assert parse.parse_trips(gated).select(F.countDistinct("key")).first()[0] == 2


def test_refined_table_partition_pruning(spark, tmp_path):
    import datetime as dt
    from hackney.sources import tables
    trips = _trips(spark)
    path = str(tmp_path / "refined_trips")
    tables.write_refined(trips, path)
    part = tables.read_refined(spark, path, dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    p = _plan(part)
    assert "PartitionFilters: [isnotnull(pickup_date" in p
    want = trips.where((F.to_date("pickup_ts") >= "2024-01-10") & (F.to_date("pickup_ts") < "2024-01-12"))
    assert part.count() == want.count() > 0
