"""Nothing is left out: fixture rows, one-shot chains, plans without reshuffles, refined tables without a hot task."""

import os

import pytest
from pyspark.sql import functions as F

from hackney.operators import merge, parse, payments
from hackney.plans.catalog import REGISTRY
from hackney.sources import fixtures, kafka, tables
from hackney.sources.lines import read_lines
from hackney.streaming import services as svc

SF = "/root/testdata/sf0.001"


def test_every_event_gives_both_lines(spark):
    n = fixtures.events(spark, SF).count()
    assert fixtures.trip_lines(spark, SF).count() == fixtures.fare_lines(spark, SF).count() == n


@pytest.mark.parametrize("name", ["refined_trips", "refined_fares", "trending_pickup_grid", "latest_trips", "route_cells"])
def test_no_reshuffle_of_the_source(spark, name):
    plan = REGISTRY[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan


def test_latest_follows_the_order_of_the_files(spark, tmp_path):
    """Spark numbers the lines of the largest file first; the place does not."""
    line = "med,hack,VTS,2013-12-01 00:00:00,{},6.5,0.5,0.5,0,0,7.5\n"
    for name, text in (("a", line.format("OLD")), ("b", line.format("NEW") * 2000), ("c", line.format("LAST"))):
        (tmp_path / name).write_text(text)
    fares = parse.parse_fares(read_lines(spark, str(tmp_path), "fare"))
    (row,) = merge.latest_by_key(fares, order="place").collect()
    assert fares.count() == 2002 and row.payment_type == "LAST"


@pytest.mark.parametrize("name", ["route_cells", "route_cell_traffic"])
def test_walks_are_spread_and_exploded_after_the_join(spark, name):
    plan = REGISTRY[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    if name == "route_cells":
        assert plan.index("Generate posexplode") < plan.index("SortMergeJoin")
    assert plan.count("aggregate(") == 1


def test_key_is_formatted_once(spark):
    plan = parse.parse_trips(fixtures.trip_lines(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("date_format(pickup_ts") <= 1


def test_rows_without_time_are_spread(spark, tmp_path):
    fares = (parse.parse_fares(fixtures.fare_lines(spark, SF))
             .withColumn("pickup_ts", F.when(F.col("seq") % 3 > 0, F.col("pickup_ts"))))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_refined(fares, str(tmp_path / "t"), mode="overwrite")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = tables.read_refined(spark, str(tmp_path / "t"))
    none = back.where("pickup_ts is null").groupBy(F.input_file_name()).count().collect()
    assert back.count() == fares.count() and len(none) > 1
    assert max(r["count"] for r in none) < 0.8 * sum(r["count"] for r in none)


def test_one_shot_payments_are_complete(spark, tmp_path):
    """A single call writes the statements and, from all of them, the summary;
    windows on the pickup time, as a replay needs them."""
    fares = parse.parse_fares(fixtures.fare_lines(spark, SF))
    root = str(tmp_path / "topics")
    kafka.to_kafka_frame(fares, "key", parse.FARE_COLUMNS, keep=("seq", "ts")).write.json(f"{root}/{kafka.REFINED_FARE_TOPIC}")
    topics = svc.Topics(fmt="json", root=root, trigger={"availableNow": True}, checkpoint_root=str(tmp_path / "ckpt"))
    for q in svc.driver_payments(spark, topics, time_col="pickup_ts", lateness="3650 days"):
        q.awaitTermination(300)
        assert q.exception() is None
    out = f"{root}/{kafka.DRIVER_PAYMENT_SUMMARY_TOPIC}-changes"
    assert os.path.isdir(out)
    got = (spark.read.option("recursiveFileLookup", "true").json(out)
           .select("window_start", F.from_json("value", "hack_license string, total_amount double, payable_amount double").alias("v"))
           .select(F.col("window_start").cast("timestamp").alias("window_start"), "v.*"))
    want = payments.summary(payments.statement(fares.where("pickup_ts is not null"), keep=("pickup_ts",)), time_col="pickup_ts")

    def rows(df):
        return sorted((r.window_start, r.hack_license, round(r.total_amount, 4), round(r.payable_amount, 4)) for r in df.collect())
    assert rows(got) == rows(want) and len(rows(got)) > 100
