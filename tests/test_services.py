"""Services chained over JSON-folder topics equal the batch queries."""

import tempfile

from pyspark.sql import functions as F

from hackney.operators import merge, parse, payments, trending
from hackney.sources import fixtures, kafka
from hackney.streaming import services

SF = "/root/testdata/sf0.001"


def _await(*qs):
    for q in qs:
        q.awaitTermination(600)
        assert q.exception() is None


def test_services_chain(spark):
    root = tempfile.mkdtemp(prefix="hk-svc-")
    topics = services.Topics(fmt="json", root=root, trigger={"availableNow": True},
                             checkpoint_root=f"{root}/_checkpoints")
    for kind, lines in (("trips", fixtures.trip_lines(spark, SF)),
                        ("fares", fixtures.fare_lines(spark, SF))):
        topic = kafka.RAW_TRIP_TOPIC if kind == "trips" else kafka.RAW_FARE_TOPIC
        lines.select("seq", "ts", F.lit("").alias("key"), "value").write.json(f"{root}/{topic}")
    _await(services.refine_trips(spark, topics), services.refine_fares(spark, topics))

    # refined topics hold JSON records keyed by the correlation key
    rt = spark.read.json(f"{root}/{kafka.REFINED_TRIP_TOPIC}")
    assert rt.count() == parse.parse_trips(fixtures.trip_lines(spark, SF)).count()

    _await(services.trending_grid(spark, topics), services.merge_trip_fares(spark, topics),
           services.payment_statements(spark, topics),
           services.index_trips(spark, topics, target=f"{root}/docs"),
           services.index_fares(spark, topics, target=f"{root}/fare_docs"))
    _await(services.payment_summary(spark, topics, window="1 day"))

    kv = spark.read.json(f"{root}/{kafka.TRENDING_PICKUP_GRID_TOPIC}-changes")
    batch_kv = trending.as_key_value(trending.trending(parse.parse_trips(fixtures.trip_lines(spark, SF))))
    assert sorted((int(r.key), int(r.value)) for r in kv.collect()) == \
        sorted((r.key, r.value) for r in batch_kv.collect())

    merged = spark.read.json(f"{root}/{kafka.MERGED_TRIP_FARES_TOPIC}-changes")
    batch_m = merge.table_left_join(parse.parse_fares(fixtures.fare_lines(spark, SF)),
                                    parse.parse_trips(fixtures.trip_lines(spark, SF)))
    assert merged.select("key").distinct().count() == batch_m.count()

    summ = spark.read.json(f"{root}/{kafka.DRIVER_PAYMENT_SUMMARY_TOPIC}-changes")
    batch_s = payments.summary(payments.statement(parse.parse_fares(fixtures.fare_lines(spark, SF)),
                                                  keep=("ts",)), window="1 day", stamp=False)
    assert summ.count() == batch_s.count()
    vals = summ.select(F.from_json("value", "total_amount double, txn_date string").alias("v"))
    assert vals.where(F.col("v.txn_date").isNull()).count() == 0

    docs = spark.read.json(f"{root}/docs")
    assert set(docs.columns) >= {"medallion", "pickup_location", "trip_time_in_secs"}
    fdocs = spark.read.json(f"{root}/fare_docs")
    assert fdocs.count() == parse.parse_fares(fixtures.fare_lines(spark, SF)).count()


def test_int_frame_bytes(spark):
    df = spark.createDataFrame([(51297, 3), (-1, 1)], "key int, value int")
    rows = kafka.to_int_frame(df).collect()
    assert bytes(rows[0].key) == (51297).to_bytes(4, "big")
    assert bytes(rows[1].key) == (-1).to_bytes(4, "big", signed=True)
    assert bytes(rows[0].value) == (3).to_bytes(4, "big")


def test_replay_lines(spark, tmp_path):
    from hackney.streaming import services as svc
    src = tmp_path / "raw"
    src.mkdir()
    good = "2013008681,2013007085,VTS,2013-12-01 00:00:00,CSH,6.5,0.5,0.5,0,0,7.5"
    header = "medallion, hack_license, vendor_id, pickup_datetime, payment_type"
    (src / "fares.csv").write_text("\n".join([header, good, good.replace(":00:00", ":05:00")]) + "\n")
    topics = svc.Topics(fmt="json", root=str(tmp_path / "topics"), trigger={"availableNow": True},
                        checkpoint_root=str(tmp_path / "ckpt"))
    q = svc.replay_lines(spark, str(src), "fare", topics)
    q.awaitTermination(300)
    assert q.exception() is None
    out = spark.read.json(str(tmp_path / "topics" / kafka.RAW_FARE_TOPIC))
    rows = out.collect()
    assert len(rows) == 2 and {r.key for r in rows} == {"20130086812013007085201312010000", "20130086812013007085201312010005"}


def test_service_restart_resumes(spark, tmp_path):
    from hackney.streaming import services as svc
    root = str(tmp_path / "topics")
    topics = svc.Topics(fmt="json", root=root, trigger={"availableNow": True},
                        checkpoint_root=str(tmp_path / "ckpt"), max_per_trigger=2)
    fares = fixtures.fare_lines(spark, SF).select("seq", "ts", F.lit("").alias("key"), "value")
    raw = f"{root}/{kafka.RAW_FARE_TOPIC}"
    fares.where("seq < 500").write.json(raw)
    for part in ("a", "b"):
        if part == "b":   # new files arrive after the first run
            fares.where("seq >= 500").write.mode("append").json(raw)
        q = svc.refine_fares(spark, topics)
        q.awaitTermination(300)
        assert q.exception() is None
    out = spark.read.json(f"{root}/{kafka.REFINED_FARE_TOPIC}")
    want = parse.parse_fares(fixtures.fare_lines(spark, SF))
    assert out.count() == want.count() == out.select("seq").distinct().count()


def test_command_line_service(spark, tmp_path):
    import os
    import subprocess
    import sys
    root = tmp_path / "topics"
    fares = fixtures.fare_lines(spark, SF).select("seq", "ts", F.lit("").alias("key"), "value")
    fares.write.json(str(root / kafka.RAW_FARE_TOPIC))
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=repo)
    r = subprocess.run([sys.executable, "-m", "hackney.streaming", "refine_fares",
                        "--root", str(root), "--available-now", "--master", "local[2]",
                        "--checkpoints", str(tmp_path / "ckpt")],
                       cwd=repo, env=env, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    out = spark.read.json(str(root / kafka.REFINED_FARE_TOPIC))
    assert out.count() == parse.parse_fares(fixtures.fare_lines(spark, SF)).count()


def test_windowed_merge_service_matches(spark, tmp_path):
    from hackney.streaming import services as svc
    root = str(tmp_path / "topics")
    topics = svc.Topics(fmt="json", root=root, trigger={"availableNow": True},
                        checkpoint_root=str(tmp_path / "ckpt"))
    for lines, topic in ((fixtures.trip_lines(spark, SF), kafka.RAW_TRIP_TOPIC),
                         (fixtures.fare_lines(spark, SF), kafka.RAW_FARE_TOPIC)):
        lines.select("seq", "ts", F.lit("").alias("key"), "value").write.json(f"{root}/{topic}")
    _await(svc.refine_trips(spark, topics), svc.refine_fares(spark, topics))
    _await(svc.merge_trip_fares_windowed(spark, topics, lateness="1 hour"))
    out = spark.read.json(f"{root}/{kafka.MERGED_TRIP_FARES_TOPIC}")
    got = sorted((r.fare_seq, r.trip_seq) for r in out.where("trip_seq is not null").collect())
    batch = merge.interval_left_join(parse.parse_fares(fixtures.fare_lines(spark, SF)),
                                     parse.parse_trips(fixtures.trip_lines(spark, SF)), "ts", "ts")
    want = sorted((r.fare_seq, r.trip_seq) for r in batch.where("trip_seq is not null").collect())
    assert got == want and len(got) > 0
