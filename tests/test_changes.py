"""Table join as a changelog, keyed tables, compaction, repeats, late rows."""

import datetime as dt
import time

from pyspark.sql import functions as F

from hackney.operators import documents, merge, parse, payments, trending
from hackney.sources import changelog, fixtures, kafka
from hackney.streaming import changes, jobs, late, services

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2013, 5, 1, 8, 0)
# Own rows in the raw formats.
TRIP = "77001,88001,CMT,1,N,2013-05-01 08:00:00,2013-05-01 08:10:00,{},600,2.5,-73.99,40.75,-73.98,40.76"
FARE = "77001,88001,CMT,2013-05-01 08:00:00,CRD,{},0.5,0.5,1.0,0,9.0"


def drop(spark, folder, rows):
    """One more file of (seq, seconds after T0, line) records."""
    spark.createDataFrame([(s, T0 + dt.timedelta(seconds=t), v) for s, t, v in rows], "seq long, ts timestamp, value string") \
        .coalesce(1).write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(folder)


def run(df, base, mode="update", name="q"):
    with changes.no_idle_batches(df.sparkSession):
        q = (df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/ckpt-{name}")
             .foreachBatch(changelog.batch_writer(f"{base}/{name}", "parquet")).trigger(availableNow=True).start())
    try:
        assert q.awaitTermination(60) and q.exception() is None
    finally:
        q.stop()
    return q


def joined(spark, base, **how):
    trips = parse.parse_trips(jobs.read_line_files(spark, f"{base}/trips", None))
    fares = parse.parse_fares(jobs.read_line_files(spark, f"{base}/fares", None))
    return changes.table_left_join_changes(fares, trips, **how)


def seen(spark, base, name="q"):
    rows = spark.read.parquet(f"{base}/{name}").collect()
    return sorted((r.batch_id, r.fare_seq, r.trip_seq if r.trip_seq is not None else -1, r.changed, r.fare_amount, r.passenger_count)
                  for r in rows)


def test_one_row_per_change(spark, tmp_path):
    base = str(tmp_path)
    drop(spark, f"{base}/fares", [(1, 0, FARE.format(5)), (2, 20, FARE.format(6))])
    drop(spark, f"{base}/trips", [(1, 10, TRIP.format(3)), (7, 30, TRIP.format(4))])
    df = joined(spark, base)
    run(df, base)
    # fare, trip, fare, trip by record time: four changes of one key in one micro-batch
    want = [(0, 1, -1, "fare", 5.0, None), (0, 1, 1, "trip", 5.0, 3), (0, 2, 1, "fare", 6.0, 3), (0, 2, 7, "trip", 6.0, 4)]
    assert seen(spark, base) == want
    drop(spark, f"{base}/trips", [(7, 30, TRIP.format(4)), (5, 25, TRIP.format(9))])     # a repeat and a stray
    drop(spark, f"{base}/fares", [(9, 40, FARE.format(7))])
    run(df, base)
    assert seen(spark, base) == [*want, (1, 9, 7, "fare", 7.0, 4)]
    now = changelog.latest(spark.read.parquet(f"{base}/q"), ["key"], changes.CHANGE_ORDER).collect()
    assert [(r.fare_seq, r.trip_seq) for r in now] == [(9, 7)]


def test_trip_alone_waits_for_its_fare(spark, tmp_path):
    base = str(tmp_path)
    drop(spark, f"{base}/trips", [(1, 10, TRIP.format(3))])
    drop(spark, f"{base}/fares", [])
    df = joined(spark, base)
    run(df, base)
    assert seen(spark, base) == []
    drop(spark, f"{base}/fares", [(4, 0, FARE.format(5))])
    run(df, base)
    assert seen(spark, base) == [(1, 4, 1, "fare", 5.0, 3)]


def held(spark, base, side):
    return spark.read.format("statestore").option("stateVarName", side).load(f"{base}/ckpt-q").count()


def test_idle_keys_leave_the_state(spark, tmp_path):
    base = str(tmp_path)
    other = FARE.replace("77001", "77002")
    drop(spark, f"{base}/fares", [(1, 0, FARE.format(5)), (2, 0, other.format(5))])
    drop(spark, f"{base}/trips", [(1, 10, TRIP.format(3))])
    df = joined(spark, base, ttl_seconds=20)
    run(df, base)
    assert (held(spark, base, "fare"), held(spark, base, "trip")) == (2, 1)
    time.sleep(21)
    drop(spark, f"{base}/trips", [(2, 20, TRIP.replace("77001", "77003").format(4))])
    run(df, base)
    run(df, base)
    assert held(spark, base, "fare") == 0 and held(spark, base, "trip") == 1
    drop(spark, f"{base}/trips", [(3, 30, TRIP.format(5))])      # its fare is forgotten
    run(df, base)
    assert [r[:3] for r in seen(spark, base)] == [(0, 1, -1), (0, 1, 1), (0, 2, -1)]


def test_keys_share_states(spark, tmp_path):
    """The same changes with a state a key and with three for all; a group's state
    holds few more records than are still last."""
    made, base = {}, str(tmp_path)
    lines = {f"77{k:03}": k for k in range(12)}
    for step in range(4):
        for side, line in (("fares", FARE), ("trips", TRIP)):
            drop(spark, f"{base}/{side}", [(100 * step + n, 50 * step + 7 * n, line.replace("77001", k).format(1 + step))
                                           for k, n in lines.items() if (n + step) % (3 if side == "trips" else 2)])
        for name, groups in (("keyed", None), ("shared", 3)):
            run(joined(spark, base, groups=groups), base, name=name)
            made[name] = sorted(map(str, spark.read.parquet(f"{base}/{name}").collect()))
        assert made["keyed"] == made["shared"] and len(made["shared"]) > 6 * (step + 1)
    held = spark.read.format("statestore").option("stateVarName", "held").load(f"{base}/ckpt-shared")
    sizes = held.groupBy("key").agg(F.sum(F.size("list_element.keys")).alias("n")).collect()
    assert 1 < len(sizes) <= 3 and sum(r.n for r in sizes) <= 2 * 24


def test_record_without_time_comes_first(spark, tmp_path):
    base = str(tmp_path)
    drop(spark, f"{base}/fares", [(1, 0, FARE.format(5)), (2, 20, FARE.format(6))])
    drop(spark, f"{base}/trips", [(1, 10, TRIP.format(3))])
    trips = parse.parse_trips(jobs.read_line_files(spark, f"{base}/trips", None)).withColumn("ts", F.lit(None).cast("timestamp"))
    fares = parse.parse_fares(jobs.read_line_files(spark, f"{base}/fares", None))
    for name, groups in (("keyed", None), ("shared", 3)):
        run(changes.table_left_join_changes(fares, trips, groups=groups), base, name=name)
        assert [r[1:4] for r in seen(spark, base, name)] == [(1, 1, "fare"), (2, 1, "fare")]


def test_last_changes_are_the_batch_join(spark, tmp_path):
    base = str(tmp_path)
    trips, fares = fixtures.trip_lines(spark, SF), fixtures.fare_lines(spark, SF)
    for name, lines in (("trips", trips), ("fares", fares)):
        lines.repartition(4).write.json(f"{base}/{name}")
    t = parse.parse_trips(jobs.read_line_files(spark, f"{base}/trips", 1))
    f = parse.parse_fares(jobs.read_line_files(spark, f"{base}/fares", 1))
    run(changes.table_left_join_changes(f, t), base)
    log = spark.read.parquet(f"{base}/q")
    cols = ["key", "fare_seq", "trip_seq", "total_amount", "trip_distance", "pickup_datetime", "dropoff_location"]
    got = changelog.latest(log, ["key"], changes.CHANGE_ORDER).select(*cols)
    want = merge.table_left_join(parse.parse_fares(fares), parse.parse_trips(trips)).select(*cols)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert log.count() > got.count() and log.select("batch_id").distinct().count() > 1


# ---- changelogs, keyed tables

def test_log_is_the_last_row_of_each_key(spark, tmp_path):
    path, schema = str(tmp_path / "log"), spark.createDataFrame([], "k string, v long").schema
    write = changelog.batch_writer(path)
    make = lambda *rows: spark.createDataFrame(list(rows), "k string, v long")      # noqa: E731
    assert changelog.read_log(spark, path, schema).count() == 0
    write(make(("a", 1), ("b", 1)), 0)
    write(make(("a", 2)), 1)
    write(make(("a", 3), ("c", None)), 2)
    write(make(("a", 4), ("c", None)), 2)                  # replayed
    def now():
        rows = changelog.latest(changelog.read_log(spark, path, schema), ["k"]).collect()
        return sorted((r.k, r.v, r.batch_id) for r in rows)
    want = [("a", 4, 2), ("b", 1, 0), ("c", None, 2)]
    assert now() == want
    assert changelog.compact(spark, path, schema, ["k"]) == 2 and now() == want
    assert changelog.numbered(spark, path, "batch_id") == [] and changelog.compact(spark, path, schema, ["k"]) is None
    write(make(("b", 9)), 3)
    assert now() == [("a", 4, 2), ("b", 9, 3), ("c", None, 2)]
    write(make(("a", 0)), 1)                               # left over from an interrupted compaction
    assert now() == [("a", 4, 2), ("b", 9, 3), ("c", None, 2)]
    (tmp_path / "log-snapshot" / "upto=3").mkdir()         # a snapshot that was not finished
    assert now() == [("a", 4, 2), ("b", 9, 3), ("c", None, 2)]
    assert changelog.compact(spark, path, schema, ["k"]) == 3 and now() == [("a", 4, 2), ("b", 9, 3), ("c", None, 2)]
    assert changelog.numbered(spark, path + "-snapshot", "upto") == [3]


def test_keyed_table_takes_documents_once(spark, tmp_path):
    schema = spark.createDataFrame([], "doc_id string, v long").schema
    table = changelog.KeyedTable(spark, str(tmp_path / "docs"), schema, ["doc_id"], fmt="json")
    first = spark.createDataFrame([("t+0+1", 1), ("t+0+2", 2), ("t+0+2", 2)], schema)
    table.upsert(first, 0)
    table.upsert(first, 0)                                                   # a replayed batch
    table.upsert(spark.createDataFrame([("t+0+2", 5), ("t+1+2", 6)], schema), 1)      # delivered again in another
    rows = lambda: sorted((r.doc_id, r.v) for r in table.read().collect())
    assert rows() == [("t+0+1", 1), ("t+0+2", 5), ("t+1+2", 6)]
    table.compact()
    assert rows() == [("t+0+1", 1), ("t+0+2", 5), ("t+1+2", 6)]


# ---- services

def service_topics(tmp_path, **how):
    return services.Topics(fmt="json", root=str(tmp_path / "topics"), trigger={"availableNow": True},
                           checkpoint_root=str(tmp_path / "ckpt"), **how)


def ended(*queries):
    for q in queries:
        assert q.awaitTermination(90) and q.exception() is None


def put(topics, topic, rows, partition=None):
    """Records into a folder topic, as a writer with a partition or without."""
    df = rows.select("seq", "ts", F.lit("").alias("key"), "value")
    if partition is not None:
        df = df.withColumn("partition", F.lit(partition))
    df.write.mode("append").json(f"{topics.root}/{topic}")


def test_documents_by_record_id(spark, tmp_path):
    topics, target = service_topics(tmp_path), str(tmp_path / "docs")
    lines = fixtures.trip_lines(spark, SF)
    put(topics, kafka.RAW_TRIP_TOPIC, lines)
    ended(services.refine_trips(spark, topics))
    ended(services.index_trips(spark, topics, target=target))
    n = parse.parse_trips(lines).count()
    schema = documents.trip_documents(parse.parse_trips(lines).withColumn("doc_id", F.lit("")), ("doc_id",)).schema
    table = services.document_table(spark, target, schema)
    ids = lambda: sorted(r.doc_id for r in table.read().collect())        # noqa: E731
    before = ids()
    assert len(before) == len(set(before)) == n and before[0].startswith("trips-refined-stream-topic+0+")
    # the index forgets where it was and gets every record again
    again = services.Topics(fmt="json", root=topics.root, trigger=topics.trigger, checkpoint_root=str(tmp_path / "lost"))
    ended(services.index_trips(spark, again, target=target))
    assert ids() == before
    # the same offset in another partition is another document
    put(topics, "two", lines.where("seq < 3"), 0)
    put(topics, "two", lines.where("seq < 3"), 1)
    seen = topics.read(spark, "two").select(documents.document_id("two").alias("i"))
    run(seen, str(tmp_path), "append", "ids")
    assert sorted(r.i for r in spark.read.parquet(f"{tmp_path}/ids").collect()) == sorted(
        f"two+{p}+{r.seq}" for p in (0, 1) for r in lines.where("seq < 3").collect())


def test_statements_written_twice_sum_once(spark, tmp_path):
    topics = service_topics(tmp_path)
    lines = fixtures.fare_lines(spark, SF)
    put(topics, kafka.RAW_FARE_TOPIC, lines)
    ended(services.refine_fares(spark, topics))
    ended(services.payment_statements(spark, topics))
    topic = f"{topics.root}/{kafka.DRIVER_PAYMENT_STATEMENT_TOPIC}"
    twice = spark.read.schema(services.FRAME_SCHEMA).option("timestampFormat", changelog.TIMESTAMPS).json(topic)
    rows = spark.createDataFrame(twice.collect(), twice.schema)
    twice_topics = service_topics(tmp_path / "twice")
    for _ in range(2):                                             # a writer that retried every batch
        rows.drop("partition", "batch_id").write.mode("append").json(
            f"{twice_topics.root}/{kafka.DRIVER_PAYMENT_STATEMENT_TOPIC}")
    ended(services.payment_summary(spark, twice_topics, window="1 day"))
    found = twice_topics.table(spark, kafka.DRIVER_PAYMENT_SUMMARY_TOPIC, ("window_start", "window_end", "key"))
    got = kafka.from_kafka_json(found, kafka.STATEMENT_SCHEMA, keep=("window_start",))
    want = payments.summary(payments.statement(parse.parse_fares(lines), keep=("ts",)), window="1 day", stamp=False)
    cents = lambda df: sorted((r.window_start, r.hack_license, round(r.total_amount, 6), round(r.payable_amount, 6))
                              for r in df.collect())
    assert cents(got) == cents(want)


def test_merged_topic_is_read_back(spark, tmp_path):
    topics, target = service_topics(tmp_path, max_per_trigger=2), str(tmp_path / "merged")
    trips, fares = fixtures.trip_lines(spark, SF), fixtures.fare_lines(spark, SF)
    put(topics, kafka.RAW_TRIP_TOPIC, trips.repartition(4))
    put(topics, kafka.RAW_FARE_TOPIC, fares.repartition(4))
    ended(services.refine_trips(spark, topics), services.refine_fares(spark, topics))
    ended(services.merge_trip_fares(spark, topics))
    ended(services.materialise_merged(spark, topics, target))
    want = merge.table_left_join(parse.parse_fares(fares), parse.parse_trips(trips))
    cols = ["key", "fare_seq", "trip_seq", "total_amount", "trip_distance", "dropoff_datetime", "pickup_location"]
    rows = lambda df: sorted(map(str, df.select(*cols).collect()))        # noqa: E731
    assert rows(services.merged_table(spark, target).read()) == rows(want)
    table = lambda: sorted((r.key, r.value) for r in topics.table(                # noqa: E731
        spark, kafka.MERGED_TRIP_FARES_TOPIC, order=changes.CHANGE_ORDER).collect())
    before = table()
    assert len(before) == want.count()
    topics.compact(spark, kafka.MERGED_TRIP_FARES_TOPIC, order=changes.CHANGE_ORDER)
    assert table() == before


def test_headers_and_back(spark):
    rows = spark.createDataFrame([("k", "v", "0+7", 3, T0), ("k", "v", None, None, None)],
                                 "key string, value string, txn string, fare_seq long, window_start timestamp")
    sent = kafka.with_headers(rows)
    assert sent.columns == ["key", "value", "headers"] and [len(r.headers) for r in sent.collect()] == [3, 0]
    back = kafka.from_headers(sent)
    assert [(r.txn, r.fare_seq, r.window_start, r.batch_id) for r in back.collect()] == [("0+7", 3, T0, None), (None,) * 4]
    assert kafka.with_headers(rows.select("key", "value")).columns == ["key", "value"]


# ---- late rows

def test_newest_first_loses_nothing_uncounted(spark, tmp_path):
    """Three months, one file each, the newest first."""
    topics, gate = service_topics(tmp_path, max_per_trigger=1), str(tmp_path / "gate")
    lines = fixtures.trip_lines(spark, SF)
    for month in (2, 1, 0):
        put(topics, kafka.RAW_TRIP_TOPIC, lines.withColumn("ts", F.expr(f"timestampadd(MONTH, {month}, ts)"))
            .withColumn("seq", F.col("seq") + month * 10**6).coalesce(1))
        time.sleep(1.1)                                             # file times order the stream
    ended(services.refine_trips(spark, topics))
    ended(*services.trending_grid_accounted(spark, topics, gate, lateness="2 days"))
    n = parse.parse_trips(lines).count()
    counted = late.counters(spark, gate).orderBy("batch_id").collect()
    assert sum(r.n_rows for r in counted) == 3 * n and len(counted) >= 3
    assert [r.clock for r in counted] == sorted(r.clock for r in counted)
    schema = services._refined(spark, topics, kafka.REFINED_TRIP_TOPIC, kafka.REFINED_TRIP_SCHEMA).schema
    side = late.late_rows(spark, gate, schema)
    assert side.count() == sum(r.n_late for r in counted) > 2 * n * 0.9
    main = topics.table(spark, kafka.TRENDING_PICKUP_GRID_TOPIC, ("window_start", "window_end", "key"))
    got = {}
    for r in main.collect():
        got[r.window_start, int(r.key)] = int(r.value)
    for r in trending.trending(side).collect():
        got[r.window_start, r.grid_id] = got.get((r.window_start, r.grid_id), 0) + r.pickups
    every = spark.read.schema(services.FRAME_SCHEMA).option("timestampFormat", changelog.TIMESTAMPS).json(
        f"{topics.root}/{kafka.REFINED_TRIP_TOPIC}")
    batch = trending.trending(kafka.from_kafka_json(every, kafka.REFINED_TRIP_SCHEMA, keep=("ts",)))
    assert got == {(r.window_start, r.grid_id): r.pickups for r in batch.collect()}


def test_gate_replays_a_batch_alike(spark, tmp_path):
    path = str(tmp_path / "gate")
    write = late.gate_writer(path, lateness="1 hour")
    rows = lambda *hours: spark.createDataFrame(                            # noqa: E731
        [(h, None if h is None else T0 + dt.timedelta(hours=h)) for h in hours], "h int, ts timestamp")
    write(rows(0, 2, None), 0)
    write(rows(1, 3, 2), 1)
    write(rows(1, 3, 2), 1)
    write(rows(), 2)
    write(rows(5, 1), 3)
    seen = [(r.n_rows, r.n_late, r.n_untimed, r.clock) for r in late.counters(spark, path).orderBy("batch_id").collect()]
    hour = lambda h: T0 + dt.timedelta(hours=h)                              # noqa: E731
    assert seen == [(3, 1, 1, hour(1)), (3, 1, 0, hour(2)), (0, 0, 0, hour(2)), (2, 1, 0, hour(4))]
    schema = rows(0).schema
    assert sorted(r.h for r in late.late_rows(spark, path, schema).collect()) == [0, 1, 1]
    run(late.on_time(spark, path, schema), str(tmp_path), "append", "main")
    assert sorted(r.h or -1 for r in spark.read.parquet(f"{tmp_path}/main").collect()) == [-1, 2, 2, 3, 5]


# ---- text lines in file order, hot keys, state

def text_stream(spark, folder, kind, rows):
    import os
    os.makedirs(folder, exist_ok=True)
    for name, lines in rows.items():
        with open(f"{folder}/{name}", "w") as out:
            out.write("\n".join(lines) + "\n")
    return jobs.read_text_lines(spark, folder, kind, files_per_trigger=None)


def test_lines_of_one_second_resolve_as_in_the_file(spark, tmp_path):
    many = [FARE.format(k) for k in range(1, 400)]
    fares = text_stream(spark, str(tmp_path / "fares"), "fare", {"a.csv": many, "b.csv": [FARE.format(7), FARE.format(5.5)]})
    trips = text_stream(spark, str(tmp_path / "trips"), "trip", {"a.csv": [TRIP.format(k) for k in (4, 2, 3)]})
    f, t = parse.parse_fares(fares), parse.parse_trips(trips)
    run(jobs.table_left_join_stream(f, t, order="place"), str(tmp_path), name="aggregate")
    got = spark.read.parquet(f"{tmp_path}/aggregate").collect()
    assert [(r.fare_amount, r.passenger_count) for r in got] == [(5.5, 3)]


def test_hot_key_spreads_over_tasks(spark, tmp_path):
    base = str(tmp_path)
    hours = [(k, 3600 * k) for k in range(24)]
    drop(spark, f"{base}/fares", [(k, t, FARE.format(k)) for k, t in hours])
    drop(spark, f"{base}/trips", [(100 + k, t + 60 * (k % 14), TRIP.format(3)) for k, t in hours])
    t = parse.parse_trips(jobs.read_line_files(spark, f"{base}/trips", None))
    f = parse.parse_fares(jobs.read_line_files(spark, f"{base}/fares", None))
    run(jobs.interval_left_join_stream(f, t, lateness="2 days"), base, "append", "j3")
    pairs = sorted((r.fare_seq, r.trip_seq) for r in spark.read.parquet(f"{base}/j3").collect())
    assert pairs == [(k, 100 + k) for k in range(24) if k % 14 <= 10]
    state = spark.read.format("statestore").option("joinSide", "left").load(f"{base}/ckpt-j3")
    assert state.count() == 24 and state.select("partition_id").distinct().count() > 3      # one key, many tasks


def test_state_holds_open_windows_only(spark, tmp_path):
    base = str(tmp_path)
    drop(spark, f"{base}/trips", [(1, 0, TRIP.format(1)), (2, 3600, TRIP.format(1)), (3, 7200, TRIP.format(1))])
    counts = trending.trending(parse.parse_trips(jobs.read_line_files(spark, f"{base}/trips", None)),
                               window="1 hour", slide="1 hour", watermark="2 hours")
    keys = lambda: spark.read.format("statestore").load(f"{base}/ckpt-w").count()       # noqa: E731
    run(counts, base, name="w")
    assert keys() == 3
    drop(spark, f"{base}/trips", [(4, 4 * 3600, TRIP.format(1))])        # the watermark moves to 10:00
    run(counts, base, name="w")
    drop(spark, f"{base}/trips", [(5, 4 * 3600, TRIP.format(1))])        # the next batch drops what it closed
    run(counts, base, name="w")
    assert keys() == 2                                                    # 10:00 and 12:00 are open
    drop(spark, f"{base}/trips", [(6, 4 * 3600, TRIP.format(1)), (7, 0, TRIP.format(1))])     # the last is too late
    run(counts, base, name="w")
    assert keys() == 2
    assert sorted(r.pickups for r in changelog.latest(spark.read.parquet(f"{base}/w"), ["window_start"]).collect()) == [1, 1, 1, 3]


def test_bucketed_join_has_no_exchange(spark):
    from hackney.plans.catalog import REGISTRY
    plan = REGISTRY["trip_fares_bucketed_join"][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" in plan and "SelectedBucketsCount" in plan
