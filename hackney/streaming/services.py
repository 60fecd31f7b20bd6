"""End-to-end streaming services, topic to topic.

Each service reads one or two topics, applies the library's operators and
writes a topic, checkpointed under the shared checkpoint folder:

==============================  ==========================================
``refine_trips`` / ``refine_fares``  raw lines -> refined JSON records, keyed
``merge_trip_fares``          latest fare LEFT JOIN latest trip, a row per change
``materialise_merged``        merged changes -> a table of the last row per key
``merge_trip_fares_windowed`` fare LEFT JOIN trips within 10 minutes
``trending_grid``             pickups per cell, 5-min windows every minute
``trending_grid_accounted``   the same, late trips kept and counted on the side
``driver_payments``           statement topic, then 2-min driver summary
``replay_lines``              text files -> raw topic (empty key), gated
``index_trips`` / ``index_fares``  refined records -> document index (or files)
==============================  ==========================================

:class:`Topics` hides where topics live: Kafka (``fmt="kafka"``, needs the
connector on the class path) or JSON folders (``fmt="json"``, used by the
tests).  Folder topics carry the Kafka metadata they need (``seq`` for the
offset, ``ts`` for the record time) as columns.

A topic that holds a table's changes is a changelog: in folder form one folder a
micro-batch below ``<topic>-changes``.  ``Topics.read`` streams its changes and
``Topics.table`` gives the table they describe.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hackney.functions.fields import minute_key, parse_time, split_fields
from hackney.operators import documents, parse, payments, trending
from hackney.session import checkpoint_dir
from hackney.sources import changelog, kafka
from hackney.streaming import changes as joins
from hackney.streaming import jobs
from hackney.streaming import late as lates

# A folder topic's records; one without a partition is in partition 0.
FRAME_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
    *kafka.META_SCHEMA.fields])


@dataclass
class Topics:
    fmt: str = "kafka"
    servers: str | None = None
    root: str | None = None
    trigger: dict | None = None            # None: run continuously
    checkpoint_root: str | None = None     # default: <spark.checkpoint.dir>/services
    max_per_trigger: int | None = None     # records (Kafka) or files (folders) per batch

    def checkpoint(self, spark: SparkSession, name: str) -> str:
        """Stable checkpoint folder of service ``name``: a restart resumes
        from where the previous run stopped."""
        root = self.checkpoint_root or f"{checkpoint_dir(spark).rstrip('/')}/services"
        return f"{root}/{name}"

    def read(self, spark: SparkSession, topic: str, changes: bool | None = None) -> DataFrame:
        """Streaming ``seq, ts, partition, key, value`` and meta columns of a
        topic, from the earliest.  ``changes``: read the topic's changelog
        (default: if it is one of the topics that are)."""
        if self.fmt == "kafka":
            return kafka.read_topic(spark, self.servers, topic, stream=True,
                                    max_offsets_per_trigger=self.max_per_trigger)
        if topic in kafka.CHANGELOG_TOPICS if changes is None else changes:
            df = changelog.stream_log(spark, f"{self.root}/{topic}-changes", FRAME_SCHEMA,
                                      files_per_trigger=self.max_per_trigger)
        else:
            r = spark.readStream.format("json").schema(FRAME_SCHEMA).option("timestampFormat", changelog.TIMESTAMPS)
            if self.max_per_trigger:
                r = r.option("maxFilesPerTrigger", self.max_per_trigger)
            df = r.load(f"{self.root}/{topic}")
        return df.withColumn("partition", F.coalesce("partition", F.lit(0)))

    def table(self, spark: SparkSession, topic: str, keys: tuple[str, ...] = ("key",),
              order: tuple[str, ...] | None = None) -> DataFrame:
        """The table that a changelog topic describes: the last record of each
        key, by ``order`` (default: micro-batch, or offset on Kafka)."""
        if self.fmt == "kafka":
            return changelog.latest(kafka.read_topic(spark, self.servers, topic, stream=False), keys, order or ("seq",))
        log = changelog.read_log(spark, f"{self.root}/{topic}-changes", FRAME_SCHEMA)
        return changelog.latest(log, keys, order or (changelog.BATCH,))

    def compact(self, spark: SparkSession, topic: str, keys: tuple[str, ...] = ("key",),
                order: tuple[str, ...] | None = None) -> int | None:
        """Fold a folder changelog's batches into one table (Kafka compacts its own)."""
        return changelog.compact(spark, f"{self.root}/{topic}-changes", FRAME_SCHEMA, keys, order or (changelog.BATCH,))

    def write(self, frame: DataFrame, topic: str, name: str,
              mode: str = "append") -> StreamingQuery:
        """Start writing a ``(seq?, ts?, key, value, meta?)`` frame to ``topic``."""
        ckpt = self.checkpoint(frame.sparkSession, name)
        if self.fmt == "kafka" and mode == "append":
            return kafka.write_topic(kafka.with_headers(frame), self.servers, topic,
                                     checkpoint=ckpt, output_mode=mode, trigger=self.trigger)
        w = frame.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", ckpt)
        if mode == "append":
            w = w.format("json").option("path", f"{self.root}/{topic}")
        elif self.fmt == "kafka":   # every change carries the number of its micro-batch
            def send(batch: DataFrame, batch_id: int) -> None:
                marked = batch.withColumn(changelog.BATCH, F.lit(batch_id).cast("long"))
                kafka.write_topic(kafka.with_headers(marked), self.servers, topic)
            w = w.foreachBatch(send)
        else:  # a changelog: one idempotent folder per micro-batch
            w = w.foreachBatch(jobs.idempotent_batches(f"{self.root}/{topic}-changes", "json"))
        return w.trigger(**(self.trigger or {"processingTime": "10 seconds"})).start()


def _frame(df: DataFrame, key_col: str | None, value_cols: list[str]) -> DataFrame:
    keep = tuple(c for c in ("seq", "ts", "txn") if c in df.columns)
    return kafka.to_kafka_frame(df, key_col, value_cols, keep=keep)


def refine_trips(spark: SparkSession, topics: Topics) -> StreamingQuery:
    raw = topics.read(spark, kafka.RAW_TRIP_TOPIC).select("seq", "ts", "value")
    refined = parse.parse_trips(raw)
    return topics.write(_frame(refined, "key", parse.TRIP_COLUMNS),
                        kafka.REFINED_TRIP_TOPIC, "refine_trips")


def refine_fares(spark: SparkSession, topics: Topics) -> StreamingQuery:
    raw = topics.read(spark, kafka.RAW_FARE_TOPIC).select("seq", "ts", "value")
    refined = parse.parse_fares(raw)
    return topics.write(_frame(refined, "key", parse.FARE_COLUMNS),
                        kafka.REFINED_FARE_TOPIC, "refine_fares")


def _refined(spark, topics, topic, schema) -> DataFrame:
    """Records of a JSON topic; with ``pickup_ts``/``dropoff_ts`` where the
    record has those texts, so every service can window on event time."""
    df = kafka.from_kafka_json(topics.read(spark, topic), schema, keep=("seq", "ts", "partition", "txn"))
    for name in ("pickup", "dropoff"):
        if f"{name}_datetime" in df.columns:
            df = df.withColumn(f"{name}_ts", parse_time(F.col(f"{name}_datetime")))
    return df


_MERGED = ["medallion", "hack_license", "vendor_id", "payment_type", "fare_amount", "surcharge",
           "mta_tax", "tip_amount", "tolls_amount", "total_amount", "rate_code",
           "store_and_fwd_flag", "passenger_count", "trip_time_in_secs", "trip_distance",
           "pickup_datetime", "dropoff_datetime", "pickup_location", "dropoff_location"]


def merge_trip_fares(spark: SparkSession, topics: Topics, lateness: str | None = None,
                     ttl_seconds: int | None = None) -> StreamingQuery:
    """Latest fare LEFT JOIN latest trip per key: one row per change, state
    dropped ``ttl_seconds`` after a side's last change (default: kept).

    With ``lateness`` instead the state is bounded by the pickup time, and
    changes of a key within one micro-batch come out as its last one
    (:func:`hackney.streaming.jobs.table_left_join_stream`)."""
    trips = _refined(spark, topics, kafka.REFINED_TRIP_TOPIC, kafka.REFINED_TRIP_SCHEMA)
    fares = _refined(spark, topics, kafka.REFINED_FARE_TOPIC, kafka.REFINED_FARE_SCHEMA)
    if lateness is not None:
        merged = jobs.table_left_join_stream(fares, trips, lateness=lateness)
    else:
        merged = joins.table_left_join_changes(fares, trips, ttl_seconds=ttl_seconds)
    frame = kafka.to_kafka_frame(merged, "key", _MERGED, keep=joins.CHANGE_ORDER)
    if ttl_seconds is not None and "availableNow" in (topics.trigger or {}):
        with joins.no_idle_batches(spark):
            return topics.write(frame, kafka.MERGED_TRIP_FARES_TOPIC, "merge_trip_fares", mode="update")
    return topics.write(frame, kafka.MERGED_TRIP_FARES_TOPIC, "merge_trip_fares", mode="update")


MERGED_TABLE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), *kafka.MERGED_SCHEMA.fields,
    T.StructField("fare_seq", T.LongType()), T.StructField("trip_seq", T.LongType())])


def merged_table(spark: SparkSession, target: str) -> changelog.KeyedTable:
    return changelog.KeyedTable(spark, target, MERGED_TABLE_SCHEMA, ["key"], joins.CHANGE_ORDER)


def materialise_merged(spark: SparkSession, topics: Topics, target: str) -> StreamingQuery:
    """Merged changes -> the table of each key's last record at ``target``
    (`merged_table` reads it).  Changes delivered again leave it as it is."""
    log = topics.read(spark, kafka.MERGED_TRIP_FARES_TOPIC)
    rows = kafka.from_kafka_json(log, kafka.MERGED_SCHEMA, keep=joins.CHANGE_ORDER).select(*MERGED_TABLE_SCHEMA.names)
    return (rows.writeStream.queryName("materialise_merged")
            .option("checkpointLocation", topics.checkpoint(spark, "materialise_merged"))
            .foreachBatch(merged_table(spark, target).upsert)
            .trigger(**(topics.trigger or {"processingTime": "10 seconds"})).start())


def merge_trip_fares_windowed(spark: SparkSession, topics: Topics, lateness: str = jobs.DEFAULT_LATENESS,
                              time_col: str = "ts") -> StreamingQuery:
    """Fare LEFT JOIN trips within 10 minutes on ``time_col`` of both sides."""
    trips = _refined(spark, topics, kafka.REFINED_TRIP_TOPIC, kafka.REFINED_TRIP_SCHEMA)
    fares = _refined(spark, topics, kafka.REFINED_FARE_TOPIC, kafka.REFINED_FARE_SCHEMA)
    merged = jobs.interval_left_join_stream(fares, trips, fare_time=time_col, trip_time=time_col, lateness=lateness)
    frame = kafka.to_kafka_frame(merged, "key", _MERGED, keep=joins.CHANGE_ORDER)
    return topics.write(frame, kafka.MERGED_TRIP_FARES_TOPIC, "merge_trip_fares_windowed")


def _grid_changes(topics: Topics, counts: DataFrame, name: str) -> StreamingQuery:
    """Changes of the counts, keyed by cell; the window goes along as meta columns."""
    kv = trending.as_key_value(counts, keep=("window_start", "window_end"))
    if topics.fmt == "kafka":
        frame = kafka.to_int_frame(kv, keep=("window_start", "window_end"))
    else:
        frame = kv.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})
    return topics.write(frame, kafka.TRENDING_PICKUP_GRID_TOPIC, name, mode="update")


def trending_grid(spark: SparkSession, topics: Topics, time_col: str = "ts",
                  lateness: str = jobs.DEFAULT_LATENESS) -> StreamingQuery:
    trips = _refined(spark, topics, kafka.REFINED_TRIP_TOPIC, kafka.REFINED_TRIP_SCHEMA)
    counts = jobs.trending_stream(trips, time_col=time_col, lateness=lateness)
    return _grid_changes(topics, counts, "trending_grid")


def trending_grid_accounted(spark: SparkSession, topics: Topics, gate: str, time_col: str = "ts",
                            lateness: str = jobs.DEFAULT_LATENESS) -> list[StreamingQuery]:
    """Trips through the late gate at ``gate``, then the grid over those on time.
    Late trips and counters: `hackney.streaming.late`.  In one-shot mode the grid
    starts when the gate is done."""
    trips = _refined(spark, topics, kafka.REFINED_TRIP_TOPIC, kafka.REFINED_TRIP_SCHEMA)
    gated = (trips.writeStream.queryName("trip_gate").option("checkpointLocation", topics.checkpoint(spark, "trip_gate"))
             .foreachBatch(lates.gate_writer(gate, time_col, lateness))
             .trigger(**(topics.trigger or {"processingTime": "10 seconds"})).start())
    if "availableNow" in (topics.trigger or {}):
        gated.awaitTermination()
    main = lates.on_time(spark, gate, trips.schema, topics.max_per_trigger)
    counts = jobs.trending_stream(main, time_col=time_col, lateness=lateness)
    return [gated, _grid_changes(topics, counts, "trending_grid_accounted")]


def payment_statements(spark: SparkSession, topics: Topics,
                       excluded=payments.EXCLUDED_PAYMENT_TYPES) -> StreamingQuery:
    """Eligible fares -> payment lines keyed by driver (the statement topic
    is also the re-keying shuffle).  A line's ``txn`` is its fare record's
    partition and offset: a line written again is known by it."""
    fares = _refined(spark, topics, kafka.REFINED_FARE_TOPIC, kafka.REFINED_FARE_SCHEMA)
    fares = fares.withColumn("txn", F.concat_ws("+", F.col("partition").cast("string"), F.col("seq").cast("string")))
    stmt = payments.statement(fares, keep=("seq", "ts", "txn"), excluded=excluded)
    return topics.write(_frame(stmt, "hack_license", ["hack_license", "pickup_datetime",
                                                     "total_amount", "payable_amount"]),
                        kafka.DRIVER_PAYMENT_STATEMENT_TOPIC, "payment_statement")


def payment_summary(spark: SparkSession, topics: Topics, time_col: str = "ts",
                    window: str = payments.SUMMARY_WINDOW,
                    lateness: str = jobs.DEFAULT_LATENESS) -> StreamingQuery:
    """Statement topic -> per-driver sums per window, as a changelog.  Each
    statement counts once, however often it was written; a summary record is
    marked by its window, driver and micro-batch."""
    back = _refined(spark, topics, kafka.DRIVER_PAYMENT_STATEMENT_TOPIC, kafka.STATEMENT_SCHEMA)
    place = F.concat_ws("+", F.lit("at"), F.col("partition").cast("string"), F.col("seq").cast("string"))
    back = jobs.once(back.withColumn("txn", F.coalesce("txn", place)), "txn", time_col, lateness)
    summary = jobs.summary_stream(back, time_col=time_col, window=window, lateness=None)
    out = kafka.to_kafka_frame(summary, "hack_license",
                               ["hack_license", "total_amount", "payable_amount", "txn_date"],
                               keep=("window_start", "window_end"))
    return topics.write(out, kafka.DRIVER_PAYMENT_SUMMARY_TOPIC, "payment_summary", mode="update")


def driver_payments(spark: SparkSession, topics: Topics, **kw) -> list[StreamingQuery]:
    """Both payment stages: statements, and the summary reading them back.

    In one-shot mode the summary starts when the statements are complete, so
    that it reads all of them."""
    statements = payment_statements(spark, topics)
    if "availableNow" in (topics.trigger or {}):
        statements.awaitTermination()
    return [statements, payment_summary(spark, topics, **kw)]


def replay_lines(spark: SparkSession, path: str, kind: str, topics: Topics,
                 topic: str | None = None) -> StreamingQuery:
    """Text files -> raw topic, keyed by the correlation key, so that a replay
    spreads over all partitions and a key's records keep their order.  Headers
    and lines with a bad pickup time are dropped.  In folder topics the pickup
    time becomes the record time; a Kafka topic stamps its own, so windows of a
    replay take ``time_col="pickup_ts"``."""
    lines = jobs.read_text_lines(spark, path, kind, files_per_trigger=None)
    idx = parse.TRIP_PICKUP_FIELD if kind == "trip" else parse.FARE_PICKUP_FIELD
    frame = lines.select("seq", "ts", minute_key(split_fields(F.col("value")), idx).alias("key"), "value")
    topic = topic or (kafka.RAW_TRIP_TOPIC if kind == "trip" else kafka.RAW_FARE_TOPIC)
    return topics.write(frame, topic, f"replay_{kind}")


def write_documents(batch: DataFrame, fmt: str, target: str, options: dict | None = None,
                    id_col: str = "doc_id") -> None:
    """Write one batch of documents under their ids; ``fmt`` is a DataFrame
    writer format (the index connector's ``org.elasticsearch.spark.sql`` when its
    jar is on the class path).  A document written again replaces itself."""
    by_id = {"es.mapping.id": id_col, "es.mapping.exclude": id_col, "es.write.operation": "index"}
    batch.write.mode("append").format(fmt).options(**{**by_id, **(options or {})}).save(target)


def document_table(spark: SparkSession, target: str, schema: T.StructType, fmt: str = "json") -> changelog.KeyedTable:
    """Documents on a shared folder, one row an id (for ``index_*`` with files)."""
    return changelog.KeyedTable(spark, target, schema, ["doc_id"], fmt=fmt)


def _index(spark: SparkSession, topics: Topics, docs: DataFrame, name: str, fmt: str, target: str,
           options: dict | None) -> StreamingQuery:
    if fmt in ("json", "parquet"):
        write = document_table(spark, target, docs.schema, fmt).upsert
    else:
        def write(batch: DataFrame, batch_id: int) -> None:
            write_documents(batch, fmt, target, options)
    return (docs.writeStream.queryName(name).option("checkpointLocation", topics.checkpoint(spark, name))
                .foreachBatch(write)
                .trigger(**(topics.trigger or {"processingTime": "10 seconds"})).start())


def index_trips(spark: SparkSession, topics: Topics, fmt: str = "json",
                target: str | None = None, options: dict | None = None) -> StreamingQuery:
    """Refined trips -> trip documents (index ``nyc_tlc_trips``) by record id."""
    trips = _refined(spark, topics, kafka.REFINED_TRIP_TOPIC, kafka.REFINED_TRIP_SCHEMA)
    docs = documents.trip_documents(trips.withColumn("doc_id", documents.document_id(kafka.REFINED_TRIP_TOPIC)),
                                    keep=("doc_id",))
    return _index(spark, topics, docs, "index_trips", fmt, target or documents.TRIP_INDEX, options)


def index_fares(spark: SparkSession, topics: Topics, fmt: str = "json",
                target: str | None = None, options: dict | None = None) -> StreamingQuery:
    """Refined fares -> fare documents (index ``nyc_tlc_fares``, amounts FLOAT) by record id."""
    fares = _refined(spark, topics, kafka.REFINED_FARE_TOPIC, kafka.REFINED_FARE_SCHEMA)
    docs = documents.fare_documents(fares.withColumn("doc_id", documents.document_id(kafka.REFINED_FARE_TOPIC)),
                                    keep=("doc_id",))
    return _index(spark, topics, docs, "index_fares", fmt, target or documents.FARE_INDEX, options)
