"""Registered queries that run the streaming jobs over the given tables, and the
table join of bucketed tables.

Each stream reads ``events`` as a stream, runs the job once over all of it (one-shot
trigger), and returns the final state as a table, which must equal the batch
oracle.  Topics, state and checkpoints live below ``spark.checkpoint.dir``, a
new folder for each call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.operators import documents, merge, parse, payments, trending
from hackney.plans import catalog as C
from hackney.plans import oracle as O
from hackney.session import checkpoint_dir
from hackney.sources import changelog, fixtures, kafka
from hackney.sources.tables import read_table, write_bucketed
from hackney.streaming import changes, jobs, late
from hackney.streaming.services import document_table, merged_table


STATE_GROUPS = 8192            # at tens of millions of keys some thousand each


def _work(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/hackney-{name}-{uuid.uuid4().hex}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream.  A file source wants a folder or a glob; this one
    names the table whether it is a file or a folder."""
    schema = read_table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/event[s].parquet")


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_trips(fixtures.trip_lines_from_events(spark, _events(spark, sf_dir)))


def _fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_fares(fixtures.fare_lines_from_events(spark, _events(spark, sf_dir)))


def _run(df: DataFrame, write, checkpoint: str, mode: str = "append") -> None:
    query = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .foreachBatch(write).trigger(availableNow=True).start())
    query.awaitTermination()


def _log(df: DataFrame, path: str, mode: str = "update") -> DataFrame:
    """Run ``df`` into a changelog; its rows."""
    _run(df, changelog.batch_writer(path, "parquet"), f"{path}-checkpoint", mode)
    return changelog.read_log(df.sparkSession, path, df.schema, "parquet")


@C.register("stream_trip_fares_final", C.REGISTRY["trip_fares_table_join"][1])
def q_stream_trip_fares_final(spark, sf_dir):
    """Every change of the table join goes to a keyed table: its last rows.  The
    one micro-batch holds all records, so keys share their states."""
    merged = changes.table_left_join_changes(_fares(spark, sf_dir), _trips(spark, sf_dir), groups=STATE_GROUPS).drop("changed")
    path = _work(spark, "merged")
    table = changelog.KeyedTable(spark, path, merged.schema, ["key"], changes.CHANGE_ORDER)
    _run(merged, table.upsert, f"{path}-checkpoint", "update")
    return C.flat_merged(table.read().drop(changelog.BATCH))


@C.register("stream_trending_final", C.REGISTRY["trending_pickup_grid"][1])
def q_stream_trending_final(spark, sf_dir):
    """The grid's changelog, its last row per window and cell."""
    counts = jobs.trending_stream(_trips(spark, sf_dir))
    log = _log(counts, _work(spark, "grid"))
    return changelog.latest(log, ["window_start", "window_end", "grid_id"]).drop(changelog.BATCH)


@C.register("stream_trip_document_ids", O.with_ctes(
    f"select '{kafka.REFINED_TRIP_TOPIC}+0+' || seq as doc_id, 1::bigint as n_rows, medallion, pickup_datetime, "
    "passenger_count from trips"))
def q_stream_trip_document_ids(spark, sf_dir):
    """Documents by record id, every record delivered twice: one row an id."""
    trips = _trips(spark, sf_dir).withColumn("partition", F.lit(0))
    docs = documents.trip_documents(trips.withColumn("doc_id", documents.document_id(kafka.REFINED_TRIP_TOPIC)), ("doc_id",))
    path = _work(spark, "documents")
    table = document_table(spark, path, docs.schema, "parquet")

    def deliver(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, 2 * batch_id)
        table.upsert(batch, 2 * batch_id + 1)
    _run(docs, deliver, f"{path}-checkpoint")
    return (table.read().groupBy("doc_id", "medallion", "pickup_datetime", "passenger_count")
            .agg(F.count(F.lit(1)).alias("n_rows")))


@C.register("stream_payment_summary_once", C.REGISTRY["driver_payment_summary"][1])
def q_stream_payment_summary_once(spark, sf_dir):
    """Statements written twice to their topic, summed once."""
    lines = payments.statement(_fares(spark, sf_dir).withColumn("txn", F.concat_ws("+", F.lit("0"), F.col("seq"))),
                               keep=("seq", "ts", "txn"))
    topic = _work(spark, "statements")

    def write(batch: DataFrame, batch_id: int) -> None:
        for copy in range(2):
            changelog.batch_writer(topic, "parquet")(batch, 2 * batch_id + copy)
    _run(lines, write, f"{topic}-checkpoint")
    again = jobs.once(changelog.stream_log(spark, topic, lines.schema, "parquet"), "txn", "ts")
    log = _log(jobs.summary_stream(again, lateness=None, stamp=False), _work(spark, "summary"))
    final = changelog.latest(log, ["window_start", "window_end", "hack_license"])
    return C.summary_out(final.drop(changelog.BATCH))


@C.register("stream_trending_late", O.with_ctes(
    "select window_start, window_end, grid_id, count(*) filter (not late) as pickups, count(*) filter (late) as late_pickups from "
    + O.hopping("grid_id, late", "(select ts, grid_id, ts < (select max(ts) from trips) - interval 1 day as late "
                "from cells where grid_id > -1)", "ts", O.MINUTE_US, 5 * O.MINUTE_US)
    + " group by window_start, window_end, grid_id"))
def q_stream_trending_late(spark, sf_dir):
    """Pickups counted by the stream, and those of late trips kept on the side:
    together all pickups."""
    trips = _trips(spark, sf_dir).select("ts", "pickup_location")
    gate = _work(spark, "gate")
    _run(trips, late.gate_writer(gate), f"{gate}-checkpoint")
    by = ["window_start", "window_end", "grid_id"]
    log = _log(jobs.trending_stream(late.on_time(spark, gate, trips.schema)), _work(spark, "grid"))
    none = F.lit(0).cast("long")
    main = changelog.latest(log, by).select(*by, "pickups", none.alias("late_pickups"))
    side = trending.trending(late.late_rows(spark, gate, trips.schema)).select(
        *by, none.alias("pickups"), F.col("pickups").alias("late_pickups"))
    return main.unionByName(side).groupBy(*by).agg(F.sum("pickups").alias("pickups"), F.sum("late_pickups").alias("late_pickups"))


@C.register("trip_fares_bucketed_join", C.REGISTRY["trip_fares_table_join"][1])
def q_trip_fares_bucketed_join(spark, sf_dir):
    """The table join over refined tables that are bucketed by key: no exchange."""
    tables = []
    for name, rows in (("trips", C.trips(spark, sf_dir)), ("fares", C.fares(spark, sf_dir))):
        path = _work(spark, name)
        table = path.rpartition("/")[2].replace("-", "_")
        write_bucketed(rows, table, path, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
        tables.append(spark.table(table))
    return C.flat_merged(merge.table_left_join(tables[1], tables[0]))
