"""Structured Streaming forms of the pipelines.

The batch operators are reused unchanged on streaming DataFrames (parsing,
cells, statements, windowed aggregates).  What differs is stated here:

* watermarks bound state (default one day, the usual retention for windowed
  state of this kind; rows later than it are dropped);
* the latest-per-key left join is one keyed aggregate over a tagged union,
  emitted in ``update`` mode (one row per changed key per micro-batch);
* the 10-minute left join is a stream-stream outer join with watermarks on
  both sides; unmatched fares are emitted once both watermarks pass;
* sinks are checkpointed under the shared checkpoint folder, and the
  payment summary can be written idempotently per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hackney.operators import merge, parse, payments, trending
from hackney.session import checkpoint_dir

DEFAULT_LATENESS = "1 day"
LINE_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.StringType()),
])


def read_line_files(spark: SparkSession, path: str, files_per_trigger: int | None = 1,
                    fmt: str = "json", schema: T.StructType = LINE_SCHEMA,
                    timestamp_format: str = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]") -> DataFrame:
    """Stream ``seq, ts, value`` records from files dropped into ``path``."""
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "json":
        r = r.option("timestampFormat", timestamp_format)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(path)


def read_text_lines(spark: SparkSession, path: str, kind: str,
                    files_per_trigger: int | None = 1) -> DataFrame:
    """Stream raw text lines as ``seq, ts, value, place``; the pickup time
    (replay gate) is the record time.

    Lines whose pickup field does not parse, headers included, are dropped.
    Plain text files carry no offsets: ``seq`` is the pickup time in
    microseconds, which lines of one second share.  ``place`` (file name, start
    of the split, line within the task's splits) is the order of the files; pass
    it as ``order`` to the latest-per-key joins.  Kafka sources use the offset.
    """
    r = spark.readStream.format("text")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    lines = r.load(path).select("value", F.col("_metadata.file_name").alias("file"),
                                F.col("_metadata.file_block_start").alias("block"))
    counted = lines.mapInArrow(_number_lines, "value string, file string, block long, line long")
    gated = parse.gate_lines(counted, kind)
    return gated.select(F.unix_micros("event_ts").alias("seq"),
                        F.col("event_ts").alias("ts"), "value", F.struct("file", "block", "line").alias("place"))


def _number_lines(batches):
    # A task reads its splits one after another and each from its start.
    # (Streams have no monotonically_increasing_id.)
    import pyarrow as pa
    at = 0
    for batch in batches:
        yield batch.append_column("line", pa.array(range(at, at + batch.num_rows), pa.int64()))
        at += batch.num_rows


def trending_stream(trips: DataFrame, time_col: str = "ts", window: str = trending.WINDOW,
                    slide: str = trending.SLIDE, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    return trending.trending(trips, time_col=time_col, window=window, slide=slide,
                             watermark=lateness)


def summary_stream(statements: DataFrame, time_col: str = "ts",
                   window: str = payments.SUMMARY_WINDOW,
                   lateness: str | None = DEFAULT_LATENESS, stamp: bool = True) -> DataFrame:
    """``lateness`` None: the records have a watermark already."""
    return payments.summary(statements, time_col=time_col, window=window,
                            watermark=lateness, stamp=stamp)


def table_left_join_stream(fares: DataFrame, trips: DataFrame, key: str = "key",
                           order: str = "seq", lateness: str | None = None,
                           pickup_col: str = "pickup_ts",
                           record_col: str = "ts") -> DataFrame:
    """Latest fare LEFT JOIN latest trip per key, as a streaming aggregate.

    Both sides go into one keyed state row holding the latest fare and the
    latest trip (``max_by`` on ``order``: the offset, or a text line's ``place``).  In ``update`` mode each
    micro-batch emits the current pair for every key it changed; a trip
    arriving later turns (fare, none) into (fare, trip); a trip without a
    fare emits nothing.

    State: without ``lateness`` it grows with the number of keys, as a
    latest-value table does.  With ``lateness`` the grouping also carries the
    1-minute window of the pickup time.  The key already encodes that
    minute, so the groups are the same.  Pickup times get a watermark, and a
    key's state is dropped once its minute is more than ``lateness`` behind.
    Records arriving later than that are dropped.  A fare whose pickup text
    did not parse (key ending ``-``) is windowed on its record time instead.
    """
    # only what the merged record reads: smaller state rows
    f_cols = ["seq", *merge.FARE_MERGE_COLUMNS]
    t_cols = ["seq", *merge.TRIP_MERGE_COLUMNS]
    rank = fares.schema[order].dataType
    fare_struct = F.struct(*[F.col(c).alias(c) for c in f_cols])
    trip_struct = F.struct(*[F.col(c).alias(c) for c in t_cols])
    def when_of(df):
        if lateness is None:
            return F.lit(None).cast("timestamp")
        return F.coalesce(F.col(pickup_col), F.col(record_col))
    f = fares.select(key, fare_struct.alias("_fare"), F.col(order).alias("_fseq"),
                     F.lit(None).cast(_struct_type(trips, t_cols)).alias("_trip"),
                     F.lit(None).cast(rank).alias("_tseq"), when_of(fares).alias("_when"))
    t = trips.select(key, F.lit(None).cast(_struct_type(fares, f_cols)).alias("_fare"),
                     F.lit(None).cast(rank).alias("_fseq"),
                     trip_struct.alias("_trip"), F.col(order).alias("_tseq"),
                     when_of(trips).alias("_when"))
    both = f.unionByName(t)
    groups = [key]
    if lateness is not None:
        both = both.withWatermark("_when", lateness)
        groups.append(F.window("_when", "1 minute"))
    state = (both.groupBy(*groups)
              .agg(F.max_by("_fare", "_fseq").alias("_fare"),
                   F.max_by("_trip", "_tseq").alias("_trip"))
              .where(F.col("_fare").isNotNull()))
    flat = state.select(key, *[F.col("_fare")[c].alias("f_" + c) for c in f_cols],
                        *[F.col("_trip")[c].alias("t_" + c) for c in t_cols])
    return merge.merge_record(flat, key=key)


def once(records: DataFrame, txn: str = "txn", time_col: str = "ts",
         lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Records without repeats: of those with equal ``txn`` (what a record was
    made from) the first.  A topic writer that retries a micro-batch appends its
    records again, so a reader that sums has to know them.  State is bounded by
    the watermark on ``time_col``, which later windows share."""
    return records.withWatermark(time_col, lateness).dropDuplicatesWithinWatermark([txn])


def _struct_type(df: DataFrame, cols: list[str]) -> T.StructType:
    fields = {f.name: f for f in df.schema.fields}
    return T.StructType([T.StructField(c, fields[c].dataType, True) for c in cols])


def interval_left_join_stream(fares: DataFrame, trips: DataFrame, fare_time: str = "ts",
                              trip_time: str = "ts",
                              within_seconds: int = merge.JOIN_WITHIN_SECONDS,
                              lateness: str = DEFAULT_LATENESS, key: str = "key",
                              bucket_seconds: int | None = None) -> DataFrame:
    """Fares LEFT JOIN trips of the same key within ``within_seconds``.

    The equi-key is (key, time bucket), as in the batch join: each fare has one
    bucket (``bucket_seconds`` wide, default twice the window), each trip is
    copied to the buckets its range touches (about two).  A pair meets once, an
    unmatched fare comes out once, and a hot key's state and work are spread
    over the tasks by time.

    Matches are emitted as they are found; an unmatched fare only once the
    watermark of both inputs has passed its time plus the window (an idle
    side holds output back).
    """
    f = fares.select(*[F.col(c).alias(c if c == key else "f_" + c) for c in fares.columns])
    t = trips.select(*[F.col(c).alias("_t_key" if c == key else "t_" + c) for c in trips.columns])
    ft, tt = "f_" + fare_time, "t_" + trip_time
    b_us = (bucket_seconds or 2 * within_seconds) * 1_000_000
    w_us = within_seconds * 1_000_000
    at = F.unix_micros(tt)
    f = f.withWatermark(ft, lateness).withColumn("_bucket", F.floor(F.unix_micros(ft) / F.lit(b_us)))
    t = t.withWatermark(tt, lateness).withColumn("_t_bucket", F.explode(F.sequence(
        F.floor((at - F.lit(w_us)) / F.lit(b_us)), F.floor((at + F.lit(w_us)) / F.lit(b_us)))))
    span = F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
    cond = ((F.col(key) == F.col("_t_key")) & (F.col("_bucket") == F.col("_t_bucket"))
            & (F.col(tt) >= F.col(ft) - span) & (F.col(tt) <= F.col(ft) + span))
    joined = f.join(t, cond, "leftOuter")
    return merge.merge_record(joined, key=key,
                              extra=[F.col(ft).alias("fare_ts"), F.col(tt).alias("trip_ts")])


def start(df: DataFrame, name: str, mode: str = "append", fmt: str = "memory",
          path: str | None = None, checkpoint: str | None = None,
          trigger: dict | None = None) -> StreamingQuery:
    """Start ``df``; its checkpoint is ``<spark.checkpoint.dir>/streams/<name>``
    unless given, so restarting a query of the same name resumes it."""
    spark = df.sparkSession
    checkpoint = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = (df.writeStream.queryName(name).format(fmt).outputMode(mode)
           .option("checkpointLocation", checkpoint))
    if path:
        w = w.option("path", path)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def idempotent_batches(path: str, fmt: str = "parquet"):
    """``foreachBatch`` function writing micro-batch ``n`` to ``path/batch_id=n``
    with overwrite, so a batch replayed after a failure replaces its own
    output instead of duplicating it (exactly-once with the checkpoint)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def latest_per_key(updates: DataFrame, keys: list[str], order: str = "batch_id") -> DataFrame:
    """Current table from ``update``-mode output: last row per key."""
    others = [c for c in updates.columns if c not in keys]
    return (updates.groupBy(*keys)
                   .agg(F.max_by(F.struct(*others), F.col(order)).alias("_r"))
                   .select(*keys, *[F.col("_r")[c].alias(c) for c in others if c != order]))
