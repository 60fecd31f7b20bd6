"""Late rows kept and counted instead of dropped.

A windowed aggregate drops rows behind its watermark without a trace.  The gate
stands before it: every micro-batch raises a clock (latest time so far less the
lateness), and rows behind the clock go to the late side of the batch's folder,
the others to the main side, in one write.  The counters of each batch (rows,
late rows, rows without a time, the clock) are taken by `observe` in that write.

The clock of a batch includes the batch itself.  So whatever share of the main
rows an aggregate with the same lateness has read, its watermark is not above
the clock of any row still to come, and it drops none of them: main rows are
counted by the aggregate, late rows lie on the side, and both together are all
rows.  (A row that moves the clock past others of its own batch sends them to
the side; they are kept there like any others.)

Folders: ``<path>/batch_id=<n>/late=<true|false>`` and ``<path>-clock/batch_id=<n>``,
both replaced when a batch is replayed, with the same clock as before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.sources import changelog
from hackney.streaming.jobs import DEFAULT_LATENESS

COUNTERS = "batch_id long, n_rows long, n_late long, n_untimed long, clock timestamp"


def gate_writer(path: str, time_col: str = "ts", lateness: str = DEFAULT_LATENESS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that splits a batch at the clock."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = batch.agg((F.max(time_col) - F.expr(f"INTERVAL {lateness}")).alias("clock"))
        if batch_id > 0:      # each batch stores the clock that holds behind it
            before = spark.read.schema(COUNTERS).json(f"{path}-clock/batch_id={batch_id - 1}").select("clock")
            now = now.unionByName(before).agg(F.max("clock").alias("clock"))
        micros = now.select(F.unix_micros("clock")).first()[0]
        clock = F.timestamp_micros(F.lit(micros).cast("long"))
        late = F.coalesce(F.col(time_col) < clock, F.lit(False))
        seen = Observation("gate")
        split = batch.withColumn("late", late).observe(
            seen, F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("late"), 1)).alias("n_late"),
            F.count(F.when(F.col(time_col).isNull(), 1)).alias("n_untimed"))
        split.write.mode("overwrite").partitionBy("late").parquet(f"{path}/{changelog.BATCH}={batch_id}")
        counted = spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id"),
                                        *(F.lit(seen.get[c]).cast("long").alias(c) for c in ("n_rows", "n_late", "n_untimed")),
                                        clock.alias("clock"))
        counted.write.mode("overwrite").json(f"{path}-clock/{changelog.BATCH}={batch_id}")
    return write


def counters(spark: SparkSession, path: str) -> DataFrame:
    """One row a batch: rows, late rows, rows without a time, clock."""
    return (spark.read.schema(COUNTERS).option("timestampFormat", changelog.TIMESTAMPS)
            .json(f"{path}-clock").select(*(c.split()[0] for c in COUNTERS.split(", "))))


def _sides(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(changelog.BATCH, T.LongType()), T.StructField("late", T.BooleanType())])


def on_time(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """The main side as a stream, for an aggregate with the gate's lateness."""
    r = spark.readStream.schema(_sides(schema))
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path).where(~F.col("late")).select(*schema.names)


def late_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The late side so far, as a table."""
    return spark.read.schema(_sides(schema)).parquet(path).where("late").select(*schema.names)
