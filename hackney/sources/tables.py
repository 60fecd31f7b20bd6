"""Reading the given parquet tables; refined-record tables by pickup date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


PARTITION_COL = "pickup_date"


def write_refined(df: DataFrame, path: str, time_col: str = "pickup_ts",
                  mode: str = "append") -> None:
    """Store refined records as parquet partitioned by pickup date.

    Rows are range-partitioned by (date, time, row hash) before the write: each
    task holds a contiguous time slice, so it writes files for one or two
    dates, and a date, a time or the rows without one, holding a third of all
    rows, are cut into many slices instead of landing in one task.  Later reads with a time range prune whole
    dates.  Records without a pickup time go to the default partition.
    """
    out = df.withColumn(PARTITION_COL, F.to_date(F.col(time_col)))
    spread = F.xxhash64(*df.columns)
    (out.repartitionByRange(PARTITION_COL, time_col, spread)
        .write.mode(mode).partitionBy(PARTITION_COL).parquet(path))


def read_refined(spark: SparkSession, path: str, start: dt.date | None = None,
                 end: dt.date | None = None) -> DataFrame:
    """Read a refined table, keeping pickup dates in ``[start, end)``; the
    date predicate is a partition filter, so other dates are never listed
    or read."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col(PARTITION_COL) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(PARTITION_COL) < F.lit(end))
    return df


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = "key", order: str = "seq") -> None:
    """Store records as table ``name`` (files at ``path``), bucketed by ``key`` and
    sorted within buckets: the shuffle that every later latest-per-key or join on
    the key would pay is paid here once.  Tables that meet need the same number of
    buckets.  Each bucket is one task's file, so size ``buckets`` as one would
    shuffle partitions; a key with a very large share of the rows stays whole (use
    `hackney.operators.merge.interval_left_join` on unbucketed rows for that)."""
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
       .bucketBy(buckets, key).sortBy(key, order).saveAsTable(name))
