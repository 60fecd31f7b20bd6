"""Changelogs: folders of micro-batches that hold a table's changes.

A changelog is ``<path>/batch_id=<n>``, one folder a micro-batch, written with
overwrite: a batch replayed after a failure replaces its own rows.  The table
it describes is the last row of each key (`latest`); `read_log` gives the rows
to take it from, `compact` bounds the log.

Compaction writes the table so far to ``<path>-snapshot/upto=<n>`` and then
deletes the batches it covers.  Readers take the newest complete snapshot and
the batches after it, so an interrupted compaction changes nothing: a snapshot
without its success mark is not read, and batches it covers are skipped whether
they are still there or not.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"
TIMESTAMPS = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"


def with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*(f for f in schema.fields if f.name != BATCH), T.StructField(BATCH, T.LongType())])


def batch_writer(path: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends batch ``n``, or replaces it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/{BATCH}={batch_id}")
    return write


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the complete folders ``<path>/<name>=n``, ascending."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    found = [(re.fullmatch(rf"{name}=(\d+)", s.getPath().getName()), s.getPath()) for s in fs.listStatus(where)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(m[1]) for m, p in found if m and fs.exists(done(p, "_SUCCESS")))


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read_log(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """The rows of a changelog with their ``batch_id``: the newest snapshot and
    the batches after it."""
    schema = with_batch(schema)
    snapshots = numbered(spark, f"{path}-snapshot", "upto")
    upto = snapshots[-1] if snapshots else -1
    batches = [f"{path}/{BATCH}={n}" for n in numbered(spark, path, BATCH) if n > upto]
    out = spark.createDataFrame([], schema)
    if batches:
        log = spark.read.format(fmt).schema(schema).option("basePath", path)
        if fmt == "json":
            log = log.option("timestampFormat", TIMESTAMPS)
        out = log.load(batches)
    if snapshots:
        old = spark.read.schema(schema).parquet(f"{path}-snapshot/upto={upto}")
        out = old.unionByName(out) if batches else old
    return out


def stream_log(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
               files_per_trigger: int | None = None) -> DataFrame:
    """The same rows as a stream, from the first batch that is still there.  A
    replayed batch may come twice: take the last row of a key, or drop repeats."""
    r = spark.readStream.format(fmt).schema(with_batch(schema))
    if fmt == "json":
        r = r.option("timestampFormat", TIMESTAMPS)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(path)


def latest(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = (BATCH,)) -> DataFrame:
    """The table that ``changes`` describe: each key's row with the greatest
    ``order`` (columns compared one after another, nulls first).  A key is
    reduced within each task before the one shuffle.  Of rows with equal order,
    repeats of one change, either is taken."""
    others = [c for c in changes.columns if c not in keys]
    return (changes.groupBy(*keys)
                   .agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
                   .select(*keys, *[F.col("_row")[c].alias(c) for c in others]))


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
            order: Sequence[str] = (BATCH,), fmt: str = "json") -> int | None:
    """Replace all complete batches by the table they describe; the number of
    the last one covered (None if there is nothing new).  Run it by the
    changelog's only writer, or while it is stopped; streams that still have to
    read old batches lose their single changes, never a key's last row."""
    batches, snapshots = numbered(spark, path, BATCH), numbered(spark, f"{path}-snapshot", "upto")
    upto = snapshots[-1] if snapshots else -1
    if batches and batches[-1] > upto:
        rows = latest(read_log(spark, path, schema, fmt), keys, order)
        rows.write.mode("overwrite").parquet(f"{path}-snapshot/upto={batches[-1]}")
        new = batches[-1]
    else:
        new = None
    last = upto if new is None else new
    for n in batches:
        if n <= last:
            _delete(spark, f"{path}/{BATCH}={n}")
    for n in snapshots:
        if n < last:
            _delete(spark, f"{path}-snapshot/upto={n}")
    return new


class KeyedTable:
    """A table of documents by id on a shared folder, written by micro-batches.

    ``upsert`` is idempotent: a batch written again, or a document delivered
    again in another batch, leaves one row for each id."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                 order: Sequence[str] = (BATCH,), fmt: str = "parquet"):
        self.spark, self.path, self.schema, self.fmt = spark, path, schema, fmt
        self.keys, self.order = list(keys), list(order)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        inside = [c for c in self.order if c != BATCH]
        rows = latest(batch, self.keys, inside) if inside else batch.dropDuplicates(self.keys)
        batch_writer(self.path, self.fmt)(rows, batch_id)

    def read(self) -> DataFrame:
        """The table; ``batch_id`` is the micro-batch a row last came in."""
        return latest(read_log(self.spark, self.path, self.schema, self.fmt), self.keys, self.order)

    def compact(self) -> int | None:
        return compact(self.spark, self.path, self.schema, self.keys, self.order, self.fmt)
