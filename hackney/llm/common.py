"""Helpers the training-data operators share.

Text goes to Python as Arrow batches (never pandas, so a null id stays a null
and a 64-bit id keeps its bits).  Tables that are read twice are written once
to the shared checkpoint folder and read back, so a lost executor costs a
re-read, not a recomputation.
"""

from __future__ import annotations

import os
import posixpath
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.session import checkpoint_dir

# Rows per Arrow batch: with a few KB a document this is some MB; one batch
# holds at most this many documents however long they are.
BATCH_ROWS = 1024
_STORED: list[str] = []       # paths of this session's stored tables


def ship_package(spark: SparkSession) -> None:
    """Give the package to Python workers that would not find it by themselves
    (what ``spark-submit --py-files`` does), once a session."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    key = "hackney.llm.shipped"
    if spark.conf.get(key, "") != spark.sparkContext.applicationId:
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="hackney-code-"), "hackney"), "zip",
                                   root, "hackney")
        spark.sparkContext.addPyFile(made)
        spark.conf.set(key, spark.sparkContext.applicationId)


def prepare(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    checkpoint_dir(spark)


@contextmanager
def batch_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Arrow batches of ``n`` rows for the jobs run inside: for tables whose
    rows are blocks of some MB."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/hackney-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, kept
    when executors are lost, and no lineage behind it."""
    path = shared_path(df.sparkSession, name)
    _STORED.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_so_far() -> int:
    """A mark for `release`: how many tables this process has stored."""
    return len(_STORED)


def release(spark: SparkSession, since: int, until: int) -> None:
    """Delete the tables stored between two marks.  For callers that know that
    nothing is still to be read from them."""
    for path in filter(None, _STORED[since:until]):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _STORED[since:until] = [""] * (until - since)


def apart(df: DataFrame) -> DataFrame:
    """``df`` with its columns named ``col_0``, ``col_1``, ... by position, so
    that no column of it clashes with one an operator adds."""
    return df.toDF(*(f"col_{k}" for k in range(len(df.columns))))


def named_apart(df: DataFrame, column: str) -> str:
    """The name of ``df``'s ``column`` in `apart`."""
    return f"col_{df.columns.index(column)}"


def together(plain: DataFrame, df: DataFrame) -> DataFrame:
    """The columns of `apart(df)` in ``plain`` under their own names again."""
    return plain.select(*(f"col_{k}" for k in range(len(df.columns)))).toDF(*df.columns)


# A set of keys up to this size is broadcast; a larger one is joined by shuffle.
BROADCAST_KEYS = 1_000_000


def drop_keys(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` is not in the one-column table ``keys``; that
    table is stored and counted, and broadcast only if it is small."""
    keys = stored(keys.toDF("__key"), "keys")
    if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return rows.join(keys, key == F.col("__key"), "left_anti")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(id_col: str, mod: int):
    """crc32 of the id's decimal text, mod ``mod``; a null id gives 0 (held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod, F.lit(0))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """``fn`` on each Arrow batch of ``df``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None:
                yield out
    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def open_out(uri: str):
    """An output stream in the file system of ``uri`` (file, hdfs, s3, ...)."""
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    return fs.open_output_stream(path, compression=None)


def open_in(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(path)
