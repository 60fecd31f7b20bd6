"""Raw text-line sources (files of trip or fare lines)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.operators.parse import gate_lines


def read_lines(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Batch read of text files as ``seq, ts, value, place``.

    ``seq`` numbers the lines and is unique, but Spark packs large files
    first, so its order is not that of the files.  ``place`` (file name, start
    of the split, ``seq``) orders lines by file name and position in it; pass
    it as the ``order`` of :func:`hackney.operators.merge.latest_by_key` where
    the last file's record is the latest.  With ``kind`` (``"trip"``/``"fare"``) the replay gate is
    applied and ``ts`` is the pickup time; without it ``ts`` is NULL and
    every line is kept.
    """
    raw = (spark.read.text(path)
           .select(F.monotonically_increasing_id().alias("seq"), "value",
                   F.col("_metadata.file_name").alias("_file"),
                   F.col("_metadata.file_block_start").alias("_block")))
    place = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), "seq").alias("place")
    if kind is None:
        return raw.select("seq", F.lit(None).cast("timestamp").alias("ts"), "value", place)
    return gate_lines(raw, kind).select("seq", F.col("event_ts").alias("ts"), "value", place)
