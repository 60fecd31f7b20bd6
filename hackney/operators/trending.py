"""Pickups per grid cell in hopping windows.

Plan shape (batch and streaming alike): narrow projection to ``(time,
grid_id)`` -> filter out-of-area -> ``Expand`` into the overlapping windows
-> partial hash aggregate -> one shuffle on ``(window, grid_id)`` -> final
aggregate.  The partial aggregate collapses a hot cell to one row per task
before the shuffle, so a cell holding a third of all pickups costs no more
shuffle than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.functions.geo import NOT_IN_AREA, area_cell

# The trending window and its hop.
WINDOW = "5 minutes"
SLIDE = "1 minute"


def pickup_cells(trips: DataFrame, keep: tuple[str, ...] = ("key",)) -> DataFrame:
    """``keep`` columns plus ``grid_id`` of the pickup, in-area trips only.

    Coordinates are gridded as FLOAT; DOUBLE input (e.g. read back from
    JSON) is narrowed first, so both give the same cell."""
    lon = F.get(F.col("pickup_location"), 0).cast("float")
    lat = F.get(F.col("pickup_location"), 1).cast("float")
    return (trips.select(*keep, area_cell(lon, lat).alias("grid_id"))
                 .where(F.col("grid_id") > F.lit(NOT_IN_AREA)))


def trending(trips: DataFrame, time_col: str = "ts", window: str = WINDOW,
             slide: str = SLIDE, watermark: str | None = None) -> DataFrame:
    """Pickup count per ``(window, grid_id)``.

    ``time_col`` is the time base: a Kafka record timestamp for live data,
    the pickup time for backfills.  ``watermark`` bounds streaming state
    (rows later than it are dropped); ignored for batch input.
    """
    cells = pickup_cells(trips, keep=(time_col,))
    if watermark and trips.isStreaming:
        cells = cells.withWatermark(time_col, watermark)
    w = F.window(F.col(time_col), window, slide)
    return (cells.groupBy(w.alias("window"), "grid_id")
                 .agg(F.count(F.lit(1)).alias("pickups"))
                 .select(F.col("window.start").alias("window_start"),
                         F.col("window.end").alias("window_end"),
                         "grid_id", "pickups"))


def as_key_value(counts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop the window bounds: ``key`` = cell, ``value`` = count (INT).
    ``keep`` names columns that go along (a changelog's windows)."""
    return counts.select(F.col("grid_id").alias("key"),
                         F.col("pickups").cast("int").alias("value"), *keep)
