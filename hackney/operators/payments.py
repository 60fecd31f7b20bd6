"""Driver payment statements and windowed payment summaries.

Statement: eligible fares -> ``payable = tip + 0.9 * fare`` per fare row
(narrow).  Summary: sum of total and payable per ``(window, hack_license)``;
partial aggregation before the single shuffle on the grouping key, so a
driver with a third of all fares still ships one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The payment rule.
EXCLUDED_PAYMENT_TYPES = ("CAS",)   # compared case-blind
DRIVER_SHARE_OF_FARE = 0.9
SUMMARY_WINDOW = "2 minutes"
TIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def eligible(fares: DataFrame, excluded: Iterable[str] = EXCLUDED_PAYMENT_TYPES) -> DataFrame:
    """Fares whose payment type is not in ``excluded`` (case-blind)."""
    codes = [c.upper() for c in excluded]
    return fares.where(~F.upper(F.col("payment_type")).isin(codes))


def statement(fares: DataFrame, keep: tuple[str, ...] = (),
              excluded: Iterable[str] = EXCLUDED_PAYMENT_TYPES) -> DataFrame:
    """One payment line per eligible fare, amounts as DOUBLE."""
    tip = F.coalesce(F.col("tip_amount").cast("double"), F.lit(0.0))
    fare = F.coalesce(F.col("fare_amount").cast("double"), F.lit(0.0))
    return eligible(fares, excluded).select(
        *keep,
        "hack_license",
        "pickup_datetime",
        F.coalesce(F.col("total_amount").cast("double"), F.lit(0.0)).alias("total_amount"),
        (tip + F.lit(DRIVER_SHARE_OF_FARE) * fare).alias("payable_amount"),
    )


def summary(statements: DataFrame, time_col: str = "ts", window: str = SUMMARY_WINDOW,
            slide: str | None = None, watermark: str | None = None,
            stamp: bool = True) -> DataFrame:
    """Total and payable sums per driver per window.

    ``stamp`` adds ``txn_date``, the wall-clock time of the computation as
    text (not deterministic; leave it out when comparing results).
    """
    df = statements
    if watermark and df.isStreaming:
        df = df.withWatermark(time_col, watermark)
    w = F.window(F.col(time_col), window, slide) if slide else F.window(F.col(time_col), window)
    out = (df.groupBy(w.alias("window"), "hack_license")
             .agg(F.sum("total_amount").alias("total_amount"),
                  F.sum("payable_amount").alias("payable_amount"))
             .select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"),
                     "hack_license", "total_amount", "payable_amount"))
    if stamp:
        out = out.withColumn("txn_date", F.date_format(F.current_timestamp(), TIME_TEXT_FORMAT))
    return out
