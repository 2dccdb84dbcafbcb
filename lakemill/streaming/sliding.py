"""Sliding-window consumption over a stream of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemill.functions.money import as_double
from lakemill.functions.times import HOUR_PATTERN


def sliding_stream(
    orders: DataFrame, delay: str = "1 hour", hours: int = 5, amount: str = "order_money", time: str = "create_time"
) -> DataFrame:
    """Sum and count over ``hours`` hours, every hour; a window is final once the watermark passes its end.

    State holds one row per open window, whatever the order volume.
    """
    timed = orders.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", delay)
    windows = timed.groupBy(F.window("_at", f"{hours} hours", "1 hour").alias("_window")).agg(
        F.sum(amount).alias("_sum"), F.count("*").alias("_n")
    )
    return windows.select(
        F.date_format("_window.end", HOUR_PATTERN).alias("consumptiontime"),
        as_double(F.col("_sum")).alias("consumptionsum"),
        F.col("_n").cast("double").alias("consumptioncount"),
    )
