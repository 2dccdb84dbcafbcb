"""Amounts along the clock, and counts laid out as one wide row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemill.functions.money import as_double
from lakemill.functions.times import HOUR_PATTERN


def _hour(moment: Column) -> Column:
    return F.date_trunc("hour", moment).cast("timestamp_ntz").alias("_hour")


def _label_hour(label: str) -> dt.datetime:
    return dt.datetime.strptime(label[:13], "%Y-%m-%d %H")


def running_total(
    orders: DataFrame, start: str | None = None, end: str | None = None, amount: str = "order_money",
    time: str = "create_time",
) -> DataFrame:
    """New amount per hour and its running total, inside a closed time range if one is given.

    Orders are summed per hour first; the running window orders hours, whose number is bounded by
    the calendar.
    """
    moment = F.col(time)
    rows = orders
    if start is not None:
        rows = rows.filter(moment >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        rows = rows.filter(moment <= F.lit(end).cast("timestamp_ntz"))
    hours = rows.groupBy(_hour(moment)).agg(F.sum(amount).alias("_new"))
    so_far = Window.orderBy("_hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hours.select(
        F.date_format("_hour", HOUR_PATTERN).alias("consumptiontime"),
        as_double(F.col("_new")).alias("consumptionadd"),
        as_double(F.sum("_new").over(so_far)).alias("consumptionacc"),
    )


def sliding_window(
    orders: DataFrame, first: str | None = None, last: str | None = None, hours: int = 5,
    amount: str = "order_money", time: str = "create_time",
) -> DataFrame:
    """Sum, count and average over ``hours`` hours, every hour, labelled by the hour the window ends.

    Orders are summed per hour first and the hourly sums are spread over the windows they belong to;
    spreading the orders themselves would multiply the input by ``hours``. ``first`` and ``last``
    keep the labels between them, both included; only the hours of their windows are read.
    """
    kind = orders.schema[time].dataType
    if first is not None:
        orders = orders.filter(F.col(time) >= F.lit(str(_label_hour(first) - dt.timedelta(hours=hours))).cast(kind))
    if last is not None:
        orders = orders.filter(F.col(time) < F.lit(str(_label_hour(last))).cast(kind))
    panes = orders.groupBy(_hour(F.col(time))).agg(
        F.sum(amount).alias("_sum"), F.count("*").alias("_n")
    )
    spread = panes.groupBy(F.window("_hour", f"{hours} hours", "1 hour").alias("_window")).agg(
        F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n")
    )
    # Narrowed so that the quotient keeps 15 decimals and is rounded only once.
    average = F.col("_sum").cast("decimal(24,2)") / F.col("_n").cast("decimal(12,0)")
    labelled = spread.select(
        F.date_format("_window.end", HOUR_PATTERN).alias("consumptiontime"),
        as_double(F.col("_sum")).alias("consumptionsum"),
        F.col("_n").cast("double").alias("consumptioncount"),
        as_double(F.round(average, 2)).alias("consumptionavg"),
    )
    if first is not None:
        labelled = labelled.filter(F.col("consumptiontime") >= first)
    if last is not None:
        labelled = labelled.filter(F.col("consumptiontime") <= last)
    return labelled


def counts_by_value(orders: DataFrame, column: str = "province") -> DataFrame:
    """Orders per value, one row each, however many values there are; a NULL value has no row."""
    return orders.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def pivot_counts(orders: DataFrame, values: list[str], column: str = "province") -> DataFrame:
    """Orders per value as one wide row, columns by falling count, then by name.

    ``values`` names the columns, usually the place dimension; a value without orders counts 0 and values outside
    the list have no column. The order of columns depends on the data, so the one row of counts is looked at first.
    """
    held = F.col(column)
    wide = orders.agg(*[F.count_if(held == v).alias(f"c{i}") for i, v in enumerate(values)])
    counts = wide.first()
    order = sorted(range(len(values)), key=lambda i: (-counts[i], values[i]))
    return wide.select(*[F.col(f"c{i}").alias(values[i]) for i in order])
