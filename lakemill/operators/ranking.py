"""Ranking over a whole result without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType, FractionalType, IntegralType

from lakemill.operators.radix import decimal_code, double_code, totals_before


def order_code(df: DataFrame, column: str) -> Column:
    """A number column as a 64-bit integer of the same order."""
    kind = df.schema[column].dataType
    if isinstance(kind, IntegralType):
        return F.col(column).cast("bigint")
    if isinstance(kind, DecimalType):
        return decimal_code(F.col(column), kind.scale)
    if isinstance(kind, FractionalType):
        return double_code(F.col(column).cast("double"))
    raise TypeError(f"{column} is no number but {kind.simpleString()}")


def global_rank(df: DataFrame, column: str, out: str = "sequence") -> DataFrame:
    """``rank()`` by ``column`` descending over all rows, NULLs last, spread over many tasks.

    Rows are counted per distinct value; how many are greater comes from a tree over the values' integer codes, where no
    task orders more than 2^18 of them, however close they are. Decimals are compared exactly. A value
    shared by many rows is counted before the exchange.
    """
    coded = df.withColumn("_code", order_code(df, column))
    counts = coded.filter("_code is not null").groupBy("_code").agg(F.count("*").alias("_n"))
    ahead = totals_before(counts, "_code", "_n", "_ahead", descending=True)
    known = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    ranked = coded.join(ahead, "_code", "left")
    return ranked.withColumn(out, (F.coalesce("_ahead", known) + 1).cast("bigint")).drop("_code", "_ahead")


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of an order; planned as a per-task top-k, not a full sort."""
    return df.orderBy(*order).limit(k)


def top_ranked(df: DataFrame, group: list[str], order: str, k: int, out: str = "rank") -> DataFrame:
    """Rows of rank 1..k per group by ``order`` descending; ties share a rank and all stay."""
    window = Window.partitionBy(*group).orderBy(F.col(order).desc())
    return df.withColumn(out, F.rank().over(window)).filter(F.col(out) <= k)
