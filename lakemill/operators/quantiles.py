"""Exact medians of many groups at once, by refining a histogram of integer codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns))


def lower_medians(counts: DataFrame, keys: list[str], code: str, n: str, out: str) -> DataFrame:
    """Per ``keys`` the value of ``code`` at place ceil(N / 2) of the group's N rows in order.

    ``counts`` holds how many rows (``n``) of a group have a code; a code may stand in several of its rows. Codes are read in
    two halves of their bits, as many as the greatest code has: the first half finds the bucket that holds the
    median, the second the place in it. So no window sees more than 2^18 rows of a group while codes have 36 bits
    (amounts up to 687 million in cents), whatever the number of rows, and no value is approximated.
    """
    span = counts.agg(F.max(F.abs(F.col(code))).alias("m")).scalar()
    # Half of the greatest code's bits, rounded up; at least one.
    shift = F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(span, F.lit(1)) + 1) / 2)).cast("int")
    rows = counts.withColumn("_bucket", F.call_function("shiftright", F.col(code), shift))
    buckets = rows.groupBy(*keys, "_bucket").agg(F.sum(n).alias("_n"))
    order = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = buckets.withColumns({
        "_upto": F.sum("_n").over(order),
        "_place": F.floor((F.sum("_n").over(Window.partitionBy(*keys)) + 1) / 2),
    })
    chosen = placed.filter((F.col("_upto") >= F.col("_place")) & (F.col("_upto") - F.col("_n") < F.col("_place"))).select(
        *keys, "_bucket", (F.col("_place") - F.col("_upto") + F.col("_n")).alias("_within"))
    inside = rows.alias("r").join(chosen.alias("c"), _same("r", "c", [*keys, "_bucket"])).select(
        *[F.col(f"r.{k}").alias(k) for k in keys], F.col(f"r.{code}").alias(code), F.col(f"r.{n}").alias(n), "c._within")
    codes = inside.groupBy(*keys, code, "_within").agg(F.sum(n).alias("_n"))
    within = Window.partitionBy(*keys).orderBy(code).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = codes.withColumn("_upto", F.sum("_n").over(within)).filter(F.col("_upto") >= F.col("_within"))
    return reached.groupBy(*keys).agg(F.min(code).alias(out))
