"""A level of a hierarchy against the level above it: averages and medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType

from lakemill.functions.money import as_double
from lakemill.functions.times import calendar, in_year
from lakemill.operators.quantiles import lower_medians
from lakemill.operators.radix import decimal_code

# Labels above / below / same.
ABOVE, BELOW, SAME = "高", "低", "相同"


def compare_label(value: Column, other: Column) -> Column:
    return F.when(value > other, ABOVE).when(value < other, BELOW).otherwise(SAME)


def _average(total: Column, count: Column) -> Column:
    return as_double(total) / count


def _period_rows(df: DataFrame, parent: list[str], period: list[str]) -> DataFrame:
    known = df.withColumns({p: c for p, c in zip(period, calendar(F.col("create_time"), *period))})
    for name in [*parent, *period]:
        known = known.filter(F.col(name).isNotNull())
    return known


def average_levels(
    df: DataFrame, child: list[str], parent: list[str], period: list[str], amount: str
) -> DataFrame:
    """Average per child and per parent in each period, as ``child_avg`` and ``parent_avg``.

    The parent is summed from the child totals over a window, so the facts are read and shuffled
    once; rows without a parent or a time have nothing to be compared with and drop out.
    """
    rows = _period_rows(df, parent, period)
    totals = rows.groupBy(*parent, *child, *period).agg(F.sum(amount).alias("_sum"), F.count("*").alias("_n"))
    over = Window.partitionBy(*parent, *period)
    return totals.withColumns({
        "child_avg": _average(F.col("_sum"), F.col("_n")),
        "parent_avg": _average(F.sum("_sum").over(over), F.sum("_n").over(over)),
    }).drop("_sum", "_n")


def median_levels(
    df: DataFrame, child: list[str], parent: list[str], period: list[str], amount: str
) -> DataFrame:
    """Median per child and per parent in each period, as ``child_mid`` and ``parent_mid``: the lower of the two middle ones.

    Orders shrink to counts per child and amount, the only pass over them. A parent's counts are those of its children, so
    both levels are found from these together, exactly. The parent median then reaches its children through a
    window over the groups instead of a join.
    """
    rows = _period_rows(df, parent, period).filter(F.col(amount).isNotNull())
    kind = rows.schema[amount].dataType
    scale = kind.scale if isinstance(kind, DecimalType) else 2
    upper, keys = [*parent, *period], [*parent, *child, *period]
    counts = rows.groupBy(*keys, decimal_code(F.col(amount), scale).alias("_code")).agg(F.count("*").alias("_rows"))
    levels = F.explode(F.array(
        F.struct(F.lit(0).alias("_level"), *[F.col(c) for c in child]),
        F.struct(F.lit(1).alias("_level"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in child]))).alias("_at")
    both = counts.select(*upper, levels, "_code", "_rows").select(*upper, "_at.*", "_code", "_rows")
    medians = lower_medians(both, [*upper, "_level", *child], "_code", "_rows", "_mid")
    value = (F.col("_mid").cast("decimal(20,0)") / F.lit(10**scale)).cast("double")
    above = F.max(F.when(F.col("_level") == 1, F.col("child_mid"))).over(Window.partitionBy(*upper))
    return medians.withColumn("child_mid", value).withColumn("parent_mid", above).filter("_level = 0").drop("_level", "_mid")


def avg_vs_parent(orders: DataFrame, amount: str = "order_money") -> DataFrame:
    """City average against province average, one row per city and month."""
    levels = average_levels(orders, ["city"], ["province"], ["year", "month"], amount)
    return levels.select(
        F.col("city").alias("cityname"), F.col("child_avg").alias("cityavgconsumption"),
        F.col("province").alias("provincename"), F.col("parent_avg").alias("provinceavgconsumption"),
        compare_label(F.col("child_avg"), F.col("parent_avg")).alias("comparison"),
    )


def median_vs_parent(orders: DataFrame, amount: str = "order_money") -> DataFrame:
    """City median against province median, one row per city and month."""
    levels = median_levels(orders, ["city"], ["province"], ["year", "month"], amount)
    return levels.select(
        F.col("city").alias("cityname"), F.col("child_mid").alias("citymidconsumption"),
        F.col("province").alias("provincename"), F.col("parent_mid").alias("provincemidconsumption"),
        compare_label(F.col("child_mid"), F.col("parent_mid")).alias("comparison"),
    )


def province_avg_vs_region(orders: DataFrame, amount: str = "final_total_amount") -> DataFrame:
    """Province average against region average, one row per province and month."""
    levels = average_levels(
        orders, ["province_id", "province_name"], ["region_id", "region_name"], ["year", "month"], amount
    )
    return levels.select(
        F.col("province_id").alias("provinceid"), F.col("province_name").alias("provincename"),
        F.col("child_avg").alias("provinceavgconsumption"),
        F.col("region_id").alias("regionid"), F.col("region_name").alias("regionname"),
        F.col("parent_avg").alias("regionavgconsumption"),
        compare_label(F.col("child_avg"), F.col("parent_avg")).alias("comparison"),
    )


def province_avg_vs_all(orders: DataFrame, amount: str = "final_total_amount") -> DataFrame:
    """Province average against the average of all provinces' orders in the same month.

    Meaning inferred from the declared result columns.
    """
    levels = average_levels(orders, ["province_id", "province_name"], [], ["year", "month"], amount)
    return levels.select(
        F.col("province_id").alias("provinceid"), F.col("province_name").alias("provincename"),
        F.col("child_avg").alias("provinceavgconsumption"),
        F.col("parent_avg").alias("allprovinceavgconsumption"),
        compare_label(F.col("child_avg"), F.col("parent_avg")).alias("comparison"),
    )


def nation_median(orders: DataFrame, year: int, amount: str = "final_total_amount") -> DataFrame:
    """Median order amount of each province beside that of its region, for one year."""
    wanted = orders.filter(in_year(orders, "create_time", year))
    levels = median_levels(
        wanted, ["province_id", "province_name"], ["region_id", "region_name"], ["year"], amount
    )
    return levels.select(
        F.col("province_id").alias("provinceid"), F.col("province_name").alias("provincename"),
        F.col("region_id").alias("regionid"), F.col("region_name").alias("regionname"),
        F.col("child_mid").alias("provincemedian"), F.col("parent_mid").alias("regionmedian"),
    )
