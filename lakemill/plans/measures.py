"""Every metric over the cleaned tables of the retail feeds, by the name of its result table.

A measure takes the session, the cleaned layer's database and its own parameters, and returns the
result unevaluated (``provinceordercount`` and ``itemoverlap`` excepted, see their operators).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.functions.money import money
from lakemill.operators.sequences import best_average_run, id_bounds
from lakemill.plans import behaviour, compare, consumption, series, toplists
from lakemill.plans.jobs import LOAD_DAY, kept_table
from lakemill.plans.feeds import RETAIL_A as RETAIL_A_FEED, RETAIL_B as RETAIL_B_FEED, TableSpec
from lakemill.sources.tables import read_cols

# Parameters the metrics are asked for by default.
CITY_YEAR, MEDIAN_YEAR, RUN_DISTANCE, OVERLAP_USER = 2022, 2020, 20, 9253
MOST_PROVINCES = 1000
HOURS_FROM, HOURS_TO = "2022-04-26 00:00:00", "2022-04-26 09:59:59"
LABEL_FROM, LABEL_TO = "2022-04-26 04", "2022-04-26 09"

Measure = Callable[..., DataFrame]


def current_facts(spark: SparkSession, dwd: str, feed: tuple[TableSpec, ...], target: str) -> DataFrame:
    """The last version of each fact: increments deliver a changed order again, and it must count once.

    The versions are kept when a load is cleaned (:func:`lakemill.plans.jobs.clean`), so nothing is compared here and filters go down to
    the scan. Rows without a key all stay; the fact's own scan looks for these by the key columns' null counts.
    """
    spec = next(s for s in feed if s.target == target)
    keyless = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in spec.keys))
    kept = spark.table(kept_table(dwd, spec, "last"))
    return kept.unionByName(spark.table(f"{dwd}.{target}").filter(keyless).drop(LOAD_DAY))


def valid_facts(spark: SparkSession, dwd: str, feed: tuple[TableSpec, ...], target: str) -> DataFrame:
    """The last valid version of each order, kept like :func:`current_facts`."""
    return spark.table(kept_table(dwd, next(s for s in feed if s.target == target), "valid"))


def of_days(facts: DataFrame, first: str, last: str, partition: str = "etl_date") -> DataFrame:
    """Only the partitions of the event days from ``first`` to ``last``, as ``yyyyMMdd``."""
    return facts.filter(F.col(partition).between(first, last))


# --- second retail feed ------------------------------------------------------------------------


def _valid(spark: SparkSession, dwd: str, *columns: str) -> DataFrame:
    """A refunded version is no valid order and does not hide an earlier one: the valid ones are kept on their own."""
    return valid_facts(spark, dwd, RETAIL_B_FEED, "fact_order_master").select(*columns)


def _places(spark: SparkSession, dwd: str, *more: str) -> DataFrame:
    return _valid(spark, dwd, "order_money", "create_time", "city", "province", *more)


def _day(label: str, back: int = 0) -> str:
    """The day of a time as partition value, some hours earlier."""
    at = dt.datetime.strptime(label[:13], "%Y-%m-%d %H") - dt.timedelta(hours=back)
    return at.strftime("%Y%m%d")


def user_day(spark, dwd):
    customers = read_cols(spark, f"{dwd}.dim_customer_inf", ["customer_id", "customer_name"])
    return consumption.user_day_consumption(_valid(spark, dwd, "customer_id", "order_money", "create_time"), customers)


def city_month(spark, dwd):
    return consumption.city_month_consumption(_places(spark, dwd))


def city_average(spark, dwd):
    return compare.avg_vs_parent(_places(spark, dwd))


def city_median(spark, dwd):
    return compare.median_vs_parent(_places(spark, dwd))


def city_top(spark, dwd, year: int = CITY_YEAR):
    return toplists.top_cities(of_days(_places(spark, dwd, "etl_date"), f"{year:04}0101", f"{year:04}1231"), year)


def product_top(spark, dwd):
    columns = ["product_id", "product_name", "product_cnt", "product_price"]
    return toplists.top_products(current_facts(spark, dwd, RETAIL_B_FEED, "fact_order_detail").select(*columns))


def repurchase(spark, dwd):
    return behaviour.repurchase_rate(_valid(spark, dwd, "customer_id", "create_time"))


def province_counts(spark, dwd, most: int = MOST_PROVINCES):
    """One column per province. More than ``most`` of them are an error: a table has no room for any number of columns."""
    orders = _valid(spark, dwd, "province")
    provinces = [r[0] for r in series.counts_by_value(orders, "province").select("province").limit(most + 1).collect()]
    if len(provinces) > most:
        raise ValueError(f"more than {most} provinces; series.counts_by_value gives a row each")
    return series.pivot_counts(orders, provinces, "province")


def hours_running(spark, dwd, start: str = HOURS_FROM, end: str = HOURS_TO):
    orders = of_days(_valid(spark, dwd, "order_money", "create_time", "etl_date"), _day(start), _day(end))
    return series.running_total(orders, start, end)


def hours_sliding(spark, dwd, first: str = LABEL_FROM, last: str = LABEL_TO, hours: int = 5):
    orders = of_days(_valid(spark, dwd, "order_money", "create_time", "etl_date"), _day(first, hours), _day(last))
    return series.sliding_window(orders, first, last, hours)


def overlap(spark, dwd, target: int = OVERLAP_USER, exclude_self: bool = True):
    return behaviour.item_overlap(
        current_facts(spark, dwd, RETAIL_B_FEED, "fact_order_master"),
        current_facts(spark, dwd, RETAIL_B_FEED, "fact_order_detail"),
        spark.table(f"{dwd}.dim_customer_inf"), spark.table(f"{dwd}.dim_product_info"), target, exclude_self)


RETAIL_B: dict[str, Measure] = {
    "user_consumption_day_aggr": user_day,
    "city_consumption_day_aggr": city_month,
    "cityavgcmpprovince": city_average,
    "citymidcmpprovince": city_median,
    "regiontopthree": city_top,
    "topten": product_top,
    "userrepurchasedrate": repurchase,
    "provinceordercount": province_counts,
    "accumulateconsumption": hours_running,
    "slidewindowconsumption": hours_sliding,
    "itemoverlap": overlap,
}


# --- first retail feed -------------------------------------------------------------------------


def _provinces(spark: SparkSession, dwd: str) -> DataFrame:
    """Ids differ in type between the feed's tables and are aligned here."""
    return spark.table(f"{dwd}.dim_province").select(
        F.col("id").cast("int").alias("province_id"), F.col("name").alias("province_name"),
        F.col("region_id").try_cast("int").alias("region_id"))


def _regions(spark: SparkSession, dwd: str) -> DataFrame:
    return spark.table(f"{dwd}.dim_region").select(F.col("id").try_cast("int").alias("region_id"), "region_name")


def _orders(spark: SparkSession, dwd: str, *columns: str) -> DataFrame:
    return current_facts(spark, dwd, RETAIL_A_FEED, "fact_order_info").select(*columns)


def _placed(spark: SparkSession, dwd: str, year: int | None = None) -> DataFrame:
    orders = _orders(spark, dwd, "final_total_amount", "create_time", "province_id", "etl_date")
    if year is not None:
        orders = of_days(orders, f"{year:04}0101", f"{year:04}1231")
    return orders.drop("etl_date").join(_provinces(spark, dwd), "province_id", "left").join(_regions(spark, dwd), "region_id", "left")


def _users(spark: SparkSession, dwd: str) -> DataFrame:
    return spark.table(f"{dwd}.dim_user_info").select(F.col("id").alias("user_id"), F.col("name").alias("user_name"))


def _skus(spark: SparkSession, dwd: str) -> DataFrame:
    """``sku_num`` is a number held as text."""
    return current_facts(spark, dwd, RETAIL_A_FEED, "fact_order_detail").select(
        "order_id", F.col("sku_id").alias("product_id"), F.col("sku_name").alias("product_name"),
        F.col("sku_num").try_cast("bigint").alias("product_cnt"), money(F.col("order_price")).alias("product_price"))


def province_month(spark, dwd):
    orders = _orders(spark, dwd, "final_total_amount", "create_time", "province_id")
    return consumption.region_rollup(orders, _provinces(spark, dwd), _regions(spark, dwd))


def province_month_keyed(spark, dwd):
    return consumption.keyed_rollup(province_month(spark, dwd))


def user_day_keyed(spark, dwd):
    orders = _orders(spark, dwd, "user_id", "final_total_amount", "create_time")
    return consumption.user_day_consumption(orders, _users(spark, dwd), "user_id", "user_name", "final_total_amount")


def sku_top(spark, dwd):
    return toplists.top_products(_skus(spark, dwd))


def province_median(spark, dwd, year: int = MEDIAN_YEAR):
    return compare.nation_median(_placed(spark, dwd, year), year)


def province_average(spark, dwd):
    return compare.province_avg_vs_all(_placed(spark, dwd))


def province_average_region(spark, dwd):
    return compare.province_avg_vs_region(_placed(spark, dwd))


def province_top(spark, dwd, year: int = MEDIAN_YEAR):
    return toplists.top_provinces(_placed(spark, dwd, year), year)


def user_days_running(spark, dwd):
    orders = _orders(spark, dwd, "user_id", "final_total_amount", "create_time")
    return behaviour.consecutive_day_users(orders, _users(spark, dwd))


def repurchase_number(spark, dwd):
    return behaviour.repurchase_ratio(_orders(spark, dwd, "user_id", "create_time"), "user_id")


def amount_difference(spark, dwd):
    orders = _orders(spark, dwd, F.col("id").alias("order_id"), "final_total_amount")
    lines = _skus(spark, dwd).withColumn("line_amount", F.col("product_cnt") * F.col("product_price"))
    return behaviour.order_amount_diff(orders, lines)


def best_run(spark, dwd, min_distance: int = RUN_DISTANCE):
    orders = _orders(spark, dwd, "id", "final_total_amount")
    return best_average_run(orders, "id", "final_total_amount", min_distance, bounds=id_bounds(orders, "id"), every_length=True)


RETAIL_A: dict[str, Measure] = {
    "province_consumption_day_aggr": province_month,
    "province_consumption_day_aggr_keyed": province_month_keyed,
    "user_consumption_day_aggr": user_day_keyed,
    "topten": sku_top,
    "nationmedian": province_median,
    "provinceavgcmp": province_average,
    "provinceavgcmpregion": province_average_region,
    "regiontopthree": province_top,
    "usercontinueorder": user_days_running,
    "userrepurchasedrate": repurchase_number,
    "order_final_money_amount_diff": amount_difference,
    "max_avg_order_price_seq": best_run,
}
