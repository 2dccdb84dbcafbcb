"""The warehouse's logical tables over the parquet test tables.

``orders`` -> orders, ``lineitem`` -> order lines, ``customer`` -> customers, ``part`` -> products,
``nation`` -> cities or provinces, ``region`` -> provinces or regions. Order status ``P`` stands for
refunded. Each function selects columns only, so unused ones never leave the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.functions.money import money

REFUNDED = ("P",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order feed with an order number, as one of the two retail feeds names its columns."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_sn"), F.col("o_custkey").alias("customer_id"),
        money(F.col("o_totalprice")).alias("order_money"), F.col("o_orderdate").alias("create_time"),
        F.col("o_orderstatus").alias("order_status"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_nationkey").alias("nation_id"),
    )


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("province_id"), F.col("n_name").alias("province_name"),
        F.col("n_regionkey").alias("region_id"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_sn"), F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_no"), F.col("l_quantity").cast("bigint").alias("product_cnt"),
        money(F.col("l_extendedprice")).alias("product_price"), F.col("l_shipdate").alias("modified_time"),
    )


def city_orders(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Orders with city (nation) and province (region) names, which the feeds carry on every order."""
    base = orders(spark, sf_dir) if base is None else base
    place = nations(spark, sf_dir).join(regions(spark, sf_dir), "region_id").select(
        F.col("province_id").alias("nation_id"), F.col("province_name").alias("city"),
        F.col("region_name").alias("province"),
    )
    homes = customers(spark, sf_dir).select("customer_id", "nation_id")
    return base.join(homes, "customer_id").join(place, "nation_id").drop("nation_id")


def province_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other retail feed's orders: ``final_total_amount`` and the province (nation) id."""
    homes = customers(spark, sf_dir).select("customer_id", F.col("nation_id").alias("province_id"))
    feed = orders(spark, sf_dir).select(
        F.col("order_sn").alias("order_id"), "customer_id", F.col("order_money").alias("final_total_amount"),
        "create_time",
    )
    return feed.join(homes, "customer_id").withColumnRenamed("customer_id", "user_id")


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Province orders with province and region attributes."""
    return (
        province_orders(spark, sf_dir)
        .join(nations(spark, sf_dir), "province_id", "left")
        .join(regions(spark, sf_dir), "region_id", "left")
    )


def event_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as money: the table with times of day."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").alias("create_time"),
        money(F.col("value")).alias("order_money"),
    )
