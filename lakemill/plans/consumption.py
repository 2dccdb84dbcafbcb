"""Valid orders and consumption by user, city and province."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemill.functions.keys import record_key
from lakemill.functions.money import as_double
from lakemill.functions.times import calendar
from lakemill.operators.dedupe import dedupe_latest
from lakemill.operators.ranking import global_rank

# Fixed value: status text of a refunded order in the source feed.
REFUNDED = ("已退款",)
VERSION_ORDER = ("modified_time", "order_id")


def valid_orders(
    orders: DataFrame, *columns: str, key: str = "order_sn", excluded: tuple[str, ...] = REFUNDED
) -> DataFrame:
    """Orders not refunded, one row per order number, the latest by ``create_time``.

    The status filter comes first: a refunded row never shadows a kept one, and a NULL status drops
    out. Of several rows with the latest time the last modified stays, then the greatest row id; which one does
    not depend on ``columns``, so all metrics of a night see the same version. Frames without either
    column decide by all their columns.
    """
    kept = orders.filter(~F.col("order_status").isin(*excluded))
    ties = [c for c in VERSION_ORDER if c in orders.columns] or None
    latest = dedupe_latest(kept, [key], ["create_time"], ties)
    return latest.select(*columns) if columns else latest


def _totals(amount: str) -> list:
    return [F.sum(amount).alias("_amount"), F.count("*").alias("total_count")]


def user_day_consumption(
    orders: DataFrame,
    customers: DataFrame,
    user: str = "customer_id",
    name: str = "customer_name",
    amount: str = "order_money",
) -> DataFrame:
    """Amount and order count per known user and day.

    Orders shrink to user-days before they meet the customers, so a user with very many orders
    reaches the join as at most one row per day.
    """
    days = orders.groupBy(user, F.to_date("create_time").alias("_day")).agg(*_totals(amount))
    named = days.join(customers.select(user, name), user)
    return named.select(
        user, name, as_double(F.col("_amount")).alias("total_amount"), "total_count",
        *calendar(F.col("_day"), "year", "month", "day"),
    )


def city_month_consumption(orders: DataFrame, amount: str = "order_money") -> DataFrame:
    """Amount and order count per city and month, ranked over everything by the exact amount."""
    months = (
        orders.groupBy("city", "province", *calendar(F.col("create_time"), "year", "month"))
        .agg(*_totals(amount))
        .select(
            F.col("city").alias("city_name"), F.col("province").alias("province_name"),
            as_double(F.col("_amount")).alias("total_amount"), "total_count", "year", "month", "_amount",
        )
    )
    return global_rank(months, "_amount").drop("_amount")


def region_rollup(
    orders: DataFrame, provinces: DataFrame, regions: DataFrame, amount: str = "final_total_amount"
) -> DataFrame:
    """Amount and order count per province and month with region attributes, ranked by amount.

    ``provinces(province_id, province_name, region_id)`` and ``regions(region_id, region_name)`` are
    joined to the monthly totals, not to the orders; unknown provinces stay with NULL attributes.
    """
    months = orders.groupBy("province_id", *calendar(F.col("create_time"), "year", "month")).agg(*_totals(amount))
    placed = months.join(provinces, "province_id", "left").join(regions, "region_id", "left")
    totals = placed.select(
        "province_id", "province_name", "region_id", "region_name",
        as_double(F.col("_amount")).alias("total_amount"), "total_count", "year", "month", "_amount",
    )
    return global_rank(totals, "_amount").drop("_amount")


def keyed_rollup(rollup: DataFrame) -> DataFrame:
    """The roll-up with a record key made from its grouping columns."""
    key = record_key(*[F.col(c) for c in ("province_id", "region_id", "year", "month")])
    return rollup.withColumn("uuid", key)
