"""What users do over time and in common."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lakemill.functions.money import as_double, percent_text
from lakemill.functions.times import DAY_PATTERN
from lakemill.operators.ranking import top_k


def _repurchase_counts(orders: DataFrame, user: str) -> DataFrame:
    """One row: users, and users with orders on two days running.

    Orders shrink to distinct user-days before the window, so a user's partition is bounded by the
    calendar.
    """
    days = orders.select(user, F.to_date("create_time").alias("_day")).distinct()
    previous = F.lag("_day").over(Window.partitionBy(user).orderBy("_day"))
    again = (F.datediff("_day", previous) == 1).cast("int")
    users = days.withColumn("_again", again).groupBy(user).agg(F.coalesce(F.max("_again"), F.lit(0)).alias("_again"))
    return users.agg(
        F.count("*").alias("purchaseduser"),
        F.coalesce(F.sum("_again"), F.lit(0)).alias("repurchaseduser"),
    )


def repurchase_rate(orders: DataFrame, user: str = "customer_id") -> DataFrame:
    """Share of users who ordered on two days running, as text like ``21.1%``."""
    counts = _repurchase_counts(orders, user)
    return counts.withColumn("repurchaserate", percent_text(F.col("repurchaseduser"), F.col("purchaseduser")))


def repurchase_ratio(orders: DataFrame, user: str = "customer_id") -> DataFrame:
    """The same share as a number with four decimals."""
    counts = _repurchase_counts(orders, user)
    ratio = F.try_divide(F.col("repurchaseduser").cast("double"), F.col("purchaseduser").cast("double"))
    return counts.withColumn("repurchaserate", F.coalesce(ratio, F.lit(0.0)).cast("decimal(10,4)"))


def consecutive_day_users(
    orders: DataFrame,
    customers: DataFrame,
    user: str = "user_id",
    name: str = "user_name",
    amount: str = "final_total_amount",
) -> DataFrame:
    """Users ordering on two days running: the pair of days, its amount and its number of orders.

    Meaning inferred from the declared result columns.
    """
    days = orders.groupBy(user, F.to_date("create_time").alias("_day")).agg(
        F.sum(amount).alias("_amount"), F.count("*").alias("_n")
    )
    order = Window.partitionBy(user).orderBy("_day")
    pairs = days.withColumns({
        "_before": F.lag("_day").over(order),
        "_pair_amount": F.col("_amount") + F.lag("_amount").over(order),
        "_pair_n": F.col("_n") + F.lag("_n").over(order),
    }).filter(F.datediff("_day", "_before") == 1)
    text = F.concat_ws("_", F.date_format("_before", DAY_PATTERN), F.date_format("_day", DAY_PATTERN))
    return pairs.join(customers.select(user, name), user).select(
        F.col(user).alias("userid"), F.col(name).alias("username"), text.alias("day"),
        as_double(F.col("_pair_amount")).alias("totalconsumption"), F.col("_pair_n").alias("totalorder"),
    )


def item_overlap(
    orders: DataFrame,
    lines: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    target: int,
    exclude_self: bool = True,
    n: int = 10,
    user: str = "customer_id",
    order: str = "order_sn",
    product: str = "product_id",
) -> DataFrame:
    """Known users who bought most of the known products the target user bought; ties go by id.

    The target's orders, then the target's products, are found first so that the lines are reduced
    before they meet the orders; how both sets travel is left to Spark's size check at run time. A target who is no
    known customer has no orders. Other users are checked against the customers after counting, when they are one row each.
    """
    customer = customers.select(user)
    own_orders = orders.filter(F.col(user) == target).join(customer.filter(F.col(user) == target), user, "left_semi").select(order)
    catalogue = products.select(product)
    wanted = (
        lines.join(own_orders, order, "left_semi").select(product).distinct()
        .join(catalogue, product, "left_semi")
    )
    bought = (
        lines.select(order, product).join(wanted, product, "left_semi")
        .join(orders.select(order, user), order)
        .select(user, product).distinct()
    )
    if exclude_self:
        bought = bought.filter(F.col(user) != target)
    counts = bought.groupBy(user).agg(F.count("*").alias("num_products"))
    known = counts.join(customer, user, "left_semi")
    return top_k(known, [F.col("num_products").desc(), F.col(user).asc()], n)


def known_only(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Facts whose key occurs in a dimension."""
    return facts.join(dimension.select(key), key, "left_semi")


def order_amount_diff(
    orders: DataFrame, lines: DataFrame, order: str = "order_id", total: str = "final_total_amount",
    line_total: str = "line_amount",
) -> DataFrame:
    """Order total minus the sum of its lines; an order without lines differs by its whole total.

    Meaning inferred from the declared result columns.
    """
    sums = lines.groupBy(order).agg(F.sum(line_total).alias("_lines"))
    zero = F.lit(0).cast("decimal(18,2)")
    diff = F.col(total) - F.coalesce(F.col("_lines"), zero)
    return orders.select(order, total).join(sums, order, "left").select(order, as_double(diff).alias("diff_value"))
