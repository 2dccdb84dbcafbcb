"""Top lists: cities per province, products by quantity beside products by value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lakemill.functions.times import in_year
from lakemill.operators.ranking import top_ranked


def _ranked_totals(orders: DataFrame, group: list[str], member: list[str], amount: str, year: int, k: int):
    wanted = orders.filter(in_year(orders, "create_time", year))
    totals = wanted.groupBy(*group, *member).agg(F.sum(amount).alias("_amount"))
    return top_ranked(totals, group, "_amount", k)


def _list_text(field: str):
    return F.array_join(F.transform("_top", lambda x: x[field].cast("string")), ",").alias(field)


def _joined(ranked: DataFrame, group: list[str], member: list[str]) -> DataFrame:
    """One row per group; the lists are ordered by rank, then by member."""
    entry = F.struct("rank", *member, F.round("_amount", 0).cast("bigint").alias("amount"))
    lists = ranked.groupBy(*group).agg(F.sort_array(F.collect_list(entry)).alias("_top"))
    return lists.select(*group, *[_list_text(m) for m in member], _list_text("amount"))


def top_cities(orders: DataFrame, year: int, amount: str = "order_money", k: int = 3) -> DataFrame:
    """Per province the ``k`` cities with the greatest amount of a year, as comma lists.

    Ranking is ``rank``: cities that tie at place ``k`` all appear.
    """
    joined = _joined(_ranked_totals(orders, ["province"], ["city"], amount, year, k), ["province"], ["city"])
    return joined.select(
        F.col("province").alias("provincename"), F.col("city").alias("citynames"),
        F.col("amount").alias("cityamount"),
    )


def top_provinces(orders: DataFrame, year: int, amount: str = "final_total_amount", k: int = 3) -> DataFrame:
    """Per region the ``k`` provinces with the greatest amount of a year, as comma lists."""
    group, member = ["region_id", "region_name"], ["province_id", "province_name"]
    joined = _joined(_ranked_totals(orders, group, member, amount, year, k), group, member)
    return joined.select(
        F.col("region_id").alias("regionid"), F.col("region_name").alias("regionname"),
        F.col("province_id").alias("provinceids"), F.col("province_name").alias("provincenames"),
        F.col("amount").alias("provinceamount"),
    )


def top_products(
    lines: DataFrame,
    product: str = "product_id",
    name: str = "product_name",
    quantity: str = "product_cnt",
    price: str = "product_price",
    n: int = 10,
    products: DataFrame | None = None,
) -> DataFrame:
    """The ``n`` products by quantity beside the ``n`` by value, matched on place; ties go by id.

    Lines normally carry the product name. Where they do not, ``products`` supplies it and is joined
    to the listed products only.

    The lines are grouped once for both lists. Each product then offers one entry per list and
    ``row_number <= n`` keeps ``n`` entries per list and task before the exchange.
    """
    keys = [product] if products is not None else [product, name]
    totals = lines.groupBy(*keys).agg(
        F.sum(quantity).alias("_quantity"), F.sum(F.col(quantity) * F.col(price)).alias("_value")
    )
    entries = totals.select(
        *keys, "_quantity", "_value", F.explode(F.array(F.lit("quantity"), F.lit("value"))).alias("_list")
    ).withColumn("_score", F.when(F.col("_list") == "quantity", F.col("_quantity")).otherwise(F.col("_value")))
    place = Window.partitionBy("_list").orderBy(F.col("_score").desc_nulls_last(), *[F.col(c).asc() for c in keys])
    top = entries.withColumn("sequence", F.row_number().over(place)).filter(F.col("sequence") <= n)

    if products is not None:
        top = top.join(products.select(product, name), product, "left")

    def side(kind: str, field: str):
        return F.max(F.when(F.col("_list") == kind, F.col(field)))

    # Both lists have one entry per product, hence the same length: this equals the left join on place.
    return top.groupBy("sequence").agg(
        side("quantity", product).alias("topquantityid"),
        side("quantity", name).alias("topquantityname"),
        side("quantity", "_quantity").cast("bigint").alias("topquantity"),
        side("value", product).alias("toppriceid"),
        side("value", name).alias("toppricename"),
        side("value", "_value").alias("topprice"),
    )
