from decimal import Decimal

import pytest
from helpers import day, rows, ts
from pyspark.sql import functions as F

from lakemill.plans import behaviour, compare, consumption, series, toplists


def orders(spark, items, columns="order_sn int, customer_id int, order_money decimal(18,2), create_time timestamp_ntz, order_status string"):
    return spark.createDataFrame(items, columns)


def money(x):
    return Decimal(x).quantize(Decimal("0.01"))


def city(spark, items):
    """(province, city, amount) in January 2022."""
    return spark.createDataFrame(
        [(p, c, money(m), day("2022-01-05")) for p, c, m in items],
        "province string, city string, order_money decimal(18,2), create_time timestamp_ntz")


def test_valid_orders(spark):
    df = orders(spark, [
        (1, 1, money(5), day("2022-01-01"), "已完成"), (1, 1, money(7), day("2022-01-02"), "已退款"),
        (2, 1, money(1), day("2022-01-01"), None), (3, 2, money(2), day("2022-01-01"), "已付款"),
        (3, 2, money(3), day("2022-01-03"), "已付款"), (4, 2, money(9), day("2022-01-03"), "已退款")])
    assert rows(consumption.valid_orders(df), "order_sn", "order_money") == [(1, money(5)), (3, money(3))]
    assert consumption.valid_orders(df, "order_money").columns == ["order_money"]


def test_user_day_drops_unknown_users(spark):
    df = orders(spark, [
        (1, 1, money("1.10"), day("2022-01-01", 3), "a"), (2, 1, money("2.20"), day("2022-01-01", 5), "a"),
        (3, 9, money(1), day("2022-01-01"), "a")])
    users = spark.createDataFrame([(1, "ann")], "customer_id int, customer_name string")
    assert rows(consumption.user_day_consumption(df, users)) == [(1, "ann", 3.3, 2, 2022, 1, 1)]


def test_rollup_keeps_unknown_provinces(spark):
    df = spark.createDataFrame(
        [(1, money(5), day("2022-01-01")), (7, money(8), day("2022-01-01"))],
        "province_id int, final_total_amount decimal(18,2), create_time timestamp_ntz")
    provinces = spark.createDataFrame([(1, "p", 4)], "province_id int, province_name string, region_id int")
    regions = spark.createDataFrame([(5, "r")], "region_id int, region_name string")
    rollup = consumption.region_rollup(df, provinces, regions)
    assert rows(rollup) == [(1, "p", 4, None, 5.0, 1, 2022, 1, 2), (7, None, None, None, 8.0, 1, 2022, 1, 1)]
    keyed = consumption.keyed_rollup(rollup)
    assert keyed.select("uuid").distinct().count() == 2 and rows(keyed, "uuid") == rows(keyed, "uuid")


def test_average_against_parent(spark):
    df = city(spark, [("P", "a", 10), ("P", "a", 20), ("P", "b", 60), ("Q", "c", 5), (None, "d", 1)])
    assert rows(compare.avg_vs_parent(df)) == [
        ("a", 15.0, "P", 30.0, "低"), ("b", 60.0, "P", 30.0, "高"), ("c", 5.0, "Q", 5.0, "相同")]


def test_median_of_an_even_count_is_the_lower_middle(spark):
    df = city(spark, [("P", "a", 1), ("P", "a", 2), ("P", "a", 3), ("P", "a", 4), ("P", "b", 9), ("Q", "c", 5)])
    assert rows(compare.median_vs_parent(df)) == [
        ("a", 2.0, "P", 3.0, "低"), ("b", 9.0, "P", 3.0, "高"), ("c", 5.0, "Q", 5.0, "相同")]


def test_median_keeps_a_child_without_a_name(spark):
    df = city(spark, [("P", None, 1), ("P", "a", 3), ("P", "a", 3)])
    assert rows(compare.median_vs_parent(df), "cityname", "citymidconsumption", "provincemidconsumption") == [
        ("a", 3.0, 3.0), (None, 1.0, 3.0)]


def test_nation_median_by_year(spark):
    df = spark.createDataFrame(
        [(1, "p", 4, "r", money(m), day(d)) for m, d in ((1, "2020-01-01"), (5, "2020-06-01"), (9, "2021-01-01"))]
        + [(2, "q", 4, "r", money(7), day("2020-01-01"))],
        "province_id int, province_name string, region_id int, region_name string, "
        "final_total_amount decimal(18,2), create_time timestamp_ntz")
    assert rows(compare.nation_median(df, 2020)) == [(1, "p", 4, "r", 1.0, 5.0), (2, "q", 4, "r", 7.0, 5.0)]


def test_top_cities_with_tie_and_short_group(spark):
    df = city(spark, [("P", "a", 9), ("P", "b", 8), ("P", "c", "7.5"), ("P", "d", "7.5"), ("P", "e", 1), ("Q", "f", 2)])
    assert rows(toplists.top_cities(df, 2022)) == [("P", "a,b,c,d", "9,8,8,8"), ("Q", "f", "2")]
    assert toplists.top_cities(df, 2021).count() == 0


def lines(spark, items):
    return spark.createDataFrame(
        [(i, n, q, money(p)) for i, n, q, p in items],
        "product_id int, product_name string, product_cnt int, product_price decimal(18,2)")


def test_top_products_fewer_than_ten_and_ties(spark):
    df = lines(spark, [(1, "a", 5, 1), (2, "b", 5, 1), (3, "c", 1, 100), (1, "a", 1, 1)])
    got = rows(toplists.top_products(df).orderBy("sequence"))
    assert got == sorted([
        (1, 1, "a", 6, 3, "c", money(100)), (2, 2, "b", 5, 1, "a", money(6)), (3, 3, "c", 1, 2, "b", money(5))], key=repr)
    assert toplists.top_products(df, n=2).count() == 2


def test_top_products_scans_the_lines_once(spark, small):
    df = spark.read.parquet(f"{small}/lineitem.parquet").select(
        F.col("l_partkey").alias("product_id"), F.lit("x").alias("product_name"),
        F.col("l_quantity").alias("product_cnt"), F.col("l_extendedprice").alias("product_price"))
    assert toplists.top_products(df)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def visits(spark, items):
    return spark.createDataFrame([(u, day(d)) for u, d in items], "customer_id int, create_time timestamp_ntz")


@pytest.mark.parametrize("items,want", [
    ([(1, "2022-01-01"), (1, "2022-01-01"), (2, "2022-01-01")], (2, 0, "0.0%")),
    ([(1, "2022-01-01"), (1, "2022-01-01"), (1, "2022-01-02"), (2, "2022-01-01"), (3, "2022-01-01")], (3, 1, "33.3%")),
    ([(1, "2022-01-01"), (1, "2022-01-03")], (1, 0, "0.0%")),
    ([(1, "2022-01-31"), (1, "2022-02-01"), (1, "2022-05-05")], (1, 1, "100.0%")),
    ([], (0, 0, "0.0%")),
])
def test_repurchase(spark, items, want):
    assert rows(behaviour.repurchase_rate(visits(spark, items))) == [want]
    users, again, _ = want
    ratio = Decimal(again) / users if users else Decimal(0)
    assert rows(behaviour.repurchase_ratio(visits(spark, items)), "repurchaserate") == [(ratio.quantize(Decimal("0.0001")),)]


def test_consecutive_days(spark):
    df = spark.createDataFrame(
        [(1, money(2), day("2022-01-31", 5)), (1, money(3), day("2022-02-01")), (1, money(4), day("2022-02-01", 9)),
         (1, money(9), day("2022-02-03")), (2, money(1), day("2022-01-01"))],
        "user_id int, final_total_amount decimal(18,2), create_time timestamp_ntz")
    users = spark.createDataFrame([(1, "ann"), (2, "bob")], "user_id int, user_name string")
    assert rows(behaviour.consecutive_day_users(df, users)) == [(1, "ann", "20220131_20220201", 9.0, 3)]


def test_item_overlap(spark):
    om = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (5, 9)], "order_sn int, customer_id int")
    od = spark.createDataFrame(
        [(1, 10), (1, 11), (1, 12), (1, 99), (2, 10), (2, 10), (2, 11), (3, 12), (4, 50), (5, 10), (5, 99)],
        "order_sn int, product_id int")
    customers = spark.createDataFrame([(1,), (2,), (3,), (4,)], "customer_id int")
    products = spark.createDataFrame([(10,), (11,), (12,), (50,)], "product_id int")
    args = (om, od, customers, products, 1)
    assert rows(behaviour.item_overlap(*args)) == [(2, 2), (3, 1)]
    assert rows(behaviour.item_overlap(*args, exclude_self=False)) == [(1, 3), (2, 2), (3, 1)]
    assert behaviour.item_overlap(om, od, customers, products, 77).count() == 0


def test_order_difference(spark):
    om = spark.createDataFrame([(1, money(10)), (2, money(4))], "order_id int, final_total_amount decimal(18,2)")
    od = spark.createDataFrame([(1, money("2.50")), (1, money("7.25"))], "order_id int, line_amount decimal(18,2)")
    assert rows(behaviour.order_amount_diff(om, od)) == [(1, 0.25), (2, 4.0)]


def test_pivot_takes_its_columns_from_the_caller(spark):
    df = spark.createDataFrame([(p,) for p in ["b", "a", "c.d", "c.d", "e", "e", None, "other"]], "province string")
    wide = series.pivot_counts(df, ["a", "b", "c.d", "e", "none"])
    assert wide.columns == ["c.d", "e", "a", "b", "none"] and rows(wide) == [(2, 2, 1, 1, 0)]
    assert rows(series.counts_by_value(df)) == [("a", 1), ("b", 1), ("c.d", 2), ("e", 2), ("other", 1)]


def test_valid_orders_keep_one_version_for_every_projection(spark):
    data = [("n1", "2022-01-01 00:00:00", "2022-01-03 00:00:00", "x", 5, "ok"), ("n1", "2022-01-01 00:00:00", "2022-01-02 00:00:00", "y", 10, "ok")]
    df = spark.createDataFrame(data, "order_sn string, create_time string, modified_time string, city string, order_money int, order_status string")
    assert rows(consumption.valid_orders(df, "order_money")) == [(5,)]
    assert rows(consumption.valid_orders(df, "city", "order_money")) == [("x", 5)]


TIMED = [("2022-04-26 00:00:00", 1), ("2022-04-26 00:59:59", 2), ("2022-04-26 03:00:00", 4), ("2022-04-26 09:59:59", 8),
         ("2022-04-26 10:00:00", 16), ("2022-04-25 23:59:59", 32)]


def timed(spark):
    return spark.createDataFrame(
        [(ts(t), money(m)) for t, m in TIMED], "create_time timestamp_ntz, order_money decimal(18,2)")


def test_running_total_in_a_closed_range(spark):
    out = series.running_total(timed(spark), "2022-04-26 00:00:00", "2022-04-26 09:59:59")
    assert rows(out) == [("2022-04-26 00", 3.0, 3.0), ("2022-04-26 03", 4.0, 7.0), ("2022-04-26 09", 8.0, 15.0)]
    whole = rows(series.running_total(timed(spark)))
    assert whole[-1][2] == sum(m for _, m in TIMED)


def test_sliding_windows(spark):
    out = series.sliding_window(timed(spark), "2022-04-26 04", "2022-04-26 09")
    assert rows(out) == [
        ("2022-04-26 04", 39.0, 4.0, 9.75), ("2022-04-26 05", 7.0, 3.0, 2.33), ("2022-04-26 06", 4.0, 1.0, 4.0),
        ("2022-04-26 07", 4.0, 1.0, 4.0), ("2022-04-26 08", 4.0, 1.0, 4.0)]
    every = series.sliding_window(timed(spark)).agg(F.sum("consumptionsum")).first()[0]
    assert every == 5 * sum(m for _, m in TIMED)
