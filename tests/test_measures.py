"""Both retail feeds from hand rows through extract and clean to every metric."""

from decimal import Decimal

import pytest
from helpers import rows, ts
from test_jobs import source

from lakemill.__main__ import arguments, parameters, run
from lakemill.plans import feeds, jobs, measures, reports
from lakemill.session import fresh_database

NIGHT, RUN_TS = "20220427", "2022-04-27 01:00:00"


def load(spark, feed, data):
    ods, dwd = fresh_database(spark, "ods"), fresh_database(spark, "dwd")
    jobs.set_up(spark, feed, ods, dwd)
    jobs.extract_feed(
        spark, feed, lambda n: source(spark, next(s for s in feed if s.source == n), data[n]), ods, NIGHT, RUN_TS)
    jobs.clean_feed(spark, feed, ods, dwd, NIGHT, RUN_TS)
    return dwd


@pytest.fixture(scope="module")
def retail_b(spark):
    at = ts("2022-04-26 23:00:00")
    orders = [
        ("s1", 1, "P", "x", "10.00", "20220426001500", "done"), ("s2", 1, "P", "x", "20.00", "20220425235900", "done"),
        ("s3", 2, "P", "y", "30.00", "20220426010000", "done"), ("s4", 2, "Q", "z", "40.00", "20220426030000", "已退款"),
        ("s5", 9253, "Q", "z", "50.00", "20220426090000", "done")]
    details = [("s1", 7, 2, "1.00"), ("s1", 8, 1, "9.00"), ("s3", 7, 1, "1.00"), ("s5", 7, 1, "1.00"), ("s5", 8, 1, "2.00")]
    return load(spark, feeds.RETAIL_B, {
        "customer_inf": [{"customer_id": i, "customer_name": f"n{i}", "modified_time": at} for i in (1, 2, 9253)],
        "product_info": [{"product_id": i, "modified_time": at} for i in (7, 8)],
        "order_master": [
            {"order_id": n, "order_sn": s, "customer_id": c, "province": p, "city": y, "order_money": Decimal(m),
             "create_time": t, "order_status": st, "modified_time": at}
            for n, (s, c, p, y, m, t, st) in enumerate(orders)],
        "order_detail": [
            {"order_detail_id": n, "order_sn": s, "product_id": p, "product_name": f"p{p}", "product_cnt": q,
             "product_price": Decimal(m), "create_time": "20220426000000", "modified_time": at}
            for n, (s, p, q, m) in enumerate(details)],
    })


@pytest.fixture(scope="module")
def retail_a(spark):
    made = [ts("2020-01-01 10:00:00"), ts("2020-01-02 10:00:00"), ts("2020-02-01 10:00:00")]
    orders = [(1, 11, 1, "10.00", made[0]), (2, 11, 1, "20.00", made[1]), (3, 12, 2, "60.00", made[2])]
    return load(spark, feeds.RETAIL_A, {
        "user_info": [{"id": i, "name": f"u{i}", "create_time": made[0]} for i in (11, 12)],
        "sku_info": [{"id": 5, "create_time": made[0]}],
        "base_province": [{"id": 1, "name": "P", "region_id": "3"}, {"id": 2, "name": "Q", "region_id": "3"}],
        "base_region": [{"id": "3", "region_name": "R"}],
        "order_info": [
            {"id": i, "user_id": u, "province_id": p, "final_total_amount": Decimal(m), "create_time": t}
            for i, u, p, m, t in orders],
        "order_detail": [
            {"id": 1, "order_id": 1, "sku_id": 5, "sku_name": "s", "sku_num": "10", "order_price": Decimal("0.90"),
             "create_time": made[0]},
            {"id": 2, "order_id": 3, "sku_id": 6, "sku_name": "t", "sku_num": "2", "order_price": Decimal("30.00"),
             "create_time": made[0]}],
    })


WANT_B = {
    "user_consumption_day_aggr": [
        (1, "n1", 10.0, 1, 2022, 4, 26), (1, "n1", 20.0, 1, 2022, 4, 25), (2, "n2", 30.0, 1, 2022, 4, 26),
        (9253, "n9253", 50.0, 1, 2022, 4, 26)],
    "city_consumption_day_aggr": [
        ("x", "P", 30.0, 2, 2022, 4, 2), ("y", "P", 30.0, 1, 2022, 4, 2), ("z", "Q", 50.0, 1, 2022, 4, 1)],
    "cityavgcmpprovince": [("x", 15.0, "P", 20.0, "低"), ("y", 30.0, "P", 20.0, "高"), ("z", 50.0, "Q", 50.0, "相同")],
    "citymidcmpprovince": [("x", 10.0, "P", 20.0, "低"), ("y", 30.0, "P", 20.0, "高"), ("z", 50.0, "Q", 50.0, "相同")],
    "regiontopthree": [("P", "x,y", "30,30"), ("Q", "z", "50")],
    "topten": [(1, 7, "p7", 4, 8, "p8", Decimal("11.00")), (2, 8, "p8", 2, 7, "p7", Decimal("4.00"))],
    "userrepurchasedrate": [(3, 1, "33.3%")],
    "provinceordercount": [(3, 1)],
    "accumulateconsumption": [
        ("2022-04-26 00", 10.0, 10.0), ("2022-04-26 01", 30.0, 40.0), ("2022-04-26 09", 50.0, 90.0)],
    "slidewindowconsumption": [
        ("2022-04-26 04", 60.0, 3.0, 20.0), ("2022-04-26 05", 40.0, 2.0, 20.0), ("2022-04-26 06", 30.0, 1.0, 30.0)],
    "itemoverlap": [(1, 2), (2, 1)],
}
WANT_A = {
    "province_consumption_day_aggr": [(1, "P", 3, "R", 30.0, 2, 2020, 1, 2), (2, "Q", 3, "R", 60.0, 1, 2020, 2, 1)],
    "user_consumption_day_aggr": [
        (11, "u11", 10.0, 1, 2020, 1, 1), (11, "u11", 20.0, 1, 2020, 1, 2), (12, "u12", 60.0, 1, 2020, 2, 1)],
    "topten": [(1, 5, "s", 10, 6, "t", Decimal("60.00")), (2, 6, "t", 2, 5, "s", Decimal("9.00"))],
    "nationmedian": [(1, "P", 3, "R", 10.0, 20.0), (2, "Q", 3, "R", 60.0, 20.0)],
    "provinceavgcmp": [(1, "P", 15.0, 15.0, "相同"), (2, "Q", 60.0, 60.0, "相同")],
    "provinceavgcmpregion": [(1, "P", 15.0, 3, "R", 15.0, "相同"), (2, "Q", 60.0, 3, "R", 60.0, "相同")],
    "regiontopthree": [(3, "R", "2,1", "Q,P", "60,30")],
    "usercontinueorder": [(11, "u11", "20200101_20200102", 30.0, 2)],
    "userrepurchasedrate": [(2, 1, Decimal("0.5000"))],
    "order_final_money_amount_diff": [(1, 1.0), (2, 20.0), (3, 0.0)],
    "max_avg_order_price_seq": [],
}


@pytest.mark.parametrize("name", WANT_B)
def test_retail_b(spark, retail_b, name):
    assert rows(measures.RETAIL_B[name](spark, retail_b)) == sorted(WANT_B[name], key=repr)


@pytest.mark.parametrize("name", WANT_A)
def test_retail_a(spark, retail_a, name):
    assert rows(measures.RETAIL_A[name](spark, retail_a)) == sorted(WANT_A[name], key=repr)


def test_nothing_is_left_out(spark, retail_a):
    assert set(WANT_B) == set(measures.RETAIL_B)
    assert set(measures.RETAIL_A) - set(WANT_A) == {"province_consumption_day_aggr_keyed"}
    keyed = measures.province_month_keyed(spark, retail_a)
    assert keyed.select("uuid").distinct().count() == 2
    assert rows(measures.best_run(spark, retail_a, min_distance=1)) == [(1, 40.0, "2-3", 1)]


def test_read_backs(spark, retail_b):
    result = measures.city_month(spark, retail_b)
    assert [r.city_name for r in reports.read_back(result, "city_consumption_day_aggr", 2).collect()] == ["x", "z"]
    for name in set(WANT_B) & set(reports.ORDERS):
        assert reports.read_back(measures.RETAIL_B[name](spark, retail_b), name, 1).count() == 1


def test_command_line(spark, retail_b):
    results = fresh_database(spark, "dws")
    run(spark, arguments().parse_args(
        ["measure", "--feed", "retail_b", "--dwd", retail_b, "--results", results, "--name", "topten", "itemoverlap",
         "city_consumption_day_aggr"]))
    assert rows(spark.table(f"{results}.itemoverlap")) == WANT_B["itemoverlap"]
    months = spark.table(f"{results}.city_consumption_day_aggr")
    assert months.columns[-2:] == ["year", "month"] and months.count() == 3
    ods, dwd = fresh_database(spark, "ods"), fresh_database(spark, "dwd")
    run(spark, arguments().parse_args(["set-up", "--feed", "manufacturing", "--ods", ods, "--dwd", dwd]))
    assert spark.catalog.tableExists(f"{ods}.changerecord")
    run(spark, arguments().parse_args(["set-up", "--feed", "retail_a", "--ods", ods, "--dwd", dwd]))
    run(spark, arguments().parse_args(
        ["clean", "--feed", "retail_a", "--ods", ods, "--dwd", dwd, "--run-day", NIGHT, "--run-ts", RUN_TS]))
    assert spark.table(f"{dwd}.fact_order_info").count() == 0


def test_parameters_from_the_command_line(spark, retail_b):
    results = fresh_database(spark, "dws")
    names = ["accumulateconsumption", "slidewindowconsumption", "itemoverlap", "regiontopthree"]
    run(spark, arguments().parse_args(
        ["measure", "--feed", "retail_b", "--dwd", retail_b, "--results", results, "--name", *names, "--set", "target=1", "exclude_self=false",
         "start=2022-04-25 00:00:00", "end=2022-04-25 23:59:59", "year=2021", "hours=9"]))
    assert rows(spark.table(f"{results}.accumulateconsumption")) == [("2022-04-25 23", 20.0, 20.0)]
    assert rows(spark.table(f"{results}.itemoverlap")) == [(1, 2), (2, 1), (9253, 2)]
    assert spark.table(f"{results}.regiontopthree").count() == 0
    assert [r[0] for r in rows(spark.table(f"{results}.slidewindowconsumption"))] == [f"2022-04-26 0{h}" for h in range(4, 10)]
    for wrong in (["nothing=1"], ["exclude_self=maybe"]):
        with pytest.raises(SystemExit):
            parameters(["itemoverlap"], measures.RETAIL_B, wrong)


def test_too_many_columns_are_an_error(spark, retail_b):
    with pytest.raises(ValueError):
        measures.province_counts(spark, retail_b, most=1)
