import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from lakemill.functions.keys import record_key
from lakemill.functions.times import calendar, default_run_day, normalise_times
from lakemill.operators import shape

TEXTS = [
    (1, None, None), (2, "NULL", None), (3, "2022-04-26 09:00:00", "2022-04-26 09:00:00"),
    (4, "2022-04-26 09:00:00.0", "2022-04-26 09:00:00"), (5, "20220426093000", "2022-04-26 09:30:00"),
    (6, "garbage", None), (7, "", None), (8, "2022-04-26 09:00:00.987", "2022-04-26 09:00:00"),
    (9, " 2022-4-6 9:05:00 ", "2022-04-06 09:05:00"), (10, "2022-02-30 09:00:00", None), (11, "20221399000000", None),
]


def test_text_times(spark):
    df = spark.createDataFrame([(i, t) for i, t, _ in TEXTS], "id int, t string")
    got = {r.id: r.t for r in normalise_times(df, ["t"]).collect()}
    assert got == {i: ts(w) for i, _, w in TEXTS}


def test_times_that_are_timestamps_lose_their_fraction(spark):
    df = spark.sql("select timestamp_ntz'2022-04-26 09:00:00.5' a, timestamp'2022-04-26 09:00:00.5' b")
    out = normalise_times(df, ["a", "b"])
    assert rows(out) == [(ts("2022-04-26 09:00:00"),) * 2]
    assert {t for _, t in out.dtypes} == {"timestamp_ntz"}


def test_bad_text_can_fail_the_job(spark):
    good = spark.createDataFrame([("NULL",), (None,), ("2022-04-26 09:00:00",)], "t string")
    assert normalise_times(good, ["t"], on_bad="raise").count() == 3
    bad = spark.createDataFrame([("garbage",)], "t string")
    with pytest.raises(Exception, match="unreadable time"):
        normalise_times(bad, ["t"], on_bad="raise").collect()


def test_calendar_and_run_day(spark):
    df = spark.sql("select timestamp_ntz'2022-04-26 09:00:00' t")
    assert rows(df.select(*calendar(F.col("t"), "year", "month", "day"))) == [(2022, 4, 26)]
    assert len(spark.range(1).select(default_run_day()).first()[0]) == 8


def test_audit_stamp_is_one_second_for_all_rows(spark):
    out = shape.audit_stamp(spark.range(100), "2024-01-01 10:00:00.75")
    assert rows(out.select("dwd_insert_user", "dwd_insert_time", "dwd_modify_user", "dwd_modify_time").distinct()) == [
        ("user1", ts("2024-01-01 10:00:00"), "user1", ts("2024-01-01 10:00:00"))]


def test_conform(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert shape.conform(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError, match="missing"):
        shape.conform(df, ["a", "z"])
    with pytest.raises(ValueError, match="extra"):
        shape.conform(df, ["a"], allow_extra=False)


def test_union_refuses_text_against_time(spark):
    a = spark.createDataFrame([("x",)], "t string")
    b = spark.sql("select timestamp_ntz'2022-04-26 09:00:00' t")
    with pytest.raises(TypeError):
        shape.union_by_name(a, b)
    c = spark.createDataFrame([(1, "k")], "n int, t string")
    assert rows(shape.union_by_name(c, c.select("t", "n"))) == [(1, "k"), (1, "k")]


def test_empty_like_keeps_schema(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    assert shape.empty_like(df).schema == df.schema and shape.empty_like(df).count() == 0


def test_backfill_and_optional_drop(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "a int, b int")
    assert rows(shape.backfill(df, "b", "a")) == [(1, 1), (1, 2)]
    assert shape.drop_if_present(df, "b", "nope").columns == ["a"]


def test_fact_clean(spark):
    df = spark.createDataFrame(
        [(1, "20220426093000", "short"), (2, "20220427093000", "much too long"), (3, "NULL", "short")],
        "id int, create_time string, city string")
    out = shape.fact_clean(df, "create_time", [], "2024-01-01 00:00:00", [F.length("city") <= 8])
    assert rows(out, "id", "etl_date") == [(1, "20220426"), (3, None)]


def test_record_key_is_stable_and_separates_columns(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "abc"), ("", "abc")], "x string, y string")
    keys = [r[0] for r in df.select(record_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(keys)) == 4 and keys == [r[0] for r in df.select(record_key(F.col("x"), F.col("y"))).collect()]
