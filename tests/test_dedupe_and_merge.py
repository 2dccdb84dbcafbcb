import random

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from lakemill.operators.dedupe import dedupe_earliest, dedupe_latest, key_lifecycle
from lakemill.operators.merge import dim_merge
from lakemill.operators.shape import empty_like

DIM = (
    "id int, v string, at timestamp_ntz, dwd_insert_user string, dwd_insert_time timestamp_ntz, "
    "dwd_modify_user string, dwd_modify_time timestamp_ntz"
)
RUN1, RUN2 = ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00")


def dim(spark, items, run):
    return spark.createDataFrame([(i, v, ts(at), "u", run, "u", run) for i, v, at in items], DIM)


def test_latest_and_earliest_with_null_order(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, "b"), (1, None, "c"), (2, None, "d"), (2, None, "e"), (None, 1, "f")], "k int, o int, v string")
    assert rows(dedupe_latest(df, ["k"], ["o"]), "k", "v") == [(1, "b"), (2, "e"), (None, "f")]
    assert rows(dedupe_earliest(df, ["k"], ["o"]), "k", "v") == [(1, "a"), (2, "d"), (None, "f")]


def test_hot_key_is_cut_down_before_the_exchange(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    latest = dedupe_latest(df, ["k"], ["o"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert latest.filter("k = 0").first().o == 29997


def test_lifecycle(spark):
    df = spark.createDataFrame([(1, 3, 4), (1, 1, 9), (2, 5, 5)], "k int, i int, m int")
    assert rows(key_lifecycle(df, ["k"], "i", "m"), "k", "i", "m") == [(1, 1, 9), (2, 5, 5)]


def test_dim_merge_cases(spark):
    old = dim(spark, [(1, "old only", "2023-01-01 00:00:00"), (3, "three a", "2023-01-01 00:00:00"),
                      (4, "stored", "2023-05-05 00:00:00"), (5, "newer stored", "2023-09-09 00:00:00")], RUN1)
    new = dim(spark, [(2, "new only", "2023-01-01 00:00:00"), (3, "three c", "2023-03-01 00:00:00"),
                      (3, "three b", "2023-02-01 00:00:00"), (4, "incoming", "2023-05-05 00:00:00"),
                      (5, "late", "2023-01-01 00:00:00")], RUN2)
    merged = dim_merge(new, old, ["id"], ["at"])
    assert merged.columns == new.columns
    got = {r.id: (r.v, r.dwd_insert_time, r.dwd_modify_time) for r in merged.collect()}
    assert got == {
        1: ("old only", RUN1, RUN1), 2: ("new only", RUN2, RUN2), 3: ("three c", RUN1, RUN2),
        4: ("incoming", RUN1, RUN2), 5: ("newer stored", RUN1, RUN2),
    }


def test_dim_merge_is_idempotent_and_order_free(spark):
    items = [(random.Random(7).randint(1, 9), f"v{i}", f"2023-01-{1 + i % 28:02d} 00:00:00") for i in range(60)]
    new, none = dim(spark, items, RUN2), empty_like(dim(spark, items, RUN2))
    once = dim_merge(new, none, ["id"], ["at"])
    assert rows(dim_merge(new, once, ["id"], ["at"])) == rows(once)
    assert rows(dim_merge(dim(spark, items[::-1], RUN2).repartition(3), none, ["id"], ["at"])) == rows(once)


def test_dim_merge_plans_one_exchange(spark):
    new = dim(spark, [(1, "a", "2023-01-01 00:00:00")], RUN2)
    plan = dim_merge(new, new, ["id"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("partial_max_by") == 1


def test_merge_refuses_drifted_stamps(spark):
    new = dim(spark, [(1, "a", "2023-01-01 00:00:00")], RUN2)
    drifted = new.withColumn("dwd_modify_time", F.date_format("dwd_modify_time", "yyyy-MM-dd HH:mm:ss"))
    with pytest.raises(TypeError):
        dim_merge(new, drifted, ["id"], ["at"])
