"""Medians against sorted lists, and their plans."""

import random
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakemill.operators.quantiles import lower_medians
from lakemill.plans.compare import median_levels


def middle(values):
    return sorted(values)[(len(values) + 1) // 2 - 1]


@pytest.mark.parametrize("reach", [1, 3, 1000, 10**9, 2**62])
def test_lower_medians_equal_sorted_lists(spark, reach):
    rng = random.Random(reach)
    items = [(rng.choice(["a", "b", None]), rng.randint(-reach, reach)) for _ in range(500)] + [("one", 5 % reach), ("same", 0)] + [("same", 0)] * 9
    counts = spark.createDataFrame([(k, v, 1) for k, v in items] + [("twice", 1, 2), ("twice", 0, 1)], "k string, v long, n long")
    want = {k: middle([v for other, v in items if other == k]) for k in {k for k, _ in items}} | {"twice": 1}
    assert dict(rows(lower_medians(counts, ["k"], "v", "n", "m"))) == want


def test_medians_of_both_levels(spark):
    rng = random.Random(4)
    items = [(rng.choice("PQ"), rng.choice(["x", "y", None]), f"2024-0{rng.randint(1, 2)}-03 10:00:00", Decimal(rng.randint(0, 10**9)) / 100) for _ in range(300)]
    items += [(None, "x", "2024-01-01 00:00:00", Decimal(1)), ("P", "x", None, Decimal(1)), ("P", "x", "2024-01-01 00:00:00", None)]
    df = spark.createDataFrame(items, "province string, city string, t string, m decimal(18,2)").select(
        "province", "city", F.col("t").cast("timestamp_ntz").alias("create_time"), "m")
    got = {r[:4]: r[4:] for r in rows(median_levels(df, ["city"], ["province"], ["year", "month"], "m"), "province", "city", "year", "month", "child_mid", "parent_mid")}
    groups, parents = {}, {}
    for p, c, t, m in items:
        if None not in (p, t, m):
            groups.setdefault((p, c, 2024, int(t[5:7])), []).append(m)
            parents.setdefault((p, int(t[5:7])), []).append(m)
    assert got == {k: (float(middle(v)), float(middle(parents[k[0], k[3]]))) for k, v in groups.items()}


def test_one_pass_over_the_orders(spark):
    """Medians of many rows in one group: the counts are the only thing read from the source."""
    path = spark.conf.get("spark.checkpoint.dir") + "/medians"
    spark.range(20_000).select(
        F.lit("P").alias("province"), F.lit("x").alias("city"), F.lit("2024-01-01").cast("timestamp_ntz").alias("create_time"),
        (F.col("id") * 7919 % 20_000).cast("decimal(18,2)").alias("m")).write.mode("overwrite").parquet(path)
    found = median_levels(spark.read.parquet(path), ["city"], ["province"], ["year"], "m")
    assert found.select("child_mid", "parent_mid").first() == (9999.0, 9999.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "ObjectHashAggregate" not in plan
