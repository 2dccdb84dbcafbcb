import random
import re
import struct
from decimal import Decimal

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from helpers import rows
from pyspark.sql import functions as F

from lakemill.operators.radix import double_code, totals_before
from lakemill.operators.ranking import global_rank, top_k, top_ranked
from lakemill.operators.sequences import banded_pairs, best_average_run, id_bounds, prefix_sum

EDGES = [0.0, -0.0, 1.0, 2.0, 4.0, 8.0, 0.5, 1e-300, 1e300, 5e-324, -1.0, -2.0, -1e300, 1.9999999999999998,
         2.0000000000000004, 1048575.9999999999, 1048576.0, 3.0, 3.0, 1000.01, None, None]


def rank_of(values):
    key = [(v is not None, v if v is not None else 0) for v in values]
    return [1 + sum(1 for other in key if other > mine) for mine in key]


@pytest.mark.parametrize("seed", [1, 2])
def test_global_rank_equals_rank(spark, seed):
    rng = random.Random(seed)
    values = EDGES + [round(rng.uniform(-50, 5000), 2) for _ in range(400)] + [77.0] * 200
    rng.shuffle(values)
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    got = dict(rows(global_rank(df, "v", "r"), "id", "r"))
    assert got == dict(enumerate(rank_of(values)))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False), min_size=2, max_size=60))
def test_double_code_is_the_order(spark, values):
    values += [v for v in EDGES if v is not None] + [float("inf"), -float("inf"), 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    code = dict(df.select("id", double_code(F.col("v"))).collect())
    for i, v in enumerate(values):
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert code[i] == (-bits if v < 0 else bits)


def test_ranks_are_of_decimals_not_of_their_doubles(spark):
    items = [(i, Decimal("90071992547409.91") + Decimal(i) / 100) for i in range(6)] + [(6, None), (7, None), (8, Decimal("-0.01"))]
    df = spark.createDataFrame(items, "id int, v decimal(18,2)")
    assert [r for _, r in rows(global_rank(df, "v", "r"), "id", "r")] == [6, 5, 4, 3, 2, 1, 8, 8, 7]
    assert rows(global_rank(df.select("id", F.col("id").alias("v")), "v", "r"), "r")[0] == (1,)
    with pytest.raises(TypeError):
        global_rank(df.withColumn("v", F.lit("x")), "v")


@pytest.mark.parametrize("descending", [False, True])
def test_totals_before_any_places(spark, descending):
    rng = random.Random(9)
    places = sorted({rng.randint(-2**63, 2**63 - 1) >> rng.choice([0, 9, 20, 40, 55]) for _ in range(400)} | {-2**63, 2**63 - 1, 0, -1})
    items = [(p, rng.randint(-5, 50)) for p in places]
    found = dict(rows(totals_before(spark.createDataFrame(items, "p long, n long"), "p", "n", "b", descending)))
    want, running = {}, 0
    for p, n in sorted(items, reverse=descending):
        want[p], running = running, running + n
    assert found == want


def test_close_values_and_scattered_ids_never_meet_in_one_task(spark):
    """100,000 values within half a percent, and 100,000 ids over 64 bits: windows see their own range and the few roots."""
    close = spark.range(100_000).select((F.lit(2 << 40) + F.col("id") * 50_000).alias("v"))
    scattered = spark.range(100_000).select(F.xxhash64("id").alias("id"), F.lit(1).cast("decimal(18,2)").alias("m"))
    for df in (global_rank(close, "v", "r"), prefix_sum(scattered, "id", "m")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        single = re.findall(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
        assert len(single) <= plan.count("windowspecdefinition(_r3") and single
        assert "InMemoryTableScan" not in plan
    assert global_rank(close, "v", "r").agg(F.sum("r")).first()[0] == 100_000 * 100_001 // 2
    total = prefix_sum(scattered, "id", "m")
    assert total.agg(F.max("sum"), F.countDistinct("sum")).first() == (100_000, 100_000)


def test_ties_at_the_last_place_stay(spark):
    df = spark.createDataFrame([("g", i, v) for i, v in enumerate([9, 8, 7, 7, 6])] + [("h", 9, 1)], "g string, i int, v int")
    assert [r[1] for r in rows(top_ranked(df, ["g"], "v", 3), "g", "i")] == [0, 1, 2, 3, 9]
    assert rows(top_k(df, [F.col("v").desc(), F.col("i")], 2), "i") == [(0,), (1,)]


def amounts(spark, items):
    return spark.createDataFrame(items, "id bigint, m double").select(
        "id", F.col("m").cast("decimal(18,2)").alias("m"))


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 18])
def test_prefix_sum_equals_plain_running_total(spark, width):
    rng = random.Random(3)
    items = [(rng.randint(-200, 500), float(rng.randint(0, 99))) for _ in range(300)]
    totals: dict[int, float] = {}
    for i, m in items:
        totals[i] = totals.get(i, 0) + m
    want, running = {}, 0.0
    for i in sorted(totals):
        running += totals[i]
        want[i] = running
    got = {i: float(s) for i, s in rows(prefix_sum(amounts(spark, items), "id", "m", width=width), "id", "sum")}
    assert got == want


@pytest.mark.parametrize("width", [40, 64, 1 << 14])
def test_banded_pairs_equal_brute_force(spark, width):
    ids = sorted(random.Random(5).sample(range(-100, 400), 220))
    df = amounts(spark, [(i, float(i)) for i in ids])
    got = [(a, b) for a, b in rows(banded_pairs(df, "id", ["m"], 20, 40, width), "left_id", "right_id")]
    want = sorted(((a, b) for a in ids for b in ids if 20 <= b - a <= 40), key=repr)
    assert got == want


def test_band_must_fit_into_a_range(spark):
    with pytest.raises(ValueError):
        banded_pairs(amounts(spark, [(1, 1.0)]), "id", ["m"], 20, 40, width=39)


def brute_best(items, distance):
    total: dict[int, float] = {}
    for i, m in items:
        total[i] = total.get(i, 0) + m
    low, high, k = min(total), max(total), distance + 1
    runs = []
    for first in range(low, high + 1):
        for length in range(k, 2 * k):
            last = first + length - 1
            if last <= high:
                runs.append((sum(total.get(i, 0) for i in range(first, last + 1)) / length, first, last))
    if not runs:
        return None
    best = max(r[0] for r in runs)
    tied = sorted((f, l) for a, f, l in runs if a == best)
    return best, f"{tied[0][0]}-{tied[0][1]}", len(tied)


def best_run(spark, items, distance, width, **more):
    out = best_average_run(amounts(spark, items), "id", "m", distance, width, **more).collect()
    return (out[0].avg_order_price, out[0].id_range, out[0].matchnum) if out else None


CASES = {
    "dense": [(i, float((i * 37) % 101)) for i in range(150)],
    "missing ids": [(i, float((i * 37) % 101 + 1)) for i in range(150) if i % 7 and i not in range(60, 90)],
    "sparse": [(i, 10.0) for i in (5, 9, 40, 41, 95, 140)],
    "negative ids": [(i, float((i * 13) % 29 + 1)) for i in range(-70, 30)],
    "repeated id": [(i % 40, 2.0) for i in range(90)],
    "peak at the start": [(0, 900.0)] + [(i, 1.0) for i in range(1, 60)],
    "peak at the end": [(i, 1.0) for i in range(60)] + [(60, 900.0)],
    "peak before a gap": [(63, 500.0), (200, 1.0)],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("distance,width", [(4, 16), (4, 64), (9, 1 << 14)])
def test_best_run_equals_brute_force(spark, case, distance, width):
    assert best_run(spark, CASES[case], distance, width) == brute_best(CASES[case], distance)


def test_best_run_corner_cases(spark):
    equal = [(i, 3.0) for i in range(30)]
    assert best_run(spark, equal, 4, 16) == brute_best(equal, 4)
    assert best_run(spark, [(1, 3.0), (2, 4.0)], 4, 16) is None
    df = amounts(spark, CASES["dense"])
    assert best_run(spark, CASES["dense"], 4, 16, bounds=id_bounds(df, "id")) == brute_best(CASES["dense"], 4)


LONG_TIES = {
    "flat": [(i, 3.0) for i in range(100)],
    "flat over gaps": [(i, 3.0) for i in range(100) if i not in (40, 41, 77)],
    "pattern": [(i, float(1 + i % 3)) for i in range(90)],
    "zeros": [(i, 0.0) for i in range(-20, 40, 3)],
    "negative ids": [(i, 2.5) for i in range(-60, 30)],
    "two stretches": [(i, 7.0) for i in [*range(5, 45), *range(60, 100)]],
}


@pytest.mark.parametrize("case", [*LONG_TIES, "sparse"])
@pytest.mark.parametrize("distance,width", [(4, 16)])
def test_ties_of_every_length_equal_sql(spark, case, distance, width):
    items = (LONG_TIES | CASES)[case]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT, c BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, round(100 * m)) for i, m in items])
    want = con.execute(f"""WITH dense AS (
          SELECT r.id, coalesce(t.c, 0) AS c FROM (SELECT unnest(range(min(id), max(id) + 1)) AS id FROM t) r LEFT JOIN t USING (id)),
        sums AS (SELECT id, c, sum(c) OVER (ORDER BY id) AS s FROM dense),
        runs AS (SELECT b.s - a.s + a.c AS s, b.id - a.id + 1 AS n FROM sums a JOIN sums b ON b.id - a.id >= {distance}),
        best AS (SELECT s, n FROM runs ORDER BY s::DOUBLE / n DESC LIMIT 1)
        SELECT count(*) FROM runs, best WHERE runs.s * best.n = best.s * runs.n""").fetchone()[0]
    assert best_run(spark, items, distance, width, every_length=True)[2] == want
