"""Shape of the physical plans, with automatic broadcast off so that every shuffle shows."""

import re

import pytest

from lakemill.checks.queries import registry

WRITING = {
    "keyed_scan", "full_extract", "full_extract_keyed", "write_partitioned", "append_partition", "precombine_write",
    "keyed_upsert", "dynamic_overwrite", "layer_bootstrap", "repair_partitions", "warehouse_e2e",
    "stream_sliding", "stream_extract", "stream_upsert", "stream_dim_merge", "current_facts", "valid_facts", "fact_history",
    "max_avg_run", "raw_scan", "rows_to_frame",
}
READING = sorted(set(registry()) - WRITING)

# Windows over the whole input that run in one task, and what bounds their input.
ONE_TASK_WINDOWS = {
    "running_total": "hours", "running_total_range": "hours", "running_total_top": "hours",
    "prefix_sum": "roots", "range_self_join": "roots", "city_month_consumption": "roots", "city_month_top": "roots",
    "region_rollup": "roots", "region_rollup_top": "roots", "region_rollup_keyed": "roots",
}


@pytest.fixture(scope="module")
def plan_of(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = {}

    def get(name):
        if name not in plans:
            plans[name] = registry()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        return plans[name]

    yield get
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.catalog.clearCache()


@pytest.mark.parametrize("name", READING)
def test_no_pairwise_join_and_no_python(plan_of, name):
    plan = plan_of(name)
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "ArrowEval"):
        assert bad not in plan


@pytest.mark.parametrize("name", READING)
def test_single_task_windows_are_the_bounded_ones(plan_of, name):
    plan = re.sub(r"Subquery[^\n]*", "", plan_of(name))
    found = re.search(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
    assert bool(found) <= (name in ONE_TASK_WINDOWS)


@pytest.mark.parametrize("name,columns", [
    ("repurchase_rate", {"o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"}),
    ("item_overlap", {"l_orderkey", "l_partkey"}),
    ("running_total", {"ts", "value"}),
    ("prefix_sum", {"o_orderkey", "o_totalprice"}),
])
def test_scans_read_only_what_they_need(plan_of, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(name))
    read = [{c.split(":")[0] for c in s.split(",")} for s in schemas]
    assert columns in read


@pytest.mark.parametrize("name", ["valid_orders", "user_day_consumption", "avg_vs_parent", "not_in", "running_total_range"])
def test_filters_reach_the_scan(plan_of, name):
    assert re.search(r"PushedFilters: \[[^\]]*(Not\(EqualTo|LessThanOrEqual)", plan_of(name))


@pytest.mark.parametrize("name", ["dim_merge", "dedupe_latest", "valid_orders", "key_lifecycle"])
def test_one_exchange(plan_of, name):
    assert plan_of(name).count("Exchange") == 1
