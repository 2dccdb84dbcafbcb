from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakemill.session import fresh_database, fresh_dir, shared_root
from lakemill.sinks import keyed, layers, ledger, tables
from lakemill.sources.tables import from_rows, hide_meta, read_cols, read_keyed, read_path

SCHEMA = "k int, v string, t int, p string"


@pytest.fixture
def db(spark):
    return fresh_database(spark, "t")


def frame(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def keyed_table(spark, db, items, name="tab"):
    keyed.precombine_write(frame(spark, items), f"{db}.{name}", ["k"], ["t"], ["p"])
    return f"{db}.{name}"


def files(spark, table, p):
    return {r[0] for r in spark.table(table).filter(F.col("p") == p).select(F.input_file_name()).distinct().collect()}


def test_shared_root_is_the_configured_one(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_precombine_keeps_the_greatest(spark, db):
    t = keyed_table(spark, db, [(1, "a", 1, "x"), (1, "b", 3, "y"), (1, "c", 2, "x"), (2, "d", 1, "x")])
    assert rows(spark.table(t), "k", "v", "p") == [(1, "b", "y"), (2, "d", "x")]


def test_upsert_updates_inserts_and_moves(spark, db):
    t = keyed_table(spark, db, [(1, "a", 1, "x"), (2, "b", 1, "x"), (3, "c", 5, "y"), (4, "d", 1, "z")])
    untouched = files(spark, t, "z")
    batch = [(1, "a1", 2, "x"), (1, "a2", 3, "y"), (3, "late", 4, "y"), (5, "e", 1, "w"), (5, "e2", 2, "w")]
    keyed.keyed_upsert(frame(spark, batch), t, ["k"], ["t"])
    want = [(1, "a2", "y"), (2, "b", "x"), (3, "c", "y"), (4, "d", "z"), (5, "e2", "w")]
    assert rows(spark.table(t), "k", "v", "p") == want
    assert files(spark, t, "z") == untouched
    keyed.keyed_upsert(frame(spark, batch), t, ["k"], ["t"])
    assert rows(spark.table(t), "k", "v", "p") == want


def test_upsert_wins_equal_precombine(spark, db):
    t = keyed_table(spark, db, [(1, "stored", 1, "x")])
    keyed.keyed_upsert(frame(spark, [(1, "batch", 1, "x")]), t, ["k"], ["t"])
    assert rows(spark.table(t), "v") == [("batch",)]


def test_upsert_drops_the_partition_a_key_left_empty(spark, db):
    t = keyed_table(spark, db, [(1, "a", 1, "it's"), (2, "b", 1, "y")])
    keyed.keyed_upsert(frame(spark, [(1, "a", 2, "y")]), t, ["k"], ["t"])
    assert rows(spark.table(t), "k", "p") == [(1, "y"), (2, "y")]
    assert spark.sql(f"show partitions {t}").count() == 1


def test_upsert_with_null_partition_and_empty_batch(spark, db):
    t = keyed_table(spark, db, [(1, "a", 1, None), (2, "b", 1, "y")])
    keyed.keyed_upsert(frame(spark, []), t, ["k"], ["t"])
    assert spark.table(t).count() == 2
    keyed.keyed_upsert(frame(spark, [(1, "n", 2, None), (3, "m", 1, None)]), t, ["k"], ["t"])
    assert rows(spark.table(t), "k", "v", "p") == [(1, "n", None), (2, "b", "y"), (3, "m", None)]
    keyed.keyed_upsert(frame(spark, [(1, "o", 3, "y"), (3, "o", 3, "y")]), t, ["k"], ["t"])
    assert rows(spark.table(t), "k", "v", "p") == [(1, "o", "y"), (2, "b", "y"), (3, "o", "y")]


def test_upsert_with_two_partition_columns(spark, db):
    schema = "k int, t int, y int, m int"
    first = spark.createDataFrame([(1, 1, 2023, 1), (2, 1, 2023, 2)], schema)
    keyed.precombine_write(first, f"{db}.two", ["k"], ["t"], ["y", "m"])
    keyed.keyed_upsert(spark.createDataFrame([(1, 2, 2024, 1)], schema), f"{db}.two", ["k"], ["t"])
    assert rows(spark.table(f"{db}.two"), "k", "y", "m") == [(1, 2024, 1), (2, 2023, 2)]
    assert spark.sql(f"show partitions {db}.two").count() == 2


def test_upsert_needs_partitions(spark, db):
    layers.create_table(spark, f"{db}.flat", "k int, t int")
    with pytest.raises(ValueError, match="not partitioned"):
        keyed.keyed_upsert(spark.createDataFrame([(1, 1)], "k int, t int"), f"{db}.flat", ["k"], ["t"])


def test_dynamic_overwrite_leaves_other_partitions(spark, db):
    tables.write_partitioned(frame(spark, [(1, "a", 1, "x"), (2, "b", 1, "y")]), f"{db}.d", ["p"])
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        tables.overwrite_partitions(frame(spark, [(3, "c", 1, "x")]), f"{db}.d")
        frame(spark, [(4, "d", 1, "x")]).createOrReplaceTempView("replacement")
        tables.overwrite_partitions_sql("replacement", f"{db}.d", spark)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert rows(spark.table(f"{db}.d"), "k", "p") == [(2, "y"), (4, "x")]


def test_append_is_by_target_order(spark, db):
    tables.write_partitioned(frame(spark, [(1, "a", 1, "x")]), f"{db}.a", ["p"])
    tables.append_rows(frame(spark, [(2, "b", 2, "x")]).select("p", "t", "v", "k"), f"{db}.a")
    assert rows(spark.table(f"{db}.a"), "k", "v", "t", "p") == [(1, "a", 1, "x"), (2, "b", 2, "x")]


def test_publish_replaces_the_periods_it_covers(spark, db):
    months = spark.createDataFrame([(1, 2023, 1), (2, 2023, 2)], "v int, year int, month int")
    tables.publish(months, f"{db}.m")
    tables.publish(spark.createDataFrame([(9, 2023, 2)], "v int, year int, month int"), f"{db}.m")
    assert rows(spark.table(f"{db}.m"), "v", "month") == [(1, 1), (9, 2)]
    for v in (1, 2):
        tables.publish(spark.createDataFrame([(v,)], "v int"), f"{db}.flat")
    assert rows(spark.table(f"{db}.flat")) == [(2,)]
    with pytest.raises(Exception):
        tables.publish(spark.range(1).select(F.raise_error("no").cast("int").alias("v")), f"{db}.flat")
    assert rows(spark.table(f"{db}.flat")) == [(2,)]


def test_a_failing_write_fails_the_job_and_keeps_the_rows(spark, db):
    tables.write_partitioned(frame(spark, [(1, "a", 1, "x")]), f"{db}.f", ["p"])
    broken = frame(spark, [(2, "b", 1, "x")]).withColumn("k", F.raise_error("no").cast("int"))
    with pytest.raises(Exception):
        tables.overwrite_partitions(broken, f"{db}.f")
    assert rows(spark.table(f"{db}.f"), "k") == [(1,)]


def test_a_failing_replacement_keeps_the_rows(spark, db):
    tables.write_partitioned(frame(spark, [(1, "a", 1, "x")]), f"{db}.r", ["p"])
    broken = frame(spark, [(2, "b", 1, "x")]).withColumn("k", F.raise_error("no").cast("int"))
    with pytest.raises(Exception):
        tables.write_partitioned(broken, f"{db}.r", ["p"])
    assert rows(spark.table(f"{db}.r"), "k") == [(1,)]


def test_replacement_drops_what_it_does_not_cover(spark, db):
    t = f"{db}.r"
    tables.write_partitioned(frame(spark, [(1, "a", 1, "x"), (2, "b", 1, "y"), (3, "c", 1, None)]), t, ["p"])
    tables.write_partitioned(spark.table(t).filter("k > 1").withColumn("t", F.lit(9)), t, ["p"])
    assert rows(spark.table(t), "k", "t", "p") == [(2, 9, "y"), (3, 9, None)]
    assert spark.sql(f"show partitions {t}").count() == 2
    tables.write_partitioned(frame(spark, []), t, ["p"])
    assert spark.table(t).count() == 0
    tables.write_partitioned(frame(spark, [(7, "z", 1, "x")]).drop("v"), t, ["p"])
    assert rows(spark.table(t)) == [(7, 1, "x")]


def test_hot_partition_is_split_over_tasks(spark):
    plan = tables.rebalanced(frame(spark, [(1, "a", 1, "x")]), ["p"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_layers(spark, db):
    layers.create_table(spark, f"{db}.raw", "a int, c char(1), d decimal(8,2), b tinyint, p string", ["p"])
    layers.create_table(spark, f"{db}.raw", "other int")  # already there: left alone
    layers.create_like(spark, f"{db}.clean", f"{db}.raw", "stamp timestamp_ntz")
    assert layers.partition_columns(spark, f"{db}.clean") == ["p"]
    assert spark.table(f"{db}.clean").columns == ["a", "c", "d", "b", "stamp", "p"]
    layers.create_from_frame(frame(spark, []), f"{db}.empty", ["p"])
    assert rows(layers.row_counts(spark, [f"{db}.clean", f"{db}.empty"])) == [(f"{db}.clean", 0), (f"{db}.empty", 0)]
    assert layers.preview(spark, [f"{db}.empty"], 3)[f"{db}.empty"].count() == 0


def test_repair_finds_written_folders(spark, db):
    folder = fresh_dir(spark, "repair")
    layers.create_table(spark, f"{db}.r", SCHEMA, ["p"], location=folder)
    tables.write_folder(frame(spark, [(1, "a", 1, "x"), (2, "b", 1, "y")]), folder, ["p"])
    assert spark.table(f"{db}.r").count() == 0
    layers.repair_partitions(spark, f"{db}.r")
    assert spark.table(f"{db}.r").count() == 2
    assert read_path(spark, folder).count() == 2


def test_reading_hides_bookkeeping_by_name(spark, db):
    df = from_rows(spark, [(1, "x", 2)], "_hoodie_record_key int, v string, _hoodie_file_name int")
    assert hide_meta(df).columns == ["v"] and hide_meta(hide_meta(df)).columns == ["v"]
    t = keyed_table(spark, db, [(1, "a", 1, "x")])
    assert read_keyed(spark, t).columns == ["k", "v", "t", "p"]
    plan = read_cols(spark, t, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<v:string>" in plan


def test_upsert_reads_a_changing_source_once(spark, db):
    """Every evaluation of the batch gives other partitions, as its clock moves; only one may count."""
    t = keyed_table(spark, db, [(k, "stored", 1, str(k)) for k in range(40)])
    slot = (F.unix_micros(F.current_timestamp()) + F.col("id")) % 40
    drifting = spark.range(5).select(
        (F.col("id") + 100).cast("int").alias("k"), F.lit("new").alias("v"), F.lit(2).alias("t"),
        slot.cast("string").alias("p"))
    keyed.keyed_upsert(drifting, t, ["k"], ["t"])
    out = spark.table(t)
    assert out.filter("v = 'stored'").count() == 40 and out.filter("v = 'new'").count() == 5


def entries(spark, t):
    return rows(spark.table(ledger.name_of(t)), "k", "_place0", "_confirmed")


def test_the_ledger_follows_the_keys(spark, db):
    t = keyed_table(spark, db, [(1, "a", 1, "x"), (2, "b", 1, "y"), (None, "n", 1, "x")])
    keyed.keyed_upsert(frame(spark, [(2, "b", 2, "z"), (3, "c", 1, "x"), (None, "m", 2, "w")]), t, ["k"], ["t"])
    assert rows(spark.table(t), "k", "v", "p") == [(1, "a", "x"), (2, "b", "z"), (3, "c", "x"), (None, "m", "w")]
    moved = [(2, "z"), (3, "x"), (None, "w")]
    want = [(1, "x", True), (2, "y", True), (None, "x", True)] + [(k, p, c) for k, p in moved for c in (False, True)]
    assert entries(spark, t) == sorted(want, key=repr)
    held = len(entries(spark, t))
    keyed.keyed_upsert(frame(spark, [(1, "a2", 5, "x")]), t, ["k"], ["t"])
    assert len(entries(spark, t)) == held  # nothing moved, nothing written


def test_a_key_is_looked_for_where_it_was_confirmed_and_claimed(spark, db):
    t = keyed_table(spark, db, [(1, "a", 1, "x"), (2, "b", 1, "x")])
    ledger.ensure(spark, t, ["k"], ["p"])
    batch = frame(spark, [(1, "", 0, "")])
    where = lambda: rows(ledger.located(spark, t, batch, ["k"], ["p"]), "k", "p")
    assert where() == [(1, "x")]
    moved = frame(spark, [(1, "", 0, "y")]).select("k", "p")
    ledger.record(spark, t, moved, ["k"], ["p"], 10, confirmed=False)
    assert where() == [(1, "x"), (1, "y")]
    ledger.record(spark, t, moved, ["k"], ["p"], 10, confirmed=True)
    assert where() == [(1, "y")]


def test_an_upsert_that_died_half_way_is_mended_by_the_next(spark, db, monkeypatch):
    t = keyed_table(spark, db, [(1, "a", 1, "x"), (2, "b", 1, "x")])
    batch = frame(spark, [(1, "a2", 2, "y")])
    for broken in ("replace_covered", "drop_partitions"):
        with monkeypatch.context() as m:
            m.setattr(keyed, broken, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                keyed.keyed_upsert(batch, t, ["k"], ["t"])
    keyed.keyed_upsert(frame(spark, [(1, "a3", 3, "z")]), t, ["k"], ["t"])
    assert rows(spark.table(t), "k", "v", "p") == [(1, "a3", "z"), (2, "b", "x")]


def test_where_scattered_keys_are_stored_is_told_without_reading_the_table(spark, db):
    items = [(i * 7919 % 100_003, "v", 1, f"p{i % 5}") for i in range(400)]
    t = keyed_table(spark, db, items)
    ledger.ensure(spark, t, ["k"], ["p"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = frame(spark, [(i * 7919 % 100_003, "w", 2, "q") for i in range(0, 400, 9)])
        plan = ledger.located(spark, t, batch, ["k"], ["p"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "__keys" in scans[0] and "Bucketed: true" in scans[0]
    assert plan.count("Exchange hashpartitioning(k") <= 2  # the batch's keys alone: distinct, then into the buckets


def test_other_writes_drop_the_ledger(spark, db):
    t = keyed_table(spark, db, [(1, "a", 1, "x")])
    for write in (lambda: tables.append_rows(frame(spark, [(2, "b", 1, "y")]), t),
                  lambda: tables.overwrite_partitions(frame(spark, [(3, "c", 1, "z")]), t),
                  lambda: keyed.precombine_write(frame(spark, [(1, "a", 1, "x"), (4, "d", 1, "w")]), t, ["k"], ["t"], ["p"])):
        ledger.ensure(spark, t, ["k"], ["p"])
        write()
        assert not spark.catalog.tableExists(ledger.name_of(t))
    keyed.keyed_upsert(frame(spark, [(4, "d2", 2, "x")]), t, ["k"], ["t"])
    assert rows(spark.table(t), "k", "v", "p") == [(1, "a", "x"), (4, "d2", "x")]


def test_many_appended_files_make_the_ledger_new(spark, db, monkeypatch):
    monkeypatch.setattr(ledger, "FILES_PER_BUCKET", 0)
    t = keyed_table(spark, db, [(1, "a", 1, "x")])
    for i in range(3):
        keyed.keyed_upsert(frame(spark, [(1, "a", 2 + i, f"p{i}")]), t, ["k"], ["t"])
    ledger.ensure(spark, t, ["k"], ["p"])
    assert entries(spark, t) == [(1, "p2", True)]


def folders(spark):
    root = Path(shared_root(spark)) / "lakemill"
    return {p.name for p in root.iterdir() if p.name.startswith(("stage-", "version-"))}


def test_nothing_staged_stays_behind(spark, db, monkeypatch):
    before = folders(spark)
    t = keyed_table(spark, db, [(1, "a", 1, "x")])
    broken = frame(spark, [(2, "b", 1, "x")]).withColumn("k", F.raise_error("no").cast("int"))
    for write in (lambda: keyed.keyed_upsert(broken, t, ["k"], ["t"]), lambda: tables.write_partitioned(broken, t, ["p"]),
                  lambda: tables.write_partitioned(broken.drop("v"), t, ["p"])):
        with pytest.raises(Exception):
            write()
        assert folders(spark) == before
    assert rows(spark.table(t), "k") == [(1,)]


@pytest.mark.parametrize("step", ["create_table", "repair_partitions", "location"])
def test_a_table_of_another_shape_survives_a_failing_switch(spark, db, monkeypatch, step):
    t = f"{db}.s"
    tables.write_partitioned(frame(spark, [(1, "a", 1, "x")]), t, ["p"])
    other = frame(spark, [(2, "b", 1, "y")]).drop("v")
    before = folders(spark)
    with monkeypatch.context() as m:
        m.setattr(tables, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            tables.write_partitioned(other, t, ["p"])
    assert rows(spark.table(t)) == [(1, "a", 1, "x")]
    tables.write_partitioned(other, t, ["p"])
    assert rows(spark.table(t), "k", "p") == [(2, "y")] and "v" not in spark.table(t).columns
    tables.write_partitioned(frame(spark, [(3, "c", 1, "z")]), t, ["p"])
    assert rows(spark.table(t), "k", "v", "p") == [(3, "c", "z")]


def test_an_unpartitioned_table_is_switched_by_its_location(spark, db):
    t = f"{db}.flat"
    for i in range(3):
        tables.write_partitioned(spark.createDataFrame([(i, "a")], "v int, w string"), t, [])
        assert rows(spark.table(t)) == [(i, "a")]
    broken = spark.range(1).select(F.raise_error("no").cast("int").alias("v"), F.lit("b").alias("w"))
    with pytest.raises(Exception):
        tables.write_partitioned(broken, t, [])
    assert rows(spark.table(t)) == [(2, "a")]
    tables.write_partitioned(spark.createDataFrame([("z", 9)], "w string, v int"), t, [])
    assert rows(spark.table(t), "v", "w") == [(9, "z")]


def test_a_write_task_takes_a_bounded_share_of_one_partition(spark, db, monkeypatch):
    monkeypatch.setattr("lakemill.session.WRITE_BYTES", 1 << 14)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    rows_ = spark.range(0, 40_000, 1, 8).select("id", F.xxhash64("id").alias("v"), F.lit("one").alias("p"))
    tables.write_partitioned(rows_, f"{db}.shares", ["p"])
    assert len(spark.table(f"{db}.shares").inputFiles()) > 4 and spark.table(f"{db}.shares").count() == 40_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_the_first_upsert_leaves_the_ledger_to_the_next(spark, db):
    t = keyed_table(spark, db, [(9, "gone", 1, "q")])
    spark.sql(f"ALTER TABLE {t} DROP PARTITION (p = 'q')")
    keyed.keyed_upsert(frame(spark, [(1, "a", 1, "x"), (1, "a2", 2, "y"), (2, "b", 1, "y")]), t, ["k"], ["t"])
    assert rows(spark.table(t), "k", "v", "p") == [(1, "a2", "y"), (2, "b", "y")]
    assert not spark.catalog.tableExists(ledger.name_of(t))
    keyed.keyed_upsert(frame(spark, [(1, "a3", 3, "x")]), t, ["k"], ["t"], settled=True)
    assert rows(spark.table(t), "k", "v", "p") == [(1, "a3", "x"), (2, "b", "y")]
    assert entries(spark, t) == sorted([(1, "y", True), (2, "y", True), (1, "x", False), (1, "x", True)], key=repr)
