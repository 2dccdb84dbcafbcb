from decimal import Decimal

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from lakemill.operators import shape
from lakemill.plans import series
from lakemill.session import fresh_database, fresh_dir
from lakemill.sinks import keyed, tables
from lakemill.streaming import ingest, sliding, upsert


def drop(spark, folder, items, schema):
    spark.createDataFrame(items, schema).coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch_on_closed_windows(spark):
    schema = "create_time timestamp_ntz, order_money decimal(18,2)"
    items = [(ts(f"2024-01-{d:02d} {h:02d}:15:00"), Decimal(d * h)) for d in (1, 2) for h in range(24)]
    folder, out = fresh_dir(spark, "in"), fresh_dir(spark, "out")
    drop(spark, folder, items, schema)
    events = spark.read.schema(schema).parquet(folder)
    stream = ingest.file_stream(spark, folder, events.schema)
    ingest.drain_to_path(sliding.sliding_stream(stream), f"{out}/rows", f"{out}/cp")
    got = rows(spark.read.parquet(f"{out}/rows"))
    batch = rows(series.sliding_window(events).drop("consumptionavg"))
    assert got == [r for r in batch if r[0] <= "2024-01-02 22"] and len(batch) > len(got) > 40


def test_extract_reads_each_file_once(spark):
    schema = "id int, v string"
    folder, out = fresh_dir(spark, "in"), fresh_dir(spark, "out")
    drop(spark, folder, [(1, "a")], schema)
    table = spark.read.parquet(folder)
    for day in ("20240101", "20240102"):
        stream = ingest.file_stream(spark, folder, table.schema, files_per_batch=1)
        ingest.extract_stream(stream, f"{out}/rows", f"{out}/cp", day)
        drop(spark, folder, [(2, "b"), (3, "c")], schema)
    got = spark.read.schema("id int, v string, etl_date string").parquet(f"{out}/rows")
    assert rows(got, "id", "etl_date") == [(1, "20240101"), (2, "20240102"), (3, "20240102")]


def test_upsert_stream_over_batches_and_redelivery(spark):
    schema = "k int, v string, t int, p string"
    folder, table = fresh_dir(spark, "in"), f"{fresh_database(spark, 's')}.t"
    keyed.precombine_write(spark.createDataFrame([(1, "old", 1, "x"), (9, "stay", 1, "z")], schema), table, ["k"], ["t"], ["p"])
    want = [(1, "late wins", 5, "y"), (2, "new", 1, "x"), (9, "stay", 1, "z")]
    for item in [(1, "late wins", 5, "y"), (2, "new", 1, "x"), (1, "too late", 3, "x")]:
        drop(spark, folder, [item], schema)
    files = spark.read.parquet(folder)
    for checkpoint in ("first", "again"):  # a fresh checkpoint delivers everything once more
        stream = ingest.file_stream(spark, folder, files.schema, files_per_batch=1)
        upsert.upsert_stream(stream, table, ["k"], ["t"], f"{fresh_dir(spark, checkpoint)}/cp")
        assert rows(spark.table(table), "k", "v", "t", "p") == want


def test_window_state_is_keyed_by_window_only(spark):
    stream = spark.readStream.format("rate").load().select(
        F.col("timestamp").alias("create_time"), F.col("value").cast("decimal(18,2)").alias("order_money"))
    plan = sliding.sliding_stream(stream)
    assert plan.isStreaming and plan.columns == ["consumptiontime", "consumptionsum", "consumptioncount"]


def test_dimension_merge_over_batches_and_redelivery(spark):
    """The second batch dies after its merge was written, and comes again under a later clock."""
    schema = "k int, v string, t int, p string"
    folder, table = fresh_dir(spark, "in"), f"{fresh_database(spark, 's')}.dim"
    tables.write_partitioned(shape.audit_stamp(spark.createDataFrame([], schema), "2024-01-01 00:00:00"), table, ["p"])
    checkpoint = f"{fresh_dir(spark, 'cp')}/cp"
    stream = lambda: ingest.file_stream(spark, folder, spark.read.parquet(folder).schema)
    drop(spark, folder, [(1, "old", 1, "x"), (2, "b", 1, "y")], schema)
    upsert.dim_merge_stream(stream(), table, ["k"], ["t"], checkpoint, lambda: "2024-01-01 02:00:00")
    drop(spark, folder, [(1, "new", 2, "z"), (3, "c", 1, "y")], schema)
    merged = upsert.keyed_upsert

    def dies(*args):
        merged(*args)
        raise RuntimeError("lost after the write")

    with pytest.MonkeyPatch.context() as m:
        m.setattr(upsert, "keyed_upsert", dies)
        with pytest.raises(Exception, match="lost after the write"):
            upsert.dim_merge_stream(stream(), table, ["k"], ["t"], checkpoint, lambda: "2024-01-02 02:00:00")
    upsert.dim_merge_stream(stream(), table, ["k"], ["t"], checkpoint, lambda: "2024-01-03 02:00:00")
    first, second = ts("2024-01-01 02:00:00"), ts("2024-01-02 02:00:00")
    assert rows(spark.table(table), "k", "v", "p", "dwd_insert_time", "dwd_modify_time") == [
        (1, "new", "z", first, second), (2, "b", "y", first, first), (3, "c", "y", second, second)]
    upsert.dim_merge_stream(stream(), table, ["k"], ["t"], checkpoint, lambda: "2024-01-04 02:00:00")
    assert spark.table(table).count() == 3


def test_upsert_stream_takes_a_merge(spark):
    schema = "k int, v string, t int, p string"
    folder, table = fresh_dir(spark, "in"), f"{fresh_database(spark, 's')}.t"
    keyed.precombine_write(spark.createDataFrame([(1, "old", 1, "x")], schema), table, ["k"], ["t"], ["p"])
    drop(spark, folder, [(1, "new", 5, "x")], schema)
    keep_stored = lambda batch, stored: stored.unionByName(batch.join(stored, "k", "left_anti"))
    stream = ingest.file_stream(spark, folder, spark.read.parquet(folder).schema)
    upsert.upsert_stream(stream, table, ["k"], ["t"], f"{fresh_dir(spark, 'cp')}/cp", merge=keep_stored, keys_move=False)
    assert rows(spark.table(table), "v") == [("old",)]


def test_versions_are_written_by_many_tasks(spark, small, monkeypatch):
    from lakemill.checks import queries

    lines = spark.read.parquet(f"{small}/lineitem.parquet").repartition(6)
    monkeypatch.setattr(queries.model, "table", lambda *_: lines)
    folders = []
    monkeypatch.setattr(queries, "fresh_dir", lambda s, label: folders.append(fresh_dir(s, label)) or folders[-1])
    queries.registry()["stream_dim_merge"](spark, small)
    assert len(spark.read.parquet(folders[0]).inputFiles()) > 6
