"""Generic jobs driven by a :class:`~lakemill.plans.feeds.TableSpec`: set up, extract, clean.

Each job takes the run day and run time as arguments and runs one write action.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from lakemill.functions.times import normalise_times
from lakemill.operators.incremental import incremental_from, incremental_pushed
from lakemill.operators.merge import dim_merge
from lakemill.operators.shape import (
    audit_stamp, backfill, drop_if_present, empty_like, fact_clean, stamp_load_time, stamp_partition,
)
from lakemill.plans.feeds import Kept, TableSpec
from lakemill.sinks.keyed import keyed_upsert, precombine_write
from lakemill.sinks.layers import create_from_frame, create_layer, create_table, drop_partitions
from lakemill.sinks.tables import append_rows, overwrite_partitions, write_partitioned

LOAD_DAY = "load_day"


def _prepared(source: DataFrame, spec: TableSpec, run_day: str, run_ts: str) -> DataFrame:
    rows = drop_if_present(source, *spec.drops)
    for column, other in spec.fills:
        rows = backfill(rows, column, other)
    if spec.load_time:
        rows = stamp_load_time(rows, run_ts, spec.load_time)
    return stamp_partition(rows, run_day, spec.partition)


def cleaned_schema(spark: SparkSession, ods_table: str, spec: TableSpec) -> DataFrame:
    """An empty frame with the cleaned table's schema: parsed times, stamps, load day of a fact, partition last."""
    rows = empty_like(spark.table(ods_table))
    times = list(spec.time_columns) + ([] if spec.dimension else [spec.event_time])
    rows = audit_stamp(normalise_times(rows, list(dict.fromkeys(times))), "1970-01-01 00:00:00")
    if not spec.dimension:
        rows = stamp_partition(rows, "", LOAD_DAY)
    parts = _parts(spec)
    return rows.select(*[c for c in rows.columns if c not in parts], *parts)


def _parts(spec: TableSpec) -> list[str]:
    """A fact lies by load day and event day, so a load is written and replaced on its own."""
    return [spec.partition] if spec.dimension else [LOAD_DAY, spec.partition]


def kept_table(dwd: str, spec: TableSpec, name: str) -> str:
    return f"{dwd}.{spec.target}_{name}"


def set_up(spark: SparkSession, specs: tuple[TableSpec, ...], ods: str, dwd: str, cleaned: bool = True) -> None:
    """Create both layers and every table of a feed that is not there yet."""
    create_layer(spark, ods)
    create_layer(spark, dwd)
    for spec in specs:
        create_table(
            spark, f"{ods}.{spec.source}", f"{spec.columns}, {spec.partition} string", [spec.partition]
        )
        if cleaned:
            frame = cleaned_schema(spark, f"{ods}.{spec.source}", spec)
            create_from_frame(frame, f"{dwd}.{spec.target}", _parts(spec))
            for kept in spec.versions():
                create_from_frame(frame.drop(LOAD_DAY), kept_table(dwd, spec, kept.name), [spec.partition])


def extract_full(source: DataFrame, spec: TableSpec, ods: str, run_day: str, run_ts: str, keyed: bool = False) -> None:
    """Snapshot of a source table, replacing the stored one; ``keyed`` keeps one row per key."""
    rows = _prepared(source, spec, run_day, run_ts)
    table = f"{ods}.{spec.source}"
    if keyed:
        precombine_write(rows, table, list(spec.keys), list(spec.order), [spec.partition])
    else:
        write_partitioned(rows, table, [spec.partition])


def extract_increment(
    source: DataFrame, spec: TableSpec, ods: str, run_day: str, run_ts: str, keyed: bool = False
) -> None:
    """Rows above the stored high-water, appended, or upserted by key. Earlier loads are kept.

    With ``spec.inclusive`` also rows that carry the high-water itself and are not stored yet.
    """
    table = f"{ods}.{spec.source}"
    stored = source.sparkSession.table(table)
    if spec.inclusive:
        changed = {*spec.drops, *(c for c, _ in spec.fills), spec.load_time, spec.partition}
        fresh = incremental_from(source, stored, spec.watermark, [c for c in source.columns if c not in changed])
    else:
        fresh = incremental_pushed(source, stored, spec.watermark)
    rows = _prepared(fresh, spec, run_day, run_ts)
    if keyed:
        keyed_upsert(rows, table, list(spec.keys), list(spec.order), keys_move=spec.keys_move)
    else:
        append_rows(rows, table)


def clean(spark: SparkSession, spec: TableSpec, ods: str, dwd: str, run_day: str, run_ts: str) -> None:
    """One table from the raw to the cleaned layer. Only the run day's partition of the raw table is read.

    A dimension merges this run's rows into the stored ones and replaces the partitions of the keys
    involved. A fact keeps every version it received, by load day and event day: this load's partitions are replaced, those of other
    loads stay untouched. The kept versions (last of each key, last valid one) take the load's rows in as an upsert, so
    measures read them as they are.
    """
    table = f"{dwd}.{spec.target}"
    today = spark.table(f"{ods}.{spec.source}").filter(F.col(spec.partition) == run_day)
    if spec.dimension:
        stamped = audit_stamp(normalise_times(today, list(spec.time_columns)), run_ts)
        for column, other in spec.fills:
            stamped = backfill(stamped, column, other)
        keys, order = list(spec.keys), list(spec.order)
        keyed_upsert(
            stamped, table, keys, order, lambda batch, stored: dim_merge(batch, stored, keys, order), spec.keys_move
        )
        return
    replace_load(cleaned_load(today, spec, run_day, run_ts), table, run_day, spec.partition)
    load = spark.table(table).filter(F.col(LOAD_DAY) == run_day).drop(LOAD_DAY)
    for kept in spec.versions():
        keyed_upsert(
            _candidates(load, kept), kept_table(dwd, spec, kept.name), list(kept.keys), list(kept.order), keys_move=spec.keys_move, settled=True)


def cleaned_load(today: DataFrame, spec: TableSpec, run_day: str, run_ts: str) -> DataFrame:
    """The cleaned rows of one load, with event day and load day."""
    for column, other in spec.fills:
        today = backfill(today, column, other)
    rules = [F.expr(rule) for rule in spec.rules]
    rows = fact_clean(today, spec.event_time, list(spec.time_columns), run_ts, rules, partition_column=spec.partition)
    return stamp_partition(rows, run_day, LOAD_DAY)


def replace_load(rows: DataFrame, table: str, run_day: str, partition: str) -> None:
    """Replace what is stored of one load; event days it no longer holds go last, so a rerun mends a broken run."""
    spark = rows.sparkSession
    stored = lambda: {r[0] for r in spark.table(table).filter(F.col(LOAD_DAY) == run_day).select(partition).distinct().collect()}
    before = stored()
    overwrite_partitions(rows, table)
    if before:
        # Distinct event days of one load: bounded by the calendar.
        gone = before - {r[0] for r in rows.select(partition).distinct().collect()}
        drop_partitions(spark, table, [Row(**{LOAD_DAY: run_day, partition: d}) for d in gone])
        spark.catalog.refreshTable(table)


def _candidates(rows: DataFrame, kept: Kept) -> DataFrame:
    """Rows that may become a kept version. The last version is one of a key; rows without key stay in the fact alone."""
    if kept.only:
        return rows.filter(kept.only)
    return rows.filter(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in kept.keys)))


def rebuild_kept(spark: SparkSession, spec: TableSpec, dwd: str) -> None:
    """The kept versions from all loads: after a load was replaced by one that lacks rows, which an upsert cannot take back."""
    history = spark.table(f"{dwd}.{spec.target}").drop(LOAD_DAY)
    for kept in spec.versions():
        precombine_write(_candidates(history, kept), kept_table(dwd, spec, kept.name), list(kept.keys), list(kept.order), [spec.partition])


def extract_feed(spark, specs, reader, ods: str, run_day: str, run_ts: str, keyed: bool = False) -> None:
    """Extract every table of a feed; ``reader(name)`` returns the source frame."""
    for spec in specs:
        job = extract_increment if spec.watermark else extract_full
        job(reader(spec.source), spec, ods, run_day, run_ts, keyed)


def clean_feed(spark, specs, ods: str, dwd: str, run_day: str, run_ts: str) -> None:
    for spec in specs:
        clean(spark, spec, ods, dwd, run_day, run_ts)
