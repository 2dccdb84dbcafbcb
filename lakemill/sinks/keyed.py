"""Keyed tables: one row per record key, the greatest precombine value wins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.types import StructType

from lakemill.operators.dedupe import dedupe_latest
from lakemill.operators.merge import latest_per_key
from lakemill.operators.shape import conform, empty_like
from lakemill.session import fresh_dir, remove_dir
from lakemill.sinks import ledger
from lakemill.sinks.layers import drop_partitions, has_partitions, partition_columns
from lakemill.sinks.tables import replace_covered, write_partitioned

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def precombine_write(
    df: DataFrame, table: str, keys: list[str], precombine: list[str], partitions: list[str]
) -> None:
    """Replace a keyed table's content by one row per key of ``df``."""
    write_partitioned(dedupe_latest(df, keys, precombine), table, partitions)


def keyed_upsert(
    df: DataFrame,
    table: str,
    keys: list[str],
    precombine: list[str],
    merge: Merge | None = None,
    keys_move: bool = True,
    settled: bool = False,
) -> None:
    """Insert new keys and update known ones, rewriting only the partitions involved.

    ``merge(batch, stored)`` combines the batch with the stored rows of those partitions; by default
    the latest row per key stays. ``keys_move=False`` promises that a key never changes partition and
    saves looking up where the batch's keys are stored. ``settled`` promises that the batch reads alike
    however often it is read, as stored rows nobody writes to do, and saves writing it down.

    Involved are the partitions of the batch and those where its keys are stored now, which the table's key ledger
    tells (:mod:`lakemill.sinks.ledger`), so a key that moves leaves its old partition. Merged rows are staged in full before any
    partition is replaced; partitions left without rows are dropped last. Running the same batch again, also after
    a failure half-way, gives the same table. A table without partitions holds no key and no row to merge with: the batch
    is merged straight into it, and the ledger is left to the next upsert, which builds it from the table.
    """
    stage = fresh_dir(df.sparkSession, "stage")
    try:
        _upsert(df, table, keys, precombine, merge, keys_move, settled, stage)
    finally:
        remove_dir(df.sparkSession, stage)


def _upsert(
    df: DataFrame, table: str, keys: list[str], precombine: list[str], merge: Merge | None, keys_move: bool, settled: bool, stage: str
) -> None:
    spark = df.sparkSession
    # Another session may have rewritten the table since this one listed its files.
    spark.catalog.refreshTable(table)
    stored = spark.table(table)
    parts = partition_columns(spark, table)
    if not parts:
        raise ValueError(f"{table} is not partitioned")
    # The batch is read once and written down: a source that changes meanwhile must not hold other
    # rows for the merge than for the list of partitions. The merge reduces it to one row per key.
    rows = conform(df, stored)
    first = not has_partitions(spark, table)
    batch = rows if settled or (first and not merge) else _down(rows, f"{stage}/batch")
    merging = merge or (lambda new, old: latest_per_key(new, old, keys, precombine))
    if first:
        ledger.forget(spark, table)
        replace_covered(merging(batch, empty_like(stored)), table)
        return
    # Distinct partition values only: as many as the catalog lists, not as many as there are rows.
    touched = set(batch.select(*parts).distinct().collect())
    if not touched:
        return
    if keys_move:
        ledger.ensure(spark, table, keys, parts)
        known = _down(ledger.located(spark, table, batch, keys, parts), f"{stage}/known")
        touched |= set(known.select(*parts).distinct().collect())
    affected = _in_partitions(stored, parts, touched)
    staged = _down(merging(batch, affected), f"{stage}/merged")
    load = ledger.next_load()
    if keys_move:
        where = list(dict.fromkeys([*keys, *parts]))
        placed = ledger.same_rows(staged.select(*where), batch.select(*keys).distinct(), keys, "left_semi")
        moved = _down(ledger.same_rows(placed, known, where, "left_anti"), f"{stage}/moved")
        some = not moved.isEmpty()
        if some:
            ledger.record(spark, table, moved, keys, parts, load, confirmed=False)

    kept = {tuple(r) for r in staged.select(*parts).distinct().collect()}
    replace_covered(staged, table)
    drop_partitions(spark, table, [r for r in touched if tuple(r) not in kept])
    if keys_move and some:
        ledger.record(spark, table, moved, keys, parts, load, confirmed=True)


def _down(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _in_partitions(stored: DataFrame, parts: list[str], values: set[Row]) -> DataFrame:
    """Rows of the given partitions: a literal list per column prunes the scan, an exact join picks the combinations."""
    spark = stored.sparkSession
    schema = StructType([stored.schema[p] for p in parts])
    for i, p in enumerate(parts):
        listed = [v[i] for v in values if v[i] is not None]
        in_list = F.col(p).isin(listed)
        stored = stored.filter(in_list | F.col(p).isNull() if len(listed) < len(values) and any(v[i] is None for v in values) else in_list)
    if len(parts) == 1:
        return stored
    wanted = spark.createDataFrame([tuple(v) for v in values], schema).toDF(*[f"_p{i}" for i in range(len(parts))])
    match = reduce(
        lambda a, b: a & b, [stored[p].eqNullSafe(wanted[f"_p{i}"]) for i, p in enumerate(parts)]
    )
    return stored.join(F.broadcast(wanted), match, "left_semi")
