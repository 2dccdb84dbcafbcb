"""Where each key of a keyed table is stored: a bucketed table beside it, so that an upsert need not look through the table.

``<table>__keys`` is bucketed and sorted by the record key and holds, per key, the partitions it was put into. A batch is
dealt into the same buckets and joined there: the ledger is not shuffled and the table not read. An upsert appends only
what changed, twice: a *claim* before it touches the table and a *confirmation* after. A key is looked for in the partition
of its last confirmation and in all claimed since, so an upsert that died half-way hides nothing; a partition too
many costs time and changes no result.

The ledger is built from the table when it is missing, and built anew when its files have become many. Every other write to
the table drops it (:mod:`lakemill.sinks.tables`). One writer at a time, as for the table itself.
"""

from __future__ import annotations

import math
import time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

SUFFIX = "__keys"
ROWS_PER_BUCKET = 4_000_000
LEAST_BUCKETS = 8
FILES_PER_BUCKET = 32  # appended files a bucket may have before the ledger is built anew


def name_of(table: str) -> str:
    return f"{table}{SUFFIX}"


def _places(parts: list[str]) -> list[str]:
    return [f"_place{i}" for i in range(len(parts))]


def forget(spark: SparkSession, table: str) -> None:
    """Drop the ledger of a table that is written in another way."""
    if spark.catalog.tableExists(name_of(table)):
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(name_of(table))}")


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _buckets(spark: SparkSession, table: str) -> int:
    """As many as the table was created with."""
    for row in spark.sql(f"DESCRIBE EXTENDED {_quoted(name_of(table))}").collect():
        if row.col_name == "Num Buckets":
            return int(row.data_type)
    raise ValueError(f"{name_of(table)} is not bucketed")


def _write(rows: DataFrame, table: str, keys: list[str], buckets: int, once: bool = False) -> None:
    """Rows dealt as the buckets are, so that each bucket gets one file; with ``once`` repeats go where they were dealt to."""
    dealt = rows.repartition(buckets, *keys)
    writer = (dealt.distinct() if once else dealt).write.mode("append").format("parquet")
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name_of(table))


def _entries(rows: DataFrame, keys: list[str], parts: list[str], load: int, confirmed: bool) -> DataFrame:
    return rows.select(*keys, *[F.col(p).alias(n) for p, n in zip(parts, _places(parts))],
                       F.lit(load).cast("bigint").alias("_load"), F.lit(confirmed).alias("_confirmed"))


def build(spark: SparkSession, table: str, keys: list[str], parts: list[str]) -> None:
    """The ledger from the table itself: one scan of its keys and one exchange."""
    forget(spark, table)
    stored = spark.table(table).select(*keys, *[p for p in parts if p not in keys])
    buckets = max(LEAST_BUCKETS, math.ceil(spark.table(table).count() / ROWS_PER_BUCKET))
    _write(_entries(stored, keys, parts, 0, True), table, keys, buckets, once=True)


def ensure(spark: SparkSession, table: str, keys: list[str], parts: list[str]) -> None:
    if not spark.catalog.tableExists(name_of(table)):
        build(spark, table, keys, parts)
        return
    spark.catalog.refreshTable(name_of(table))
    held = spark.table(name_of(table))
    if len(held.inputFiles()) > FILES_PER_BUCKET * _buckets(spark, table):
        build(spark, table, keys, parts)


def located(spark: SparkSession, table: str, batch: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """(keys, parts): where the batch's keys may be stored. ``batch`` holds the keys at least."""
    held = spark.table(name_of(table))
    wanted = batch.select(*keys).distinct()
    # Equality of plain columns keeps to the buckets; keys with a NULL in them are few and found apart.
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    entries = held.join(wanted.filter(whole), keys, "left_semi")
    odd = wanted.filter(~whole)
    if not odd.isEmpty():
        entries = entries.unionByName(same_rows(held.filter(~whole), odd, keys, "left_semi"))
    last = F.max(F.when(F.col("_confirmed"), F.col("_load"))).over(Window.partitionBy(*keys))
    open_ = entries.withColumn("_last", last).filter(
        F.col("_last").isNull() | (F.col("_load") > F.col("_last")) | (F.col("_confirmed") & (F.col("_load") == F.col("_last"))))
    return open_.select(*[k for k in keys if k not in parts], *[F.col(n).alias(p) for n, p in zip(_places(parts), parts)]).distinct()


def same_rows(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Semi or anti join on columns whose NULLs are equal."""
    named = right.select(*[F.col(c).alias(f"_same{i}") for i, c in enumerate(columns)])
    match: Column = reduce(lambda a, b: a & b, (left[c].eqNullSafe(named[f"_same{i}"]) for i, c in enumerate(columns)))
    return left.join(named, match, how)


def record(spark: SparkSession, table: str, moved: DataFrame, keys: list[str], parts: list[str], load: int, confirmed: bool) -> None:
    """Append a load's claims, or its confirmations; ``moved`` holds the keys that came to a partition they were not in."""
    _write(_entries(moved, keys, parts, load, confirmed), table, keys, _buckets(spark, table))
    spark.catalog.refreshTable(name_of(table))


def next_load() -> int:
    return time.time_ns()
