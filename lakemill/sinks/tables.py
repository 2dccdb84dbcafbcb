"""Partitioned parquet tables: create, append, replace partitions.

Rows are rebalanced by partition value before a write. Unlike a plain repartition this lets AQE
split a partition value that holds a large share of the rows over several tasks and files, and join
small ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakemill.operators.shape import conform
from lakemill.session import dynamic_partitions, fresh_dir, remove_dir, write_tasks
from lakemill.sinks import ledger
from lakemill.sinks.layers import (
    create_from_frame, create_table, drop_partitions, partition_columns, quoted, repair_partitions,
)


def rebalanced(df: DataFrame, partitions: list[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(p) for p in partitions]) if partitions else df.hint("rebalance")


def write_partitioned(df: DataFrame, table: str, partitions: list[str], mode: str = "overwrite") -> None:
    """Create or replace (``overwrite``) or extend (``append``) a partitioned table by column name."""
    spark = df.sparkSession
    ledger.forget(spark, table)
    if mode == "overwrite" and spark.catalog.tableExists(table):
        _replace(df, table, partitions)
        return
    with write_tasks(spark):
        rebalanced(df, partitions).write.mode(mode).format("parquet").partitionBy(*partitions).saveAsTable(table)


def _replace(df: DataFrame, table: str, partitions: list[str]) -> None:
    """Replace a table whose rows must survive a failed load.

    Spark's own overwrite deletes first. Here the new rows are written in full to a folder of their own. Those of a
    partitioned table of the same shape then replace the partitions they cover when a second write commits,
    and only after that the partitions they do not cover go. In all other cases the folder becomes the
    table's next version (:func:`_switch`) and there is no second write. Whatever fails, the folder does not stay behind.
    """
    spark = df.sparkSession
    stored = spark.table(table)
    same = set(stored.dtypes) == set(df.dtypes) and partition_columns(spark, table) == list(partitions)
    stage = fresh_dir(spark, "version")
    keep = False
    try:
        # Columns in the table's order, which a version of the same shape goes by.
        rows = conform(df, stored) if same else df
        with write_tasks(spark):
            rebalanced(rows, partitions).write.partitionBy(*partitions).parquet(stage)
        if same and partitions:
            staged = spark.read.schema(rows.schema).parquet(stage)
            before = stored.select(*partitions).distinct().collect()
            covered = set(staged.select(*partitions).distinct().collect())
            replace_covered(staged, table)
            drop_partitions(spark, table, [p for p in before if p not in covered])
        else:
            keep = True
            _switch(spark, table, rows.schema, partitions, stage, same)
    finally:
        if not keep or not _is_at(spark, table, stage):
            remove_dir(spark, stage)


def _switch(spark: SparkSession, table: str, schema: StructType, partitions: list[str], folder: str, same: bool) -> None:
    """Let a complete folder be the table: a change of the catalog alone, so the old rows are readable until the new ones are.

    The same shape needs one ``SET LOCATION``. Another shape needs a table of its own, which takes the name over from the old one;
    if the driver dies between the two renames, the old rows are under ``<table>__old`` and the new ones under ``<table>__new``.
    The folder before is removed once nothing points to it.
    """
    before = location(spark, table)
    if same:
        spark.sql(f"ALTER TABLE {quoted(table)} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        remove_dir(spark, before)
        return
    new, old = f"{table}__new", f"{table}__old"
    for leftover in (new, old):
        spark.sql(f"DROP TABLE IF EXISTS {quoted(leftover)}")
    create_table(spark, new, schema, partitions, location=folder)
    if partitions:
        repair_partitions(spark, new)
    spark.sql(f"ALTER TABLE {quoted(table)} RENAME TO {quoted(old)}")
    spark.sql(f"ALTER TABLE {quoted(new)} RENAME TO {quoted(table)}")
    spark.catalog.refreshTable(table)
    gone = location(spark, old)
    spark.sql(f"DROP TABLE IF EXISTS {quoted(old)}")
    remove_dir(spark, gone)


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {quoted(table)}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location")


def _is_at(spark: SparkSession, table: str, folder: str) -> bool:
    return spark.catalog.tableExists(table) and location(spark, table).rstrip("/").endswith(folder.rstrip("/").split("/")[-1])


def append_rows(df: DataFrame, table: str) -> None:
    """Append by position after projecting to the table's columns."""
    spark = df.sparkSession
    ledger.forget(spark, table)
    rows = conform(df, spark.table(table))
    with write_tasks(spark):
        rebalanced(rows, partition_columns(spark, table)).write.mode("append").insertInto(table)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions that occur in ``df``; all others stay as they are."""
    ledger.forget(df.sparkSession, table)
    replace_covered(df, table)


def replace_covered(df: DataFrame, table: str) -> None:
    """:func:`overwrite_partitions` for writers that keep the table's ledger themselves."""
    spark = df.sparkSession
    rows = conform(df, spark.table(table))
    with dynamic_partitions(spark), write_tasks(spark):
        rebalanced(rows, partition_columns(spark, table)).write.mode("overwrite").insertInto(table)


def overwrite_partitions_sql(view: str, table: str, spark) -> None:
    """The same replacement in SQL, from a temporary view that holds the table's columns by name."""
    ledger.forget(spark, table)
    parts = partition_columns(spark, table)
    columns = ", ".join(f"`{c}`" for c in spark.table(table).columns)
    with dynamic_partitions(spark):
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({', '.join(parts)}) SELECT {columns} FROM {view}"
        )


def publish(df: DataFrame, table: str) -> None:
    """Store a result: by calendar partitions where it has calendar columns, else as a whole.

    A partitioned result replaces the periods it covers and keeps the others.
    """
    parts = [c for c in ("year", "month", "day") if c in df.columns]
    if not parts:
        write_partitioned(df, table, [])
        return
    create_from_frame(df, table, parts)
    overwrite_partitions(df, table)


def write_folder(df: DataFrame, path: str, partitions: list[str], mode: str = "append") -> None:
    """Partitioned files without a catalog entry; ``repair_partitions`` makes a table see them."""
    with write_tasks(df.sparkSession):
        rebalanced(df, partitions).write.mode(mode).partitionBy(*partitions).parquet(path)
