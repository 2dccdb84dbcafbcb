"""Layer set-up: databases, tables, schema copies, partition discovery, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def create_layer(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if it is missing; existing data is never dropped."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{place}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType | str,
    partitions: list[str] = (),
    source: str = "parquet",
    location: str | None = None,
) -> None:
    """Create a partitioned table from declared columns, given as a ``StructType`` or as DDL text."""
    columns = schema if isinstance(schema, str) else ", ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields
    )
    split = f" PARTITIONED BY ({', '.join(quoted(p) for p in partitions)})" if partitions else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}) USING {source}{split}{place}")


def create_like(spark: SparkSession, table: str, model: str, added: str | None = None) -> None:
    """Copy a table's definition, optionally adding columns."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(table)} LIKE {quoted(model)}")
    if added:
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({added})")


def create_from_frame(df: DataFrame, table: str, partitions: list[str] = ()) -> None:
    """An empty table with a frame's schema."""
    create_table(df.sparkSession, table, df.schema, partitions)


def repair_partitions(spark: SparkSession, table: str) -> None:
    """Register partition folders written beside the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def has_partitions(spark: SparkSession, table: str) -> bool:
    """Whether the catalog lists any partition of the table: without one it has no rows."""
    return not spark.sql(f"SHOW PARTITIONS {quoted(table)}").isEmpty()


def drop_partitions(spark: SparkSession, table: str, values: list[Row]) -> None:
    """Remove partitions given by rows of the partition columns."""
    if values:
        specs = ", ".join(f"PARTITION ({_spec(v)})" for v in values)
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS {specs}")


def _spec(row: Row) -> str:
    return ", ".join(f"{quoted(k)} = {_literal(v)}" for k, v in row.asDict().items())


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, (int, float)):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def preview(spark: SparkSession, tables: list[str], n: int = 20) -> dict[str, DataFrame]:
    """The first ``n`` rows of each table, unevaluated."""
    return {t: spark.table(t).limit(n) for t in tables}


def row_counts(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Rows per table as one frame."""
    counts = [spark.table(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n")) for t in tables]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
