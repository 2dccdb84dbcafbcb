"""Catalog and file tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Fixed value: prefix of the bookkeeping columns a keyed storage format adds to its tables.
META_PREFIX = "_hoodie_"


def read_cols(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """Some columns of a catalog table; only these reach the scan."""
    return spark.table(table).select(*columns)


def read_path(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    """A table by location, bookkeeping columns included."""
    return spark.read.format(source).load(path)


def hide_meta(df: DataFrame, prefix: str = META_PREFIX) -> DataFrame:
    """Drop bookkeeping columns by name; a frame without them passes unchanged."""
    return df.select(*[c for c in df.columns if not c.startswith(prefix)])


def read_keyed(spark: SparkSession, table: str) -> DataFrame:
    """A keyed catalog table without bookkeeping columns."""
    return hide_meta(spark.table(table))


def from_rows(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """A small frame from rows at hand, with an explicit schema."""
    return spark.createDataFrame(rows, schema)
