"""One row per key, and first/last times per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import MapType, VariantType


def tie_columns(df: DataFrame, used: list[str]) -> list[str]:
    """All other columns that can be ordered, by name: ties end the same way on every run."""
    skip = set(used)
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return [f.name for f in fields if f.name not in skip and not isinstance(f.dataType, (MapType, VariantType))]


def dedupe_latest(df: DataFrame, keys: list[str], order: list[str], ties: list[str] | None = None) -> DataFrame:
    """Keep the row with the greatest ``order`` values per key.

    Spark places a group limit below the exchange for ``row_number = 1``, so each map task ships at
    most one row per key and a hot key costs no more than a cold one.
    """
    return _first_row(df, keys, order, ties, latest=True)


def dedupe_earliest(df: DataFrame, keys: list[str], order: list[str], ties: list[str] | None = None) -> DataFrame:
    """Keep the row with the smallest ``order`` values per key; NULL order values come last."""
    return _first_row(df, keys, order, ties, latest=False)


def _first_row(df, keys, order, ties, latest):
    ties = tie_columns(df, keys + order) if ties is None else ties
    if latest:
        ordering = [F.col(c).desc_nulls_last() for c in order + ties]
    else:
        ordering = [F.col(c).asc_nulls_last() for c in order + ties]
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def key_lifecycle(df: DataFrame, keys: list[str], inserted: str, modified: str) -> DataFrame:
    """First insert time and last modify time per key."""
    return df.groupBy(*keys).agg(F.max(modified).alias(modified), F.min(inserted).alias(inserted))
