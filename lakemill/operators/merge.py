"""Merging new rows into what a table already holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakemill.operators.dedupe import dedupe_latest, tie_columns
from lakemill.operators.shape import union_by_name


def dim_merge(
    incoming: DataFrame,
    current: DataFrame,
    keys: list[str],
    order: list[str],
    inserted: str = "dwd_insert_time",
    modified: str = "dwd_modify_time",
) -> DataFrame:
    """Merge a dimension: latest row per key, first insert time, last modify time.

    The latest row and both times are aggregates of one grouping. They are combined before the
    exchange, so a key with many versions shrinks to one row per map task, and there is one exchange
    where a window plus aggregate plus join would need three. Equal order values fall to the later
    modify time, then to the incoming side, then to the remaining columns by name.
    """
    columns = incoming.columns
    rows = union_by_name(
        incoming.withColumn("_incoming", F.lit(1)), current.withColumn("_incoming", F.lit(0))
    )
    payload = [c for c in columns if c not in keys]
    head = [*order, modified]
    rest = tie_columns(incoming, keys + head)
    best = F.max_by(F.struct(*payload), F.struct(*head, "_incoming", *rest))
    merged = rows.groupBy(*keys).agg(
        best.alias("_row"), F.max(modified).alias("_modified"), F.min(inserted).alias("_inserted")
    )
    stamps = {modified: F.col("_modified"), inserted: F.col("_inserted")}
    return merged.select(
        *[F.col(c) if c in keys else stamps.get(c, F.col(f"_row.{c}")).alias(c) for c in columns]
    )


def latest_per_key(incoming: DataFrame, current: DataFrame, keys: list[str], precombine: list[str]) -> DataFrame:
    """Union of batch and stored rows reduced to one row per key; the batch wins equal precombine values."""
    rows = union_by_name(
        incoming.withColumn("_incoming", F.lit(1)), current.withColumn("_incoming", F.lit(0))
    )
    ties = ["_incoming", *tie_columns(incoming, keys + precombine)]
    return dedupe_latest(rows, keys, precombine, ties).drop("_incoming")
