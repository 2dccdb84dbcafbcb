"""Column-level operators: stamps, conforming to a target, event partitions, back-fills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemill.functions.times import normalise_times, partition_day, run_time

STAMP_COLUMNS = ("dwd_insert_user", "dwd_insert_time", "dwd_modify_user", "dwd_modify_time")


def audit_stamp(df: DataFrame, run_ts: str, user: str = "user1") -> DataFrame:
    """Add insert/modify user and time; every row of the run carries the same second."""
    who, when = F.lit(user), run_time(run_ts)
    return df.withColumns(dict(zip(STAMP_COLUMNS, (who, when, who, when))))


def stamp_partition(df: DataFrame, run_day: str, column: str = "etl_date") -> DataFrame:
    """Static partition value of one load."""
    return df.withColumn(column, F.lit(run_day))


def stamp_load_time(df: DataFrame, run_ts: str, column: str = "create_time") -> DataFrame:
    """Load time for sources that carry no time of their own."""
    return df.withColumn(column, run_time(run_ts))


def backfill(df: DataFrame, column: str, source: str) -> DataFrame:
    """Fill NULLs of one column from another."""
    return df.withColumn(column, F.coalesce(F.col(column), F.col(source)))


def event_partition(df: DataFrame, time_column: str, column: str = "etl_date") -> DataFrame:
    """Partition day taken from the row's own time."""
    return df.withColumn(column, partition_day(F.col(time_column)))


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema; Catalyst folds the filter and reads nothing."""
    return df.filter(F.lit(False))


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def conform(df: DataFrame, target: DataFrame | list[str], allow_extra: bool = True) -> DataFrame:
    """Project to the target's columns in the target's order, ready for a by-position insert.

    Missing columns are an error; columns the target lacks are dropped unless ``allow_extra`` is
    False. Metadata columns are never guessed by position.
    """
    wanted = target if isinstance(target, list) else target.columns
    missing = [c for c in wanted if c not in df.columns]
    extra = [c for c in df.columns if c not in wanted]
    if missing or (extra and not allow_extra):
        raise ValueError(f"cannot conform: missing {missing}, extra {extra}")
    return df.select(*wanted)


def union_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union on column names (duplicates kept), refusing a silent text-to-time cast."""
    types = dict(second.dtypes)
    for name, kind in first.dtypes:
        other = types.get(name)
        if other and ("string" in (kind, other)) and ("timestamp" in kind or "timestamp" in other):
            raise TypeError(f"column {name} is {kind} on one side and {other} on the other")
    return first.unionByName(second)


def fact_clean(
    df: DataFrame,
    event_time: str,
    time_columns: list[str],
    run_ts: str,
    rules: list[Column] | None = None,
    user: str = "user1",
    partition_column: str = "etl_date",
) -> DataFrame:
    """Clean a fact: parse times, keep rows that pass every rule, stamp, partition by event day.

    ``rules`` are boolean columns such as ``F.length("city") <= 8``; they come first so that they
    reach the scan.
    """
    for rule in rules or []:
        df = df.filter(rule)
    df = normalise_times(df, sorted({event_time, *time_columns}))
    return audit_stamp(event_partition(df, event_time, partition_column), run_ts, user)
