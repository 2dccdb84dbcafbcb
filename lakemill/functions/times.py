"""Time columns: parsing text, canonical seconds, calendar parts.

Times stay real timestamps from extract to metric; text appears only at the edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Text forms of the source feeds and of the results.
COMPACT_PATTERN = "yyyyMMddHHmmss"
DAY_PATTERN = "yyyyMMdd"
HOUR_PATTERN = "yyyy-MM-dd HH"
NULL_TEXT = "NULL"


def parse_time(text: Column) -> Column:
    """Text to timestamp cut to the second; NULL, ``"NULL"`` and unreadable text become NULL.

    Reads ``yyyy-MM-dd HH:mm:ss`` with or without a fraction, and ``yyyyMMddHHmmss``.
    """
    clean = F.nullif(F.trim(text.cast("string")), F.lit(NULL_TEXT))
    dashed = F.try_to_timestamp(F.when(clean.contains("-"), clean))
    compact = F.try_to_timestamp(F.when(clean.rlike(r"^\d{14}$"), clean), F.lit(COMPACT_PATTERN))
    return F.date_trunc("second", F.coalesce(dashed, compact)).cast("timestamp_ntz")


def time_of(df: DataFrame, name: str) -> Column:
    """A column as a timestamp of whole seconds, parsed if it is text."""
    if df.schema[name].dataType.simpleString() == "string":
        return parse_time(F.col(name))
    return F.date_trunc("second", F.col(name)).cast("timestamp_ntz")


def normalise_times(df: DataFrame, columns: list[str], on_bad: str = "null") -> DataFrame:
    """Turn each listed column into a timestamp of whole seconds.

    ``on_bad="raise"`` fails the job on text that is neither empty nor readable.
    """
    if on_bad not in ("null", "raise"):
        raise ValueError(f"on_bad must be 'null' or 'raise', not {on_bad!r}")
    parsed = {}
    for name in columns:
        time = time_of(df, name)
        if on_bad == "raise":
            text = F.trim(F.col(name).cast("string"))
            bad = time.isNull() & text.isNotNull() & (text != NULL_TEXT)
            message = F.concat(F.lit(f"unreadable time in {name}: "), text)
            time = F.when(bad, F.raise_error(message).cast("timestamp_ntz")).otherwise(time)
        parsed[name] = time
    return df.withColumns(parsed)


def partition_day(time: Column) -> Column:
    """``yyyyMMdd`` text of an event time, used as partition value."""
    return F.date_format(time, DAY_PATTERN)


def default_run_day() -> Column:
    """Yesterday as ``yyyyMMdd``; jobs take the run day as an argument and use this only by choice."""
    return F.date_format(F.date_sub(F.current_date(), 1), DAY_PATTERN)


def run_time(run_ts: str) -> Column:
    """The job's run time, cut to the second: one literal for all rows, so a retry stamps the same."""
    return F.date_trunc("second", F.lit(run_ts).cast("timestamp")).cast("timestamp_ntz")


def calendar(time: Column, *parts: str) -> list[Column]:
    """``year``, ``month``, ``day`` columns of a time, in the order asked for."""
    known = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return [known[p](time).alias(p) for p in parts]


def in_year(df: DataFrame, column: str, year: int) -> Column:
    """Times of one year as two bounds of the column's own type, which reach the scan."""
    kind = df.schema[column].dataType
    at = lambda y: F.lit(f"{y}-01-01 00:00:00").cast(kind)
    return (F.col(column) >= at(year)) & (F.col(column) < at(year + 1))
