"""Record keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SEPARATOR = "\x1f"
_NULL_MARK = "\x00"


def record_key(*columns: Column) -> Column:
    """Stable key from the grouping columns: a retried task makes the same key again."""
    parts = [F.coalesce(c.cast("string"), F.lit(_NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(_SEPARATOR, *parts), 256)
