"""Short ways to build frames and read them back."""

from __future__ import annotations

import datetime as dt


def ts(text: str | None):
    return None if text is None else dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def day(text: str, hour: int = 0):
    return dt.datetime.strptime(text, "%Y-%m-%d") + dt.timedelta(hours=hour)


def rows(df, *order):
    """Rows as tuples, sorted."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
