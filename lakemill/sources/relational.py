"""Relational sources over JDBC: table scans split over tasks, and pushed-down queries."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    """Where a relational store is. User and password come from options or the environment."""

    url: str
    driver: str | None = None
    user_variable: str = "LAKEMILL_JDBC_USER"
    password_variable: str = "LAKEMILL_JDBC_PASSWORD"
    extra: dict[str, str] = field(default_factory=dict)

    def options(self, **more: str) -> dict[str, str]:
        secrets = {"user": os.environ.get(self.user_variable), "password": os.environ.get(self.password_variable)}
        base = {"url": self.url, "driver": self.driver, **secrets, **self.extra, **more}
        return {k: v for k, v in base.items() if v is not None}


@dataclass(frozen=True)
class Split:
    """A column that cuts a table into ``parts`` ranges of about as many rows each, read by as many tasks.

    The cuts are quantiles the store computes itself (:meth:`quantile_query`), so gaps and crowds in the column do not
    leave some tasks empty and others with nearly all rows, as ranges of equal width would.
    """

    column: str
    parts: int

    def quantile_query(self, table: str) -> str:
        """The least value of each of ``parts`` groups of rows in the column's order, by a window the store evaluates."""
        return (
            f"SELECT part, MIN({self.column}) AS low FROM (SELECT {self.column}, NTILE({self.parts}) OVER (ORDER BY {self.column}) AS part "
            f"FROM {table} WHERE {self.column} IS NOT NULL) ranked GROUP BY part"
        )

    def predicates(self, lows: list) -> list[str]:
        """One condition per task. Every row meets exactly one, whatever has come to the table since the cuts were made.

        Groups that begin with the same value are one, so a value with very many rows stays whole.
        """
        cuts = sorted(set(lows))[1:]
        if not cuts:
            return ["1 = 1"]
        texts = [_sql_literal(c) for c in cuts]
        first = f"{self.column} < {texts[0]} OR {self.column} IS NULL"
        between = [f"{self.column} >= {a} AND {self.column} < {b}" for a, b in zip(texts, texts[1:])]
        return [first, *between, f"{self.column} >= {texts[-1]}"]


def _sql_literal(value) -> str:
    if isinstance(value, bool) or value is None:
        raise TypeError(f"cannot split by {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def read_table(
    spark: SparkSession, conn: Connection, table: str, split: Split | None = None, fetch_size: int = 10000
) -> DataFrame:
    """Scan a table; filters and column selection are evaluated by the store, ``split`` reads it in ranges at once."""
    if split is None:
        return spark.read.format("jdbc").options(**conn.options(dbtable=table, fetchsize=str(fetch_size))).load()
    lows = [r.low for r in read_query(spark, conn, split.quantile_query(table)).collect()]
    properties = conn.options(fetchsize=str(fetch_size))
    return spark.read.jdbc(properties.pop("url"), table, predicates=split.predicates(lows), properties=properties)


def read_query(spark: SparkSession, conn: Connection, query: str, alias: str = "q") -> DataFrame:
    """Run a query, such as a top-k read-back, inside the store."""
    return spark.read.format("jdbc").options(**conn.options(dbtable=f"({query}) {alias}")).load()
