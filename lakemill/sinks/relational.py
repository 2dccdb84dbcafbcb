"""Relational sinks over JDBC. Errors fail the job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakemill.sources.relational import Connection


def write_table(df: DataFrame, conn: Connection, table: str, mode: str = "append", tasks: int | None = None) -> None:
    """Write in the given save mode; ``tasks`` bounds how many connections write at once."""
    rows = df.coalesce(tasks) if tasks else df
    rows.write.format("jdbc").options(**conn.options(dbtable=table)).mode(mode).save()


def truncate_load(df: DataFrame, conn: Connection, table: str, tasks: int | None = None) -> None:
    """Replace a table's rows and keep its definition, keys and grants.

    The truncate belongs to Spark's own overwrite, after the frame has been analysed and its
    schema checked against the table.
    """
    rows = df.coalesce(tasks) if tasks else df
    options = conn.options(dbtable=table, truncate="true")
    rows.write.format("jdbc").options(**options).mode("overwrite").save()
