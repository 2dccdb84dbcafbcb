"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _kind(value) -> str:
    return type(value).__name__.replace("int64", "int").replace("int32", "int").replace("float64", "float")


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    clean = df.astype(object).where(df.notna(), None)
    return sorted((tuple(r) for r in clean.itertuples(index=False)), key=repr)


def differences(spark_df, sql: str, con) -> list[str]:
    """Empty when names, row counts, value types and values agree exactly."""
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return [f"{len(a)} rows != {len(b)}"]
    out = [f"{x} != {y}" for x, y in zip(a, b) if x != y][:3]
    if a and not out:
        kinds = [tuple(_kind(v) for v in r) for r in (a[0], b[0])]
        if kinds[0] != kinds[1]:
            out.append(f"types {kinds[0]} != {kinds[1]}")
    return out


def main() -> None:
    import __spark_entry__ as entry
    from lakemill.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("oracle-check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = duck(sf_dir), entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = []
    for name in names:
        start = time.time()
        try:
            problems = differences(queries[name](spark, sf_dir), sql[name], con) if name in sql else ["no SQL"]
        except Exception as error:  # noqa: BLE001 - report every query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'ok  ' if not problems else 'BAD '} {name} {time.time() - start:.1f}s", *problems, sep="\n     ", flush=True)
        bad += [name] if problems else []
    print(len(names) - len(bad), "of", len(names), "agree; bad:", bad)
    print("SQL without query:", sorted(set(sql) - set(queries)))


if __name__ == "__main__":
    main()
