"""Dimension merge and keyed upsert per micro-batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.operators.merge import dim_merge
from lakemill.operators.shape import audit_stamp
from lakemill.sinks.keyed import Merge, keyed_upsert
from lakemill.streaming.ingest import drain_batches

Clock = Callable[[], str]


def upsert_stream(
    stream: DataFrame, table: str, keys: list[str], precombine: list[str], checkpoint: str, merge: Merge | None = None,
    keys_move: bool = True,
) -> None:
    """Upsert every micro-batch into a keyed table; ``merge`` as in :func:`~lakemill.sinks.keyed.keyed_upsert`.

    The upsert gives the same table when a batch is delivered again, so a restart after a failed
    batch needs no extra record of batch ids.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        keyed_upsert(rows, table, keys, precombine, merge, keys_move)

    drain_batches(stream, handle, checkpoint)
    # Batches run in a session of their own; the caller's session still knows the old files.
    stream.sparkSession.catalog.refreshTable(table)


def now() -> str:
    return dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")


def batch_time(spark: SparkSession, ledger: str, batch_id: int, clock: Clock = now) -> str:
    """The time a micro-batch was first taken up, written down before anything else is done with it.

    One folder per batch id, so a batch delivered again after a failure finds its own time, whoever runs it then.
    """
    path = f"{ledger}/batch_id={batch_id}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        spark.range(1).select(F.lit(clock()).alias("run_ts")).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("run_ts string").parquet(path).first()["run_ts"]


def dim_merge_stream(
    stream: DataFrame, table: str, keys: list[str], order: list[str], checkpoint: str, clock: Clock = now, keys_move: bool = True,
) -> None:
    """The dimension merge of every micro-batch: latest row per key, first insert time, last modify time.

    A batch is stamped with the time it was first taken up, kept in ``<checkpoint>-batches``. If it is delivered again, before or
    after its merge was written, the stamps are the same, and so is the table: the merge takes the least insert and the
    greatest modify time. The table must have the stream's columns and the audit stamps.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        run_ts = batch_time(rows.sparkSession, f"{checkpoint}-batches", batch_id, clock)
        stamped = audit_stamp(rows, run_ts)
        keyed_upsert(stamped, table, keys, order, lambda batch, stored: dim_merge(batch, stored, keys, order), keys_move)

    drain_batches(stream, handle, checkpoint)
    stream.sparkSession.catalog.refreshTable(table)
