"""Running a stream until its input is used up, and file streams as incremental extract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakemill.operators.shape import stamp_partition


def file_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*", source: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream; the checkpoint remembers which were read."""
    reader = spark.readStream.format(source).schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def drain_to_path(stream: DataFrame, path: str, checkpoint: str, partitions: list[str] = ()) -> None:
    """Process everything available, then stop; parquet files become visible per finished batch."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def drain_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand each micro-batch to ``handle(rows, batch_id)``; a batch may come twice after a failure."""
    (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def extract_stream(stream: DataFrame, path: str, checkpoint: str, run_day: str, partition: str = "etl_date") -> None:
    """Incremental extract: files not seen before are appended under the run day's partition."""
    drain_to_path(stamp_partition(stream, run_day, partition), path, checkpoint, [partition])
