"""Small helpers the operators share: Arrow batches, staged tables, column names."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakemill.session import fresh_dir, remove_dir

Batches = Iterator[pa.RecordBatch]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: cuts lineage, survives lost executors."""
    path = fresh_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Staged tables of one operator that are deleted once a later staged table no longer needs them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def staged(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(path := fresh_dir(self.spark, label))
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            remove_dir(self.spark, path)
        self.paths.clear()


def text_bytes(text: str | Column = "text") -> Column:
    """The text as UTF-8 bytes, empty for null, so that Python splits it without decoding."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; plain ASCII takes the fast path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def map_arrow(df: DataFrame, schema: str | StructType, each: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """Apply ``each`` to every Arrow batch of ``df``."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield each(batch)

    return df.mapInArrow(run, schema)


def in_parts(batches: Batches, rows: int = 500) -> Batches:
    """Arrow batches cut to ``rows`` rows: what is made of a batch is many times its texts, and stands in memory at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def extended(df: DataFrame, columns: str) -> StructType:
    """The schema of ``df`` with more columns behind it."""
    more = StructType.fromDDL(columns)
    return StructType([*df.schema.fields, *more.fields])


def free_prefix(df: DataFrame, prefix: str) -> str:
    """``prefix``, lengthened until no column of ``df`` starts with it."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = f"_{prefix}"
    return prefix


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns that would clash with a result's names, in any case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def binary_array(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())


def doc_fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a missing id counts as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds
