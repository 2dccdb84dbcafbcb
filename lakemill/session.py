"""Session set-up and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
ADVISED_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
WRITE_BYTES = 16 << 20  # shuffled bytes of one write task; repetitive rows take more than ten times that when they are sorted


def build_session(app: str = "lakemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on.

    Master, memory, hosts and credentials come from spark-submit or ``conf``; the shuffle width is
    left to the cluster default and AQE, which coalesces small partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Joins and groupings aim at this much shuffle data per task; partitioned writes at :data:`WRITE_BYTES`.
        ADVISED_SIZE: "128m",
        # Medians: keep that many groups' digests in memory before a task falls back to sorting its rows.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "2048",
        OVERWRITE_MODE: "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def dynamic_partitions(spark: SparkSession):
    """Overwrite only the partitions present in the written rows.

    ``insertInto`` obeys the session value alone (the per-write option is ignored and would replace
    the whole table), so the value is set around the write and put back after it.
    """
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


@contextmanager
def write_tasks(spark: SparkSession):
    """Writes of ``WRITE_BYTES`` of shuffled data a task at most, whatever the session advises.

    A partitioned write sorts a task's rows in memory, and compressed bytes say little of what they take there; it also
    keeps all cores busy long before each has a large file to write.
    """
    before = spark.conf.get(ADVISED_SIZE)
    advised = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(ADVISED_SIZE, str(min(advised, WRITE_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(ADVISED_SIZE, before)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only where the setting is missing and Spark runs on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="lakemill-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared root; never reused, so a failed run leaves no half table."""
    return f"{shared_root(spark)}/lakemill/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def stages(spark: SparkSession):
    """A function that writes a frame down under the shared root and reads it back; all it wrote goes at the end."""
    paths: list[str] = []

    def staged(df: DataFrame, label: str) -> DataFrame:
        paths.append(path := fresh_dir(spark, label))
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield staged
    finally:
        for path in paths:
            remove_dir(spark, path)


def fresh_database(spark: SparkSession, label: str) -> str:
    """A new database whose tables live under the shared root."""
    from lakemill.sinks.layers import create_layer

    name = f"{label}_{uuid.uuid4().hex[:12]}"
    create_layer(spark, name, f"{fresh_dir(spark, label)}.db")
    return name


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder this job staged, on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
