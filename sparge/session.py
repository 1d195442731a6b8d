"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Stored input per post-shuffle partition, and what AQE may join to one task. Shuffled rows are small and compressed:
# joined to their dimensions and hashed for an aggregate, they take some thirty times as much memory.
TARGET_PARTITION_BYTES = 32 * 1024 * 1024
TASK_SHUFFLE_BYTES = 16 * 1024 * 1024
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings every operator here relies on.

    Months, days and `timestamp_seconds` depend on the session zone, so it is
    fixed to UTC. With `input_bytes`, the number of shuffle partitions AQE
    starts from is raised to fit the input; AQE coalesces what turns out small.
    It is never lowered below what the session already has. Nor is the size raised
    up to which AQE coalesces, which bounds the memory of a task.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Of a key that occurs twice in a JSON object, the last one counts.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # The default type has no statistics that a filter on a timestamp could use.
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    if _bytes(spark, spark.conf.get(ADVISORY)) > TASK_SHUFFLE_BYTES:
        spark.conf.set(ADVISORY, f"{TASK_SHUFFLE_BYTES}b")
    if input_bytes:
        wanted = -(-input_bytes // TARGET_PARTITION_BYTES)
        initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        current = spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions")
        if wanted > int(current):
            spark.conf.set(initial, str(wanted))
    return spark


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Total stored bytes under `path`, asked from the file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(jvm_path).getLength() if fs.exists(jvm_path) else 0


def may_broadcast(df: DataFrame) -> bool:
    """Whether Spark takes `df` for small enough to send it to every task of a join."""
    limit = _bytes(df.sparkSession, df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def _bytes(spark: SparkSession, size: str) -> int:
    """The bytes of a setting such as `64MB`; 0 if it is switched off by a negative one."""
    return 0 if size.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below `path`; none if it does not exist."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(jvm_path)) if fs.exists(jvm_path) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder another name, in place of what is there, and make the folder above it."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    fs = paths[0].getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(paths[1], True)
    fs.mkdirs(paths[1].getParent())
    if not fs.rename(*paths):
        raise OSError(f"could not move {source} to {target}")


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there as a whole or not at all."""
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = draft.getFileSystem(spark._jsc.hadoopConfiguration()).create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, f"{path}.draft", path)


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of `write_note`, or None."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return None
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form the optimizer knows to be empty, so joins with it disappear."""
    nothing = spark.range(1).filter(F.lit(False))
    return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


@contextmanager
def advisory_size(spark: SparkSession, megabytes: int | None) -> Iterator[None]:
    """Partition size that rebalancing aims at, for the writes inside the block."""
    before = spark.conf.get(ADVISORY)
    if megabytes:
        spark.conf.set(ADVISORY, f"{megabytes}m")
    try:
        yield
    finally:
        spark.conf.set(ADVISORY, before)


_cleaned: set[str] = set()


def _clean(spark: SparkSession, app: str) -> None:
    """At the end of the process, remove what the session staged, if the session is still there."""
    context = SparkContext._active_spark_context
    if context is not None and context.applicationId == app:
        with suppress(Exception):
            remove(spark, scratch_dir(spark))


def scratch_dir(spark: SparkSession) -> str:
    """Folder for staged tables, which all executors reach.

    A subfolder of `spark.checkpoint.dir`; without that setting, of the warehouse, which
    is a shared location on any cluster. Never a folder of one machine's own choosing.
    """
    app = spark.sparkContext.applicationId
    if app not in _cleaned:
        _cleaned.add(app)
        atexit.register(_clean, spark, app)
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{shared.rstrip('/')}/sparge-{app}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write `df` to the scratch folder and return a frame that reads it back.

    Used where a frame feeds several actions, or where a table is about to be
    overwritten from its own contents. Unlike a cache, a staged table survives
    the loss of executors.
    """
    return _write_staged(df, scratch_path(df.sparkSession, label), partition_by)


@contextmanager
def staged(df: DataFrame, label: str, *partition_by: str) -> Iterator[DataFrame]:
    """`stage` for the length of a block.

    The staged files are removed when the block succeeds. When it fails they stay:
    should an overwrite have been cut short, they hold the rows it was writing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        yield _write_staged(df, path, partition_by)
    except Exception as failure:
        failure.add_note(f"staged rows, as far as written, are kept at {path}")
        raise
    remove(spark, path)


def _write_staged(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> DataFrame:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
