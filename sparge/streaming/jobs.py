"""Routing, raw to bronze and silver upsert as streams, and the hand-over from a full load to changes."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from sparge.operators.cdc import CONTROL_TS
from sparge.operators.routing import delivered, parse_envelopes
from sparge.plans.bronze import listed, process_files
from sparge.plans.silver import apply_changes
from sparge.session import child_names, move, path_exists, read_note, remove, write_note
from sparge.sources.streams import read_cdc_stream


def _start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool, interval: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


# --- routing ----------------------------------------------------------------

def write_routed_stream(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = "90 seconds"
) -> StreamingQuery:
    """Deliver envelopes as gzip JSON lines: accepted ones below `<path>/raw/<table>/`, dropped ones below `<path>/errors/`.

    One query, one parse: a batch is written once, by kind and table, beside the lake, and its folders are then moved
    into place as `batch-<number>`. A folder is there as a whole or not at all, and a batch that is repeated after a
    crash leaves alone what was delivered: nothing is lost and nothing is delivered twice. Batches are numbered by the
    checkpoint; an output belongs to one checkpoint, and another one is refused.
    """
    path = path.rstrip("/")

    def deliver(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        _claim(spark, f"{path}/_routing/owner", stream_id(spark, checkpoint))
        draft = f"{path}/_routing/batch"
        parsed = parse_envelopes(batch.select("value"))
        dropped = F.to_json(F.struct("drop_reason", "table_name", "operation", "value"))
        kind = F.when(F.col("drop_reason").isNull(), "raw").otherwise("errors")
        place = F.coalesce("drop_reason", "table_name")
        line = F.when(F.col("drop_reason").isNull(), delivered(F.col("payload"), F.col("event_time"))).otherwise(dropped)
        rows = parsed.select(kind.alias("kind"), place.alias("place"), line.alias("value"))
        rows.write.mode("overwrite").partitionBy("kind", "place").option("compression", "gzip").text(draft)
        for folder in ("raw", "errors"):
            for name in child_names(spark, f"{draft}/kind={folder}"):
                target = f"{path}/{folder}/{name.removeprefix('place=')}/batch-{number:010d}"
                if not path_exists(spark, target):
                    move(spark, f"{draft}/kind={folder}/{name}", target)
        remove(spark, draft)

    return _start(stream, deliver, checkpoint, available_now, interval)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its stream; a new checkpoint is another stream, whose batches count anew."""
    return json.loads(read_note(spark, f"{checkpoint.rstrip('/')}/metadata") or "{}").get("id", "")


def _claim(spark: SparkSession, path: str, owner: str) -> None:
    found = read_note(spark, path)
    if found is None:
        write_note(spark, path, owner)
    elif found != owner:
        raise ValueError(f"{path}: batches of another checkpoint were delivered here")


def snapshot_envelopes(rows: DataFrame, table: str, at: Column) -> DataFrame:
    """Rows of a source table as envelopes of inserts, made at `at`: what a full load sends before the changes."""
    meta = F.struct(F.lit(table).alias("table-name"), F.lit("insert").alias("operation"), at.cast("string").alias("timestamp"))
    data = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.select(F.to_json(F.struct(data.alias("data"), meta.alias("metadata"))).alias("value"))


def bootstrap_then_stream(
    spark: SparkSession, snapshots: Mapping[str, DataFrame], at: Column, changes: str, path: str, checkpoint: str,
    available_now: bool = False, interval: str = "90 seconds",
) -> StreamingQuery:
    """Load source tables in full, then go on with their changes, on one checkpoint.

    `changes` is the folder in which change envelopes arrive, also while the load runs. The rows of each snapshot are
    put there once, as inserts made at `at`, the time of the snapshot; changes made before carry earlier times and
    lose against them in silver, whatever the order of arrival. The backlog is routed first, and the same query
    continues with what arrives (unless `available_now`).
    """
    changes = changes.rstrip("/")
    for table, rows in sorted(snapshots.items()):
        target = f"{changes}/full-load-{table}"
        if not path_exists(spark, target):
            draft = f"{changes}/_full-load-{table}"
            snapshot_envelopes(rows, table, at).write.mode("overwrite").option("compression", "gzip").text(draft)
            move(spark, draft, target)
    source = lambda: read_cdc_stream(spark, changes, recursiveFileLookup="true")
    backlog = write_routed_stream(source(), path, checkpoint, available_now=True)
    backlog.awaitTermination()
    return backlog if available_now else write_routed_stream(source(), path, checkpoint, interval=interval)


# --- raw to bronze ------------------------------------------------------------

# What the source of file names gives; contents are not asked for, and so not read.
FILE_NAMES = "path string, modificationTime timestamp, length bigint, content binary"


def stream_raw_to_bronze(
    spark: SparkSession, root: str, table: str, checkpoint: str, now: Column | None = None,
    mask: str | Sequence[str] | None = "auto", available_now: bool = False, interval: str = "90 seconds",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process the raw files of one table as they arrive, exactly as `run_bronze` does: the same ledger, checks and masks.

    The stream is one of file names: contents are read once, by the job, in the format of each file. Every file of a
    batch gets its entry; valid rows go to bronze, masked, rejected ones aside, and silver finds what to do. A batch that
    is repeated after a crash takes up the entries that were cut short, and replaces what they had written.
    """
    root = root.rstrip("/")
    names = spark.readStream.format("binaryFile").schema(FILE_NAMES).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
    stream = names.load(f"{root}/raw/{table}").select("path", "length")

    def work(batch: DataFrame, _number: int) -> None:
        at = F.current_timestamp() if now is None else now
        fixed = F.lit(batch.sparkSession.range(1).select(at).first()[0])  # one time for all steps of the batch
        files = batch.select(F.col("path").alias("object_path"), F.col("length").alias("file_size"))
        process_files(batch.sparkSession, root, table, fixed, listed(files, table), mask, only_listed=True)

    return _start(stream, work, checkpoint, available_now, interval)


# --- silver -----------------------------------------------------------------

def stream_apply_cdc(
    changes: DataFrame, path: str, schema: T.StructType, key: str, checkpoint: str, order: Sequence[str] = (),
    ts: str = CONTROL_TS, available_now: bool = False, interval: str = "90 seconds",
) -> StreamingQuery:
    """Upsert a stream of changes into a silver table, one merge per micro-batch.

    The number of the last merged batch is kept next to the table and becomes valid together with the batch, so a batch
    that the stream repeats after a crash is not merged again. A change that arrives in a later batch does not undo a
    newer one.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        token = (stream_id(spark, checkpoint), number)
        apply_changes(spark, path, schema, batch, key, order, ts, monotonic=True, token=token)

    return _start(changes, merge, checkpoint, available_now, interval)
