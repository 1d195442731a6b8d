"""Processing ledger: an append-only log of state rows, and what can be read from it.

Every change of state appends a full row; the current state of an entry is the
last row of its `control_id`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparge.contracts import LEDGER, STATUSES
from sparge.functions import keys
from sparge.functions.time import duration_ms, partition_day
from sparge.operators.marts import MARTS

MAX_ATTEMPTS = 3
SMALL_FILE_RECORDS = 100_000


def size_class(record_count: Column) -> Column:
    """Null while the count is unknown."""
    return F.when(record_count <= SMALL_FILE_RECORDS, "small").when(record_count.isNotNull(), "bulk")


def _complete(df: DataFrame) -> DataFrame:
    """All ledger columns in order; the ones not given are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in LEDGER.fields
        ]
    )


def _entries(df: DataFrame, now: Column) -> DataFrame:
    """New pending rows with their deterministic id."""
    return _complete(
        df.withColumns(
            {
                "control_id": keys.control_id(F.col("schema_name"), F.col("table_name"), F.col("object_key")),
                "status": F.lit("pending"),
                "attempt_count": F.lit(0),
                "created_at": now,
                "updated_at": now,
            }
        )
    )


def ledger_current(log: DataFrame) -> DataFrame:
    """Last row of every entry: of its newest registration, by time and then by how far its status is.

    An entry may be registered again while it is running. That row is newer work, even
    if the running one finishes later: the finish belongs to the registration it started from.
    """
    rank = F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status"))
    rest = [c for c in log.columns if c != "control_id"]
    order = F.struct("created_at", "updated_at", F.coalesce("attempt_count", F.lit(0)).alias("attempts"), rank.alias("rank"))
    last = F.max_by(F.struct(*rest), order)
    return log.groupBy("control_id").agg(last.alias("_last")).select("control_id", "_last.*").select(*log.columns)


def register_files(log: DataFrame, manifest: DataFrame, now: Column, layer: str = "bronze") -> DataFrame:
    """Pending entries for raw files whose `object_key` the ledger has not seen.

    `manifest` holds `object_key, record_count, file_size, checksum`.
    """
    fresh = manifest.join(log.select("object_key").distinct(), "object_key", "left_anti").dropDuplicates(["object_key"])
    key = F.col("object_key")
    return _entries(
        fresh.withColumns(
            {
                "schema_name": F.lit(keys.layer_schema(layer)),
                "table_name": keys.key_table(key),
                "file_format": keys.file_format(key),
                "compute_target": size_class(F.col("record_count")),
            }
        ),
        now,
    )


def pending(log: DataFrame, schema: str, table: str | None = None) -> DataFrame:
    rows = ledger_current(log).filter((F.col("schema_name") == schema) & (F.col("status") == "pending"))
    return rows if table is None else rows.filter(F.col("table_name") == table)


def pending_tables(log: DataFrame, schema: str) -> DataFrame:
    names = pending(log, schema).select(F.btrim("table_name").alias("table_name"))
    return names.filter(F.col("table_name") != "").distinct()


def by_object_key(log: DataFrame, key: str) -> DataFrame:
    return ledger_current(log.filter(F.col("object_key") == key))


def eligible(log: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Entries to process: pending ones, and failed ones with attempts left."""
    retry = (F.col("status") == "error") & (F.col("attempt_count") < max_attempts)
    return ledger_current(log).filter((F.col("status") == "pending") | retry)


def unfinished(log: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Entries to process and those that are running, whoever runs them."""
    spent = (F.col("status") == "error") & (F.col("attempt_count") >= max_attempts)
    return ledger_current(log).filter((F.col("status") != "success") & ~spent)


def start(entries: DataFrame, now: Column) -> DataFrame:
    """Rows that move entries to `running`."""
    return _complete(
        entries.withColumns(
            {
                "status": F.lit("running"),
                "attempt_count": F.coalesce("attempt_count", F.lit(0)) + 1,
                "started_at": now,
                "finished_at": F.lit(None),
                "duration": F.lit(0),
                "error_message": F.lit(None),
                "updated_at": now,
            }
        )
    )


def finish(entries: DataFrame, now: Column, error: str | None = None) -> DataFrame:
    """Rows that end running entries as `success`, or as `error` with its text."""
    return _complete(
        entries.withColumns(
            {
                "status": F.lit("error" if error is not None else "success"),
                "finished_at": now,
                "duration": duration_ms(F.col("started_at"), now),
                "error_message": F.lit(error).cast("string"),
                "updated_at": now,
            }
        )
    )


def next_layer(log: DataFrame, entries: DataFrame, now: Column) -> DataFrame:
    """Pending silver entries for bronze files just written; known keys are left out.

    Key, `file_size` and `checksum` of the new files replace those derived from the raw ones
    when `entries` carries `new_object_key`, `new_file_size` and `new_checksum`.
    """
    has = set(entries.columns)
    key = keys.destination_key(F.col("object_key"), "bronze", F.col("created_at"))
    key = F.col("new_object_key") if "new_object_key" in has else key
    derived = entries.select(
        key.alias("object_key"),
        F.lit(keys.layer_schema("silver")).alias("schema_name"),
        keys.key_table(key).alias("table_name"),
        "record_count",
        F.lit("parquet").alias("file_format"),
        F.col("new_file_size" if "new_file_size" in has else "file_size").alias("file_size"),
        F.col("new_checksum" if "new_checksum" in has else "checksum").alias("checksum"),
        F.lit("emr").alias("compute_target"),
    )
    return _entries(derived.join(log.select("object_key").distinct(), "object_key", "left_anti"), now)


def flat_entries(entries: DataFrame, now: Column) -> DataFrame:
    """One pending flat-table entry per ingestion day of the given review entries."""
    days = entries.groupBy(partition_day(F.col("created_at")).alias("day")).agg(
        F.sum("record_count").alias("record_count")
    )
    return day_entries(days, now)


def day_entries(days: DataFrame, now: Column) -> DataFrame:
    """Pending flat-table entries for processing days (`day, record_count`)."""
    return _entries(
        days.select(
            F.concat(F.lit("silver/review/partitioned_at="), "day").alias("object_key"),
            F.lit(keys.layer_schema("silver")).alias("schema_name"),
            F.lit("review_flat").alias("table_name"),
            "record_count",
            F.lit("parquet").alias("file_format"),
            F.lit("emr").alias("compute_target"),
        ),
        now,
    )


def mart_entries(entries: DataFrame, now: Column) -> DataFrame:
    """One pending entry per mart for every flat-table entry."""
    day = keys.key_partition(F.col("object_key"))
    return _entries(
        entries.select(
            F.concat(F.lit("silver/review_flat/partitioned_at="), day).alias("object_key"),
            F.lit(keys.layer_schema("gold")).alias("schema_name"),
            F.explode(F.array(*map(F.lit, MARTS))).alias("table_name"),
            "record_count",
            "file_format",
            "compute_target",
        ),
        now,
    )


def health(log: DataFrame, width: str = "1 hour") -> DataFrame:
    """Finished runs per time window, table and status."""
    return (
        log.filter(F.col("finished_at").isNotNull() & F.col("status").isin("success", "error"))
        .groupBy(F.window("finished_at", width).alias("_window"), "table_name", "status")
        .agg(
            F.count("*").alias("run_count"),
            F.avg("duration").alias("avg_duration"),
            F.max("attempt_count").alias("max_attempts"),
        )
        .select(F.col("_window.start").alias("window_start"), "table_name", "status", "run_count", "avg_duration", "max_attempts")
    )


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    from sparge.sources.files import read_or_empty

    return read_or_empty(spark, path, LEDGER)


def entry_days(entries: DataFrame) -> Sequence[str]:
    """Processing days named by partition keys; one value per day is collected."""
    rows = entries.select(keys.key_partition(F.col("object_key")).alias("day")).distinct().collect()
    return sorted(row.day for row in rows)
