"""Bronze changes to current-state silver tables, and the flat review table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sparge.contracts import ENTITIES, EVENT_TIME, RAW_ORDER, REVIEW_FLAT, columns
from sparge.functions.keys import layer_schema
from sparge.operators import ledger
from sparge.operators.cdc import CONTROL_TS, active, fold_changes, put_rows, with_created
from sparge.operators.flat import affected_months, build_review_flat
from sparge.plans.control import log_path, run_entries
from sparge.session import empty_frame, path_exists, read_note, staged, write_note
from sparge.sinks import key_index, swap
from sparge.sinks.files import replace_partitions
from sparge.sources.files import read_batch, read_partitions

PARTITION = "partitioned_at"
MERGES = "merges"
MONTHS = columns("day string, review_year int, review_month int")


def apply_changes(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    batch: DataFrame,
    key: str,
    order: Sequence[str] = (),
    ts: str = CONTROL_TS,
    monotonic: bool = False,
    by_ts: bool = True,
    token: tuple[str, int] | None = None,
) -> list[str]:
    """Merge a batch into the partitioned table at `path`; returns the partitions rewritten.

    A row moves to the partition of its new `updated_at`, so the partitions of both
    its old and its new version are rewritten; all others stay as they are. Old
    versions are found in the key index, without a look at the table. Partition names
    are collected, one per processing day touched.

    With `monotonic`, a change that is older than the stored one, in the order of
    `fold_changes`, is ignored. `token` names a stream and its batch: a batch that was
    merged is not merged again. The merge counts as a whole from the moment it is
    announced (see `sinks.swap`), and a crashed one is completed first.
    """
    path = path.rstrip("/")
    repair(spark, path, key)
    if token and _applied(spark, path, token[0]) >= token[1]:
        return []
    with staged(fold_changes(batch, key, order, ts, by_ts, versions=True), "changes") as changes:
        version = changes.schema["_version"].dataType
        if not key_index.exists(spark, path):
            table = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else empty_frame(spark, schema)
            key_index.start(spark, path, key, key_index.version_of_rows(table, version))
        incoming = changes.join(key_index.lookup(spark, path, key, changes), key, "left")
        if monotonic:
            incoming = incoming.filter(F.col("_known_version").isNull() | (F.col("_version") >= F.col("_known_version")))
        with staged(with_created(incoming), "incoming") as applied:
            new_day = F.coalesce(PARTITION, F.lit(swap.NULL_PARTITION))
            days = applied.select(F.explode(F.array("_known_day", new_day)).alias("day")).filter("day IS NOT NULL")
            touched = sorted(row.day for row in days.distinct().collect())
            if not touched:  # nothing but older changes
                if token:
                    write_note(spark, f"{path}/_applied/{token[0]}", str(token[1]))
                return []
            table = spark.read.schema(schema).parquet(path).filter(swap.within(PARTITION, touched))
            merged = put_rows(table, applied.select(*schema.names), key)
            number = _applied(spark, path, MERGES) + 1
            marks = {MERGES: str(number)} | ({token[0]: str(token[1])} if token else {})
            step = swap.prepare(spark, swap.new_swap(PARTITION, touched, **marks), path, merged)
            key_index.entries(applied, key, number).write.parquet(f"{step.folder(path)}/keys")
            swap.announce(spark, step, path)
        repair(spark, path, key)
        return touched


def repair(spark: SparkSession, path: str, key: str) -> None:
    """Complete announced merges; without any, there is nothing to do."""
    for step in swap.unfinished(spark, path):
        swap.complete(spark, step, path)
        key_index.append(spark, path, key, spark.read.parquet(f"{step.folder(path)}/keys"))
        for name, number in step.extra.items():
            write_note(spark, f"{path}/_applied/{name}", number)
    swap.tidy(spark, path)


def _applied(spark: SparkSession, path: str, stream: str) -> int:
    """The last batch of a stream that was merged, or -1; and the number of the last merge of all."""
    return int(read_note(spark, f"{path}/_applied/{stream}") or -1)


def day_counts(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str]) -> DataFrame:
    """(day, record_count) of the given partitions, also those without rows; only footers are read."""
    named = spark.createDataFrame([(d,) for d in days], "day string")
    rows = read_partitions(spark, path, days, schema).groupBy(F.col(PARTITION).alias("day")).agg(
        F.count("*").alias("record_count")
    )
    return named.join(rows, "day", "left").select("day", F.coalesce("record_count", F.lit(0)).alias("record_count"))


def _days(df: DataFrame) -> list[str]:
    return sorted(row[PARTITION] for row in df.select(PARTITION).distinct().collect())


def refresh_flat(spark: SparkSession, root: str, days: Sequence[str], active_only: bool = False) -> None:
    """Rebuild the given days of the flat table; other days stay as they are.

    A day that lost all its rows, because they moved to a later one, is emptied. A
    dimension table that does not exist is an error, not an empty one. Tables are read as
    their announced merges will leave them.
    """
    state = lambda name: swap.read_table_state(spark, f"{root}/silver/{name}", ENTITIES[name].silver)
    dims = {name: state(name) for name in ("beer", "brewery", "profile")}
    review = state("review").filter(swap.within(PARTITION, list(days)))
    review = active(review) if active_only else review
    flat = build_review_flat(review, **dims)
    present = [(day,) for day in _days(review)]
    replace_partitions(spark, flat, f"{root}/silver/review_flat", [(day,) for day in days], PARTITION, filled=present)


def run_silver(spark: SparkSession, root: str, table: str, now: Column) -> list[str]:
    """Apply the pending bronze files of one entity; returns the silver days rewritten.

    Changes are ordered by the time their envelope names, else by the time of their raw
    file, then by its key and their place in it, within a batch and against what is
    stored: a file that arrives late, or once more, undoes nothing newer.

    For reviews, these days become pending for the flat table.
    """
    contract = ENTITIES[table]
    touched: list[str] = []

    def work(started: DataFrame) -> None:
        batch = read_batch(spark, root, started, T.StructType([*contract.bronze.fields, *RAW_ORDER.fields]))
        # Bronze files of before have no time of their own rows.
        batch = batch.withColumn(EVENT_TIME, F.coalesce(EVENT_TIME, "_raw_time"))
        path = f"{root}/silver/{table}"
        touched.extend(apply_changes(spark, path, contract.silver, batch, contract.key, RAW_ORDER.names, monotonic=True, by_ts=False))
        if table == "review":
            ledger.append(ledger.day_entries(day_counts(spark, path, contract.silver, touched), now), log_path(root))

    run_entries(spark, root, layer_schema("silver"), table, now, work)
    return touched


def run_flat(spark: SparkSession, root: str, now: Column, active_only: bool = False) -> list[str]:
    """Rebuild the pending days of the flat table and make every mart pending for them.

    The review months these days held before and after are logged next to the
    ledger: a review whose time changed left a month that has to be recomputed too.
    """
    done: list[str] = []
    path = f"{root}/silver/review_flat"

    def work(started: DataFrame) -> None:
        days = ledger.entry_days(started)
        _log_months(spark, root, days)
        refresh_flat(spark, root, days, active_only)
        _log_months(spark, root, days)
        ledger.append(ledger.mart_entries(started, now), log_path(root))
        done.extend(days)

    def _log_months(spark: SparkSession, root: str, days: Sequence[str]) -> None:
        if path_exists(spark, path):
            flat = spark.read.schema(REVIEW_FLAT).parquet(path)
            months_of_days(flat, days).write.mode("append").parquet(f"{root}/control_months")

    run_entries(spark, root, layer_schema("silver"), "review_flat", now, work)
    return done


def months_of_days(flat: DataFrame, days: Sequence[str]) -> DataFrame:
    """Review months by processing day."""
    return affected_months(flat, days, by_day=True).select(*MONTHS.names)
