"""Change-data capture: audit columns, latest change per key, upsert with soft deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparge.contracts import OPERATIONS
from sparge.functions.time import partition_day

CONTROL_TS = "_control_ts"


def split_operations(df: DataFrame) -> dict[str, DataFrame]:
    """Rows by operation; anything else comes under `unknown` instead of vanishing."""
    parts = {op: df.filter(F.col("operation") == op) for op in OPERATIONS}
    parts["unknown"] = df.filter(~_known())
    return parts


def operation_counts(df: DataFrame) -> DataFrame:
    """Row count per operation in one pass."""
    return df.groupBy(F.when(_known(), F.col("operation")).otherwise("unknown").alias("operation")).agg(
        F.count("*").alias("row_count")
    )


def _known() -> Column:
    return F.coalesce(F.col("operation").isin(*OPERATIONS), F.lit(False))


def with_audit(df: DataFrame, ts: str = CONTROL_TS) -> DataFrame:
    """Audit columns of each change: inserts are created, deletes are tombstoned at `ts`."""
    at = F.col(ts).cast("timestamp")
    return df.withColumns(
        {
            "created_at": F.when(F.col("operation") == "insert", at),
            "updated_at": at,
            "deleted_at": F.when(F.col("operation") == "delete", at),
            "partitioned_at": partition_day(at),
        }
    )


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key by a total order.

    Same result as `row_number() = 1`, but as an aggregate: each task first reduces
    its own rows, so a key holding much of the table never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*").select(*df.columns)


def fold_changes(
    batch: DataFrame, key: str, order: Sequence[str], ts: str = CONTROL_TS, by_ts: bool = True, versions: bool = False
) -> DataFrame:
    """Reduce a batch to one change per key.

    Besides the payload and audit columns of the last change, `_inserted_at` holds
    the time of the last insert and `_first_at` that of the first change; both feed
    `created_at` in `merge_upsert`. Columns starting with `_` serve as `order` only.
    Changes are ordered by `ts`, then by `order`; without `by_ts` by `order` alone, for
    batches whose `ts` tells when a change was registered and not when it was made.
    With `versions`, `_version` holds the last change's place in that order.
    """
    known = batch.filter(_known())
    helpers = {"operation", ts, key}
    payload = [c for c in batch.columns if c not in helpers and not c.startswith("_")]
    at = F.col(ts).cast("timestamp")
    total = F.struct(*([at.alias("_at")] if by_ts else []), *order)
    folded = known.groupBy(key).agg(
        F.max_by(F.struct("operation", at.alias("updated_at"), *payload), total).alias("_last"),
        F.max(total).alias("_version"),
        F.max(F.when(F.col("operation") == "insert", at)).alias("_inserted_at"),
        F.min(at).alias("_first_at"),
    )
    return folded.select(key, "_last.*", "_inserted_at", "_first_at", "_version").select(
        key,
        *payload,
        "updated_at",
        F.when(F.col("operation") == "delete", F.col("updated_at")).alias("deleted_at"),
        partition_day(F.col("updated_at")).alias("partitioned_at"),
        "_inserted_at",
        "_first_at",
        *(["_version"] if versions else []),
    )


def merge_upsert(target: DataFrame, source: DataFrame, key: str, monotonic: bool = False) -> DataFrame:
    """Target with every key of `source` (from `fold_changes`) updated or inserted.

    Both joins with the target put the change set on the side Spark may broadcast:
    when the batch is small against the table, the table is not shuffled at all;
    when it is not, they become sort-merge joins. The choice is Spark's, by size.

    With `monotonic`, a change older than the stored row is ignored.
    """
    known = (
        target.join(source.select(key), key, "left_semi")
        .groupBy(key)
        .agg(
            F.max_by("created_at", "updated_at").alias("_known_created"),
            F.max("updated_at").alias("_known_updated"),
        )
    )
    incoming = source.join(known, key, "left")
    if monotonic:
        incoming = incoming.filter(
            F.col("_known_updated").isNull() | (F.col("updated_at") >= F.col("_known_updated"))
        )
    return put_rows(target, with_created(incoming).select(*target.columns), key)


def with_created(incoming: DataFrame) -> DataFrame:
    """Adds `created_at`: of the last insert, else as known (`_known_created`), else of the first change."""
    return incoming.withColumn("created_at", F.coalesce("_inserted_at", "_known_created", "_first_at"))


def put_rows(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Target with the rows of `incoming` in place of its own ones of the same keys."""
    return target.join(incoming.select(key), key, "left_anti").unionByName(incoming)


def apply_cdc(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    order: Sequence[str] = (),
    ts: str = CONTROL_TS,
    monotonic: bool = False,
    strict_append: bool = False,
) -> DataFrame:
    """State after a batch of changes.

    By default inserts take part in the same latest-per-key fold as updates and
    deletes, so a replayed batch changes nothing. `strict_append` adds inserts as
    new rows without looking at the key, then updates every row of a changed key.
    `order` breaks ties between changes of one key at the same `ts`.
    """
    if not strict_append:
        return merge_upsert(target, fold_changes(batch, key, order, ts), key, monotonic)
    parts = split_operations(batch)
    inserted = with_audit(parts["insert"], ts).select(*target.columns)
    base = target.unionByName(inserted)
    changes = fold_changes(parts["update"].unionByName(parts["delete"]), key, order, ts)
    changes = changes.withColumn("created_at", F.lit(None).cast("timestamp")).select(*target.columns)
    kept = {key, "created_at"}
    s = changes.withColumn("_present", F.lit(True)).alias("s")
    updated = base.alias("t").join(s, key, "left").select(
        *[
            F.col(f"t.{c}").alias(c) if c in kept and c != key
            else F.col(c) if c == key
            else F.when(F.col("s._present"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )
    fresh = changes.join(base.select(key).distinct(), key, "left_anti").withColumn("created_at", F.col("updated_at"))
    return updated.unionByName(fresh)


def active(df: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.filter(F.col("deleted_at").isNull())
