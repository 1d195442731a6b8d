from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sparge.contracts import columns
from sparge.operators import cdc
from sparge.plans.silver import apply_changes
from sparge.session import empty_frame, scratch_path

START = datetime(2024, 1, 1)
STATE = columns(
    "id bigint, value bigint, created_at timestamp, updated_at timestamp, deleted_at timestamp, partitioned_at string"
)


def batch(spark, changes):
    """Changes are `(id, value, operation, hours)`; a later position breaks ties."""
    rows = [(i, v, op, START + timedelta(hours=h), n) for n, (i, v, op, h) in enumerate(changes)]
    schema = "id bigint, value bigint, operation string, _control_ts timestamp, _seq int"
    return spark.createDataFrame(rows, schema)


def hours(ts):
    return None if ts is None else int((ts - START).total_seconds() // 3600)


def rows(df):
    return sorted(
        (r.id, r.value, hours(r.created_at), hours(r.updated_at), hours(r.deleted_at), r.partitioned_at)
        for r in df.collect()
    )


def model(changes, state=None):
    """The same state, computed one change after the other."""
    state = dict(state or {})
    for i, v, op, h in sorted(changes, key=lambda c: c[3]):
        created = h if op == "insert" or i not in state else state[i][1]
        day = (START + timedelta(hours=h)).strftime("%Y%m%d")
        state[i] = (v, created, h, h if op == "delete" else None, day)
    return state


def as_rows(state):
    return sorted((i, *values) for i, values in state.items())


def apply(spark, target, changes, **options):
    target = empty_frame(spark, STATE) if target is None else target
    return cdc.apply_cdc(target, batch(spark, changes), "id", ["_seq"], **options)


CHANGES = st.lists(
    st.tuples(st.integers(1, 4), st.integers(0, 99), st.sampled_from(["insert", "update", "delete"]), st.integers(0, 95)),
    min_size=1,
    max_size=12,
    unique_by=lambda c: c[3],
)
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SLOW
@given(changes=CHANGES)
def test_one_batch_equals_one_by_one(spark, changes):
    assert rows(apply(spark, None, changes)) == as_rows(model(changes))


@SLOW
@given(changes=CHANGES, cut=st.integers(0, 12))
def test_many_batches_equal_one(spark, changes, cut):
    ordered = sorted(changes, key=lambda c: c[3])
    first, second = ordered[:cut], ordered[cut:]
    state = apply(spark, None, first) if first else None
    if second:
        state = apply(spark, state, second)
        replayed = apply(spark, state, second)
        assert rows(replayed) == rows(state)
    assert rows(state) == as_rows(model(changes))


@SLOW
@given(changes=CHANGES, cut=st.integers(1, 11))
def test_monotonic_ignores_an_older_batch(spark, changes, cut):
    ordered = sorted(changes, key=lambda c: c[3])
    state = apply(spark, None, ordered)
    assert rows(apply(spark, state, ordered[:cut], monotonic=True)) == rows(state)


def test_update_before_insert_and_unknown_delete(spark):
    state = apply(spark, None, [(1, 5, "update", 1), (2, 6, "delete", 2)])
    assert rows(state) == [(1, 5, 1, 1, None, "20240101"), (2, 6, 2, 2, 2, "20240101")]


def test_delete_then_insert_revives(spark):
    state = apply(spark, None, [(1, 5, "insert", 1), (1, 5, "delete", 2)])
    assert rows(cdc.active(state)) == []
    state = apply(spark, state, [(1, 7, "insert", 30)])
    assert rows(cdc.active(state)) == [(1, 7, 30, 30, None, "20240102")]


def test_ties_follow_the_order_columns(spark):
    assert rows(apply(spark, None, [(1, 1, "update", 0), (1, 2, "update", 0)]))[0][1] == 2


def test_unknown_operations_are_counted(spark):
    df = batch(spark, [(1, 1, "insert", 0), (2, 1, "truncate", 0), (3, 1, None, 0)])
    assert {r.operation: r.row_count for r in cdc.operation_counts(df).collect()} == {"insert": 1, "unknown": 2}
    parts = cdc.split_operations(df)
    assert {k: v.count() for k, v in parts.items()} == {"insert": 1, "update": 0, "delete": 0, "unknown": 2}
    assert rows(apply(spark, None, [(1, 1, "insert", 0), (2, 1, "truncate", 0)])) == [(1, 1, 0, 0, None, "20240101")]


def test_strict_append_keeps_duplicates(spark):
    state = apply(spark, None, [(1, 1, "insert", 0), (1, 2, "insert", 1), (2, 9, "update", 2)], strict_append=True)
    assert rows(state) == [(1, 1, 0, 0, None, "20240101"), (1, 2, 1, 1, None, "20240101"), (2, 9, 2, 2, None, "20240101")]
    state = apply(spark, state, [(1, 5, "delete", 30)], strict_append=True)
    assert rows(state)[:2] == [(1, 5, 0, 30, 30, "20240102"), (1, 5, 1, 30, 30, "20240102")]


def test_latest_by_key_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 3, 4), (2, 7, None)], "k int, v int, t int")
    latest = cdc.latest_by_key(df, ["k"], ["t"])
    assert sorted(map(tuple, latest.collect())) == [(1, None, 5), (2, 7, None)]


def files(df):
    return {r.p for r in df.select(F.col("_metadata.file_path").alias("p")).distinct().collect()}


def read(spark, path):
    return spark.read.schema(STATE).parquet(path)


def test_apply_changes_moves_partitions(spark):
    path = scratch_path(spark, "table")
    first = [(1, 1, "insert", 0), (2, 2, "insert", 0), (3, 3, "insert", 26)]
    apply_changes(spark, path, STATE, batch(spark, first), "id", ["_seq"])
    untouched = files(read(spark, path).filter("partitioned_at = '20240102'"))

    touched = apply_changes(spark, path, STATE, batch(spark, [(1, 10, "update", 50)]), "id", ["_seq"])
    assert touched == ["20240101", "20240103"]
    assert rows(read(spark, path)) == as_rows(model(first + [(1, 10, "update", 50)]))
    assert untouched <= files(read(spark, path))

    # The last row leaves day one: nothing stale may stay behind.
    apply_changes(spark, path, STATE, batch(spark, [(2, 20, "delete", 51)]), "id", ["_seq"])
    assert rows(read(spark, path)) == [
        (1, 10, 0, 50, None, "20240103"), (2, 20, 0, 51, 51, "20240103"), (3, 3, 26, 26, None, "20240102")
    ]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(changes=CHANGES)
def test_apply_changes_equals_model(spark, changes):
    path = scratch_path(spark, "table")
    ordered = sorted(changes, key=lambda c: c[3])
    for start in range(0, len(ordered), 5):
        apply_changes(spark, path, STATE, batch(spark, ordered[start : start + 5]), "id", ["_seq"])
    assert rows(read(spark, path)) == as_rows(model(changes))


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with most rows sends one row per task, not all of them."""
    df = spark.range(20_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    latest = cdc.latest_by_key(df, ["k"], ["t"])
    assert latest.filter("k = 0").first().t == 19_999
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max_by")


@pytest.mark.parametrize("operation, created, deleted", [("insert", True, False), ("update", False, False), ("delete", False, True)])
def test_with_audit(spark, operation, created, deleted):
    row = cdc.with_audit(batch(spark, [(1, 1, operation, 25)])).first()
    assert (row.created_at is not None, row.deleted_at is not None) == (created, deleted)
    assert hours(row.updated_at) == 25 and row.partitioned_at == "20240102"
