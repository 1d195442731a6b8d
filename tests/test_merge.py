"""The merge into stored tables: crashes at any step, the key index, late changes, repeated batches."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparge import fixtures as fx
from sparge.operators.cdc import CONTROL_TS, apply_cdc
from sparge.plans import silver
from sparge.plans.silver import apply_changes, repair
from sparge.session import child_names, empty_frame
from sparge.sinks import key_index, swap

SHAPE = f"user_id long, event_id long, value double, props string, operation string, {CONTROL_TS} timestamp"


def batch(spark, rows):
    """(user, event, operation, hour of January)"""
    made = [(u, e, float(e), f"p{e}", op, f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00") for u, e, op, h in rows]
    return spark.createDataFrame(made, SHAPE.replace("timestamp", "string")).withColumn(CONTROL_TS, F.col(CONTROL_TS).cast("timestamp"))


def contents(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def changes(seed, n=120, users=25, first=0):
    dice = random.Random(seed)
    return [(dice.randrange(users), first + i, dice.choice(("insert", "update", "update", "delete")), dice.randrange(24 * 9)) for i in range(n)]


def merged(spark, path, rows, **options):
    return apply_changes(spark, path, fx.EVENT_STATE, batch(spark, rows), "user_id", ["event_id"], **options)


def stored(spark, path):
    return spark.read.schema(fx.EVENT_STATE).parquet(path)


@pytest.mark.parametrize("moves", [0, 1, 3])
def test_a_crash_between_two_moves(spark, tmp_path, monkeypatch, moves):
    """Readers see the new state from the announcement on, every key once; the next merge completes the moves."""
    path = f"{tmp_path}/t"
    first, second, third = changes(1), changes(2, first=1000), changes(3, first=2000)
    merged(spark, path, first)
    real, left = swap.move, [moves]

    def failing(*args):
        if not left[0]:
            raise OSError("lost")
        left[0] -= 1
        real(*args)

    with monkeypatch.context() as crash:
        crash.setattr(swap, "move", failing)
        with pytest.raises(OSError, match="lost"):
            merged(spark, path, second)
    want = apply_cdc(apply_cdc(empty_frame(spark, fx.EVENT_STATE), batch(spark, first), "user_id", ["event_id"]), batch(spark, second), "user_id", ["event_id"])
    assert contents(swap.read_table_state(spark, path, fx.EVENT_STATE)) == contents(want)
    merged(spark, path, third)
    assert not child_names(spark, f"{path}/_merge")
    want = apply_cdc(want, batch(spark, third), "user_id", ["event_id"])
    assert contents(stored(spark, path)) == contents(swap.read_table_state(spark, path, fx.EVENT_STATE)) == contents(want)


def test_a_crash_before_the_announcement_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    merged(spark, path, changes(1))
    before = contents(stored(spark, path))
    with monkeypatch.context() as crash:
        crash.setattr(swap, "announce", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merged(spark, path, changes(2, first=1000))
    assert contents(swap.read_table_state(spark, path, fx.EVENT_STATE)) == before
    repair(spark, path, "user_id")
    assert contents(stored(spark, path)) == before and not child_names(spark, f"{path}/_merge")


def test_index_follows_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "APPENDED", 2)
    path = f"{tmp_path}/t"
    for i in range(5):
        merged(spark, path, changes(i, 60, first=100 * i))
        table = stored(spark, path)
        keys = table.select("user_id", F.struct(F.lit(None).cast("timestamp").alias("_at"), F.lit(None).cast("long").alias("event_id")).alias("_version"))
        found = key_index.lookup(spark, path, "user_id", keys)
        assert contents(found.select("user_id", "_known_day")) == contents(table.select("user_id", F.col("partitioned_at").alias("_known_day")))
    assert len(child_names(spark, f"{path}/_keys")) == 1 and "gen=0" not in child_names(spark, f"{path}/_keys")


def test_table_without_an_index(spark, tmp_path):
    """One that was written by other means gets its index from its rows."""
    path = f"{tmp_path}/t"
    state = apply_cdc(empty_frame(spark, fx.EVENT_STATE), batch(spark, changes(1)), "user_id", ["event_id"])
    state.write.partitionBy("partitioned_at").parquet(path)
    merged(spark, path, changes(2, first=1000))
    want = apply_cdc(state, batch(spark, changes(2, first=1000)), "user_id", ["event_id"])
    assert contents(stored(spark, path)) == contents(want)


def test_old_versions_are_found_without_the_table(spark, tmp_path, monkeypatch):
    """Only partitions that hold an old or a new version of a changed key are read."""
    path = f"{tmp_path}/t"
    merged(spark, path, [(1, 1, "insert", 1), (2, 2, "insert", 30), (3, 3, "insert", 60)])
    for f in (tmp_path / "t" / "partitioned_at=20240103").glob("*.parquet"):
        f.write_bytes(b"would fail any read")
    assert merged(spark, path, [(1, 9, "update", 31)]) == ["20240101", "20240102"]
    assert child_names(spark, path)[-2:] == ["partitioned_at=20240102", "partitioned_at=20240103"]


def test_late_changes_and_repeated_batches(spark, tmp_path):
    path = f"{tmp_path}/t"
    merged(spark, path, [(1, 5, "update", 50)], monotonic=True, token=("s", 0))
    assert merged(spark, path, [(1, 4, "delete", 10)], monotonic=True, token=("s", 1)) == []
    assert merged(spark, path, [(1, 6, "update", 60)], monotonic=True, token=("s", 1)) == []  # merged already
    assert merged(spark, path, [(1, 6, "update", 60)], monotonic=True, token=("s", 2)) == ["20240103"]
    assert [(r.event_id, r.created_at.day) for r in stored(spark, path).collect()] == [(6, 3)]


def test_order_without_the_control_time(spark, tmp_path):
    """The order of the changes decides, not when they were registered."""
    path = f"{tmp_path}/t"
    apply_changes(spark, path, fx.EVENT_STATE, batch(spark, [(1, 7, "insert", 1), (1, 3, "update", 9)]), "user_id", ["event_id"], by_ts=False)
    assert [r.event_id for r in stored(spark, path).collect()] == [7]
    apply_changes(spark, path, fx.EVENT_STATE, batch(spark, [(1, 5, "update", 99)]), "user_id", ["event_id"], by_ts=False, monotonic=True)
    assert [r.event_id for r in stored(spark, path).collect()] == [7]


def test_changes_without_a_time(spark, tmp_path):
    rows = batch(spark, [(1, 1, "insert", 1), (2, 2, "insert", 1)])
    rows = rows.withColumn(CONTROL_TS, F.when(F.col("user_id") == 1, F.col(CONTROL_TS)))
    for _ in range(2):
        apply_changes(spark, f"{tmp_path}/t", fx.EVENT_STATE, rows, "user_id", ["event_id"])
    assert sorted(r.user_id for r in stored(spark, f"{tmp_path}/t").collect()) == [1, 2]
    assert silver._applied(spark, f"{tmp_path}/t", "none") == -1
