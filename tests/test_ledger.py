from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparge.contracts import LEDGER
from sparge.operators import ledger
from sparge.session import empty_frame

MANIFEST = "object_key string, record_count bigint, file_size bigint, checksum string"


def at(hour):
    return F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp")


def register(spark, log, *keys, hour=0, count=5):
    return ledger.register_files(log, spark.createDataFrame([(k, count, 10, "c") for k in keys], MANIFEST), at(hour))


def empty(spark):
    return empty_frame(spark, LEDGER)


def test_register(spark):
    rows = register(spark, empty(spark), "raw/beer/dm-batch-process-1.csv.gz", "raw/review/s-1.json.gz")
    found = {r.table_name: r for r in rows.collect()}
    beer = found["beer"]
    assert rows.schema.names == LEDGER.names
    assert (beer.schema_name, beer.file_format, beer.status, beer.attempt_count) == ("dm_bronze", "csv", "pending", 0)
    assert found["review"].file_format == "json"
    assert beer.created_at == datetime(2024, 1, 1)


def test_register_is_idempotent(spark):
    log = register(spark, empty(spark), "raw/beer/a.gz")
    assert register(spark, log, "raw/beer/a.gz", hour=1).count() == 0
    assert [r.object_key for r in register(spark, log, "raw/beer/a.gz", "raw/beer/b.gz", "raw/beer/b.gz").collect()] == ["raw/beer/b.gz"]


@pytest.mark.parametrize("count, kind", [(0, "small"), (100_000, "small"), (100_001, "bulk")])
def test_size_class(spark, count, kind):
    assert register(spark, empty(spark), "raw/beer/a.gz", count=count).first().compute_target == kind


def test_states_and_retries(spark):
    log = register(spark, empty(spark), "raw/beer/a.gz")
    for attempt in (1, 2, 3):
        todo = ledger.eligible(log)
        assert todo.count() == 1
        started = ledger.start(todo, at(attempt))
        log = log.unionByName(started)
        current = ledger.ledger_current(log).first()
        assert (current.status, current.attempt_count, current.duration) == ("running", attempt, 0)
        assert ledger.eligible(log).count() == 0
        finished = ledger.finish(started, at(attempt) + F.expr("INTERVAL 90 SECONDS"), "x" * 1500)
        log = log.unionByName(finished)
        current = ledger.ledger_current(log).first()
        assert (current.status, current.duration, len(current.error_message)) == ("error", 90_000, 1500)
    assert ledger.eligible(log).count() == 0
    assert ledger.eligible(log, max_attempts=4).count() == 1


def test_success_is_final_and_clears_the_error(spark):
    started = ledger.start(register(spark, empty(spark), "raw/beer/a.gz"), at(1))
    done = ledger.finish(started, at(1))  # same second: success outranks running
    current = ledger.ledger_current(started.unionByName(done)).first()
    assert (current.status, current.error_message, current.duration) == ("success", None, 0)
    assert ledger.eligible(started.unionByName(done)).count() == 0


def test_lookups(spark):
    log = register(spark, empty(spark), "raw/beer/a.gz", "raw/beer/b.gz", "raw/review/c.gz")
    assert sorted(r.table_name for r in ledger.pending_tables(log, "dm_bronze").collect()) == ["beer", "review"]
    assert ledger.pending_tables(log, "dm_silver").count() == 0
    assert ledger.pending(log, "dm_bronze", "beer").count() == 2
    assert ledger.by_object_key(log, "raw/review/c.gz").first().table_name == "review"


def test_derived_entries(spark):
    log = register(spark, empty(spark), "raw/review/a.json.gz", "raw/review/b.json.gz")
    silver = ledger.next_layer(log, log, at(2))
    assert sorted(r.object_key for r in silver.collect()) == [
        "bronze/review/year=2024/month=01/day=01/a.parquet",
        "bronze/review/year=2024/month=01/day=01/b.parquet",
    ]
    assert ledger.next_layer(log.unionByName(silver), log, at(3)).count() == 0
    flat = ledger.flat_entries(silver, at(3))
    assert [(r.object_key, r.record_count) for r in flat.collect()] == [("silver/review/partitioned_at=20240101", 10)]
    marts = ledger.mart_entries(flat, at(4)).collect()
    assert len({r.control_id for r in marts}) == 5
    assert {r.object_key for r in marts} == {"silver/review_flat/partitioned_at=20240101"}
    assert ledger.entry_days(flat) == ["20240101"]
