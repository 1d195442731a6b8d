from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from sparge.contracts import ENTITIES
from sparge.operators import ledger
from sparge.operators.cdc import CONTROL_TS
from sparge.plans.bronze import raw_listing
from sparge.plans.silver import run_silver
from sparge.session import move
from sparge.sources.streams import read_cdc_stream
from sparge.streaming.jobs import bootstrap_then_stream, stream_apply_cdc, stream_raw_to_bronze, write_routed_stream

BREWERY = ENTITIES["brewery"]


def envelope(i, operation="insert", table="brewery", name=None, at=None):
    data = {"brewery_id": i, "brewery_name": name or f"b{i}"}
    time = {"timestamp": at} if at else {}
    return json.dumps({"data": data, "metadata": {"table-name": table, "operation": operation, **time}})


def add(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def wait(*queries):
    for query in queries:
        query.awaitTermination(120)
        assert query.exception() is None and not query.isActive


def route(spark, tmp_path):
    stream = read_cdc_stream(spark, str(tmp_path / "in"))
    wait(write_routed_stream(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), available_now=True))


def lines(folder):
    return sorted((json.loads(x) for f in folder.rglob("*.gz") for x in gzip.decompress(f.read_bytes()).splitlines()), key=str)


def test_router_restarts_without_repeating(spark, tmp_path):
    add(tmp_path / "in", "1.txt", [envelope(1), envelope(2, table="other"), "broken", envelope(3, table="")])
    route(spark, tmp_path)
    add(tmp_path / "in", "2.txt", [envelope(4, "update", at="2024-01-02T00:00:00Z")])
    route(spark, tmp_path)
    route(spark, tmp_path)
    assert lines(tmp_path / "out" / "raw" / "brewery") == [
        {"_event_time": "2024-01-02T00:00:00Z", "brewery_id": 4, "brewery_name": "b4", "operation": "update"},
        {"brewery_id": 1, "brewery_name": "b1", "operation": "insert"},
    ]
    errors = {(r["drop_reason"], r["table_name"], r.get("value", "")[:6]) for r in lines(tmp_path / "out" / "errors")}
    assert errors == {("unparsed", "unparsed", "broken"), ("missing_table", "unknown", '{"data')}


def test_a_repeated_batch_delivers_nothing_twice(spark, tmp_path, monkeypatch):
    """A crash after some folders were moved: the rest follows, and what was delivered stays as it was."""
    from sparge.streaming import jobs

    add(tmp_path / "in", "1.txt", [envelope(1), envelope(2, table="other"), "broken"])
    moved = []

    def failing(spark, source, target):
        if len(moved) == 1:
            raise OSError("lost")
        moved.append(target)
        move(spark, source, target)

    with monkeypatch.context() as crash:
        crash.setattr(jobs, "move", failing)
        query = write_routed_stream(read_cdc_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ckpt"), available_now=True)
        with pytest.raises(Exception, match="lost"):
            query.awaitTermination(120)
    first = {f: f.read_bytes() for f in (tmp_path / "out").rglob("*/batch-*/*.gz")}
    assert len(first) == 1
    route(spark, tmp_path)
    assert all(f.read_bytes() == data for f, data in first.items())
    assert [len(lines(tmp_path / "out" / x)) for x in ("raw/brewery", "raw/other", "errors")] == [1, 1, 1]


def test_an_output_belongs_to_one_checkpoint(spark, tmp_path):
    add(tmp_path / "in", "1.txt", [envelope(1)])
    route(spark, tmp_path)
    query = write_routed_stream(read_cdc_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "other"), available_now=True)
    with pytest.raises(Exception, match="another checkpoint"):
        query.awaitTermination(120)


def test_full_load_then_changes(spark, tmp_path):
    """A change made before the snapshot arrives after it, and loses; one made after it arrives before, and wins."""
    root, landing = str(tmp_path / "lake"), tmp_path / "in"
    snapshot = spark.createDataFrame([(i, f"s{i}") for i in range(20)], "brewery_id long, brewery_name string")
    at = F.lit("2024-01-10 00:00:00").cast("timestamp")
    add(landing, "1.txt", [envelope(1, "update", name="newer", at="2024-01-11T00:00:00Z")])
    query = bootstrap_then_stream(spark, {"brewery": snapshot}, at, str(landing), root, str(tmp_path / "ckpt"), interval="1 second")
    try:
        add(landing, "2.txt", [envelope(2, "update", name="older", at="2024-01-09T00:00:00Z"), envelope(99, at="2024-01-12T00:00:00Z"), "broken"])
        query.processAllAvailable()
    finally:
        query.stop()
    for attempt in range(2):
        now = F.lit(f"2024-02-0{attempt + 1} 00:00:00").cast("timestamp")
        wait(stream_raw_to_bronze(spark, root, "brewery", str(tmp_path / "bronze-ckpt"), now, available_now=True, files_per_batch=1))
        run_silver(spark, root, "brewery", now)
    state = {r.brewery_id: r.brewery_name for r in spark.read.schema(BREWERY.silver).parquet(f"{root}/silver/brewery").collect()}
    assert state == {**{i: f"s{i}" for i in range(20)}, 1: "newer", 99: "b99"}
    again = bootstrap_then_stream(spark, {"brewery": snapshot}, at, str(landing), root, str(tmp_path / "ckpt"), available_now=True)
    wait(again)
    assert len(lines(tmp_path / "lake" / "raw" / "brewery")) == 23 and len(lines(tmp_path / "lake" / "errors")) == 1


def test_raw_to_bronze(spark, tmp_path):
    """Masked, split from rejected rows, registered for silver; a broken file is an error by itself."""
    raw = tmp_path / "raw" / "profile"
    person = {"profile_id": 1, "profile_name": "A B", "email": "none", "state": "WA", "operation": "insert"}
    add(raw, "1.json", [json.dumps({**person, "profile_id": i, "email": f"p{i}@example.com" if i else "none"}) for i in range(4)])

    def run(day):
        now = F.lit(f"2024-02-0{day} 00:00:00").cast("timestamp")
        wait(stream_raw_to_bronze(spark, str(tmp_path), "profile", str(tmp_path / "ckpt"), now, available_now=True))

    run(1)
    # Of this batch one value in four is an address; the column was found out before.
    add(raw, "2.json", [json.dumps({**person, "profile_id": i}) for i in (7, 8, 9)] + [json.dumps({**person, "profile_id": 10, "email": "late@example.com"}), "broken"])
    (raw / "3.json.gz").write_bytes(b"\x1f\x8b broken")
    add(raw, "4.json", [json.dumps({**person, "profile_id": None})])
    run(2)
    run(3)
    rows = spark.read.parquet(str(tmp_path / "bronze" / "profile"))
    assert sorted(r.profile_id for r in rows.collect()) == [0, 1, 2, 3, 7, 8, 9, 10]
    assert {r.email for r in rows.filter("profile_id in (3, 10)").collect()} == {"p" + "*" * 12 + "m", "l" + "*" * 14 + "m"}
    rejected = spark.read.json(str(tmp_path / "rejected" / "profile"))
    assert sorted(r.reasons[0].reason for r in rejected.collect()) == ["malformed_row", "missing_value"]
    state = ledger.ledger_current(ledger.read_log(spark, f"{tmp_path}/control"))
    bronze = {r.object_key[-9:]: (r.status, r.record_count) for r in state.filter("schema_name = 'dm_bronze'").collect()}
    assert bronze == {"le/1.json": ("success", 4), "le/2.json": ("success", 4), "3.json.gz"[-9:]: ("error", None), "le/4.json": ("success", 0)}
    silver = state.filter("schema_name = 'dm_silver'").collect()
    assert len(silver) == 2 and all(r.status == "pending" and r.file_size > 0 and r.checksum for r in silver)
    run_silver(spark, str(tmp_path), "profile", F.lit("2024-02-05").cast("timestamp"))
    assert spark.read.schema(ENTITIES["profile"].silver).parquet(f"{tmp_path}/silver/profile").count() == 8


def test_raw_to_bronze_takes_up_what_was_cut_short(spark, tmp_path):
    """An attempt died between starting its entry and finishing it: the stream repeats the batch and goes on with it."""
    add(tmp_path / "raw" / "brewery", "1.json", [json.dumps({"brewery_id": 1, "brewery_name": "A", "operation": "insert"})])
    at = F.lit("2024-02-01").cast("timestamp")
    log = f"{tmp_path}/control"
    fresh = ledger.register_files(ledger.read_log(spark, log), raw_listing(spark, str(tmp_path), "brewery"), at)
    ledger.append(fresh, log)
    ledger.append(ledger.start(ledger.read_log(spark, log), at), log)
    later = F.lit("2024-02-02").cast("timestamp")
    wait(stream_raw_to_bronze(spark, str(tmp_path), "brewery", str(tmp_path / "ckpt"), later, available_now=True))
    done = ledger.by_object_key(ledger.read_log(spark, log), "raw/brewery/1.json").first()
    assert (done.status, done.record_count, done.created_at.day) == ("success", 1, 1)


def test_silver_upsert(spark, tmp_path):
    schema = "brewery_id bigint, brewery_name string, operation string, ts timestamp"

    def run():
        changes = spark.readStream.schema(schema).json(str(tmp_path / "in")).withColumnRenamed("ts", CONTROL_TS)
        wait(
            stream_apply_cdc(
                changes, str(tmp_path / "silver"), BREWERY.silver, "brewery_id", str(tmp_path / "ckpt"), available_now=True
            )
        )

    def change(i, operation, hour, name="A"):
        return json.dumps({"brewery_id": i, "brewery_name": name, "operation": operation, "ts": f"2024-01-0{1 + hour // 24}T{hour % 24:02d}:00:00Z"})

    add(tmp_path / "in", "1.json", [change(1, "insert", 1), change(2, "insert", 2), change(1, "update", 30, "B")])
    run()
    add(tmp_path / "in", "2.json", [change(2, "delete", 31), change(1, "update", 5, "late")])
    run()
    run()
    state = spark.read.schema(BREWERY.silver).parquet(str(tmp_path / "silver"))
    rows = {r.brewery_id: (r.brewery_name, r.created_at.hour, r.deleted_at is not None, r.partitioned_at) for r in state.collect()}
    assert rows == {1: ("B", 1, False, "20240102"), 2: ("A", 2, True, "20240102")}

    # The stream repeats its last batch: neither the table nor its index is touched.
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "silver").rglob("*") if f.is_file()}
    last = max(int(f.name) for f in (tmp_path / "ckpt" / "commits").iterdir() if f.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "ckpt" / "commits" / name).unlink(missing_ok=True)
    run()
    assert before == {f: f.stat().st_mtime_ns for f in (tmp_path / "silver").rglob("*") if f.is_file()}
    assert state.filter(F.col("partitioned_at") == "20240101").count() == 0
