"""Raw files to marts through the ledger, day by day, against a full recomputation."""

from __future__ import annotations

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from sparge.contracts import ENTITIES, REVIEW_FLAT
from sparge.operators import ledger
from sparge.operators.marts import MARTS, build_mart
from sparge.plans.bronze import load_seed, raw_manifest, run_bronze
from sparge.plans.gold import append_days, mart_schema, refresh_mart, run_mart
from sparge.plans.silver import run_flat, run_silver
from sparge.session import scratch_path
from sparge.sources.manifest import content_checksums

MONTH = 2_678_400


def write(root, table, name, rows):
    folder = root / "raw" / table
    folder.mkdir(parents=True, exist_ok=True)
    if name.endswith(".csv.gz"):
        header = list(rows[0])
        lines = [",".join(header)] + [",".join("" if r[h] is None else str(r[h]) for h in header) for r in rows]
    else:
        lines = [json.dumps(r) for r in rows]
    (folder / name).write_bytes(gzip.compress(("\n".join(lines) + "\n").encode()))


def now(day, minute=0):
    return F.lit(f"2024-02-{day:02d} 06:{minute:02d}:00").cast("timestamp")


def review(i, operation="insert", month=0, rating=4.0, beer=1):
    return {
        "review_id": i, "brewery_id": 1, "beer_id": beer, "profile_id": i % 5 + 1, "review_overall": rating,
        "review_aroma": 3.0, "review_appearance": None, "review_palate": 2.5, "review_taste": 4.5,
        "review_time": 1_704_067_200 + month * MONTH, "operation": operation,
    }


def run_all(spark, root, day):
    for table in ("brewery", "beer", "profile", "review"):
        run_silver(spark, str(root), table, now(day, 1))
    run_flat(spark, str(root), now(day, 2))
    return {name: run_mart(spark, str(root), name, now(day, 3), min_reviews=1) for name in MARTS}


def contents(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def check_marts(spark, root):
    flat = spark.read.schema(REVIEW_FLAT).parquet(f"{root}/silver/review_flat")
    for name in MARTS:
        stored = spark.read.schema(mart_schema(name)).parquet(f"{root}/gold/{name}")
        assert contents(stored) == contents(build_mart(flat, name, 1)), name


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A lake after its first day."""
    root = tmp_path_factory.mktemp("lake")
    write(root, "brewery", "dm-batch-process-1.csv.gz", [{"brewery_id": 1, "brewery_name": "A"}, {"brewery_id": "x", "brewery_name": "B"}])
    write(root, "beer", "s-1.json.gz", [{"beer_id": b, "brewery_id": 9, "beer_name": f"beer {b}", "beer_style": "IPA" if b < 3 else "Stout", "beer_abv": None, "operation": "insert"} for b in (1, 2, 3)])
    write(root, "profile", "s-1.json.gz", [{"profile_id": p, "profile_name": f"Person {p}", "email": f"p{p}@example.com", "state": "WA" if p < 3 else "OR", "operation": "insert"} for p in range(1, 6)])
    write(root, "review", "s-1.json.gz", [review(i, month=i % 3, rating=float(i % 5), beer=i % 4 + 1) for i in range(40)])
    counts = {}
    for table in ("brewery", "beer", "profile", "review"):
        counts[table] = run_bronze(spark, str(root), table, now(1))
    return root, counts, run_all(spark, root, 1)


def test_first_day(spark, lake):
    root, counts, months = lake
    assert counts["brewery"] == {"files": 1, "valid": 1, "rejected": 1}
    assert counts["review"] == {"files": 1, "valid": 40, "rejected": 0}
    assert months["top_drinkers"] == [(2024, 1), (2024, 2), (2024, 3)]
    bad = spark.read.json(f"{root}/rejected/brewery").first()
    assert bad.brewery_id == "x" and bad.reasons[0].reason == "invalid_long"
    profile = spark.read.schema(ENTITIES["profile"].silver).parquet(f"{root}/silver/profile").orderBy("profile_id").first()
    assert profile.email == "p" + "*" * 12 + "m" and profile.profile_name == "Person 1"
    flat = spark.read.schema(REVIEW_FLAT).parquet(f"{root}/silver/review_flat")
    assert flat.count() == 40
    assert flat.filter("beer_id = 4").select("beer_name").distinct().collect() == [(None,)]
    assert {r.brewery_name for r in flat.select("brewery_name").distinct().collect()} == {"A"}
    log = ledger.ledger_current(ledger.read_log(spark, f"{root}/control"))
    assert {r.status for r in log.select("status").distinct().collect()} == {"success"}
    check_marts(spark, root)


def test_nothing_to_do_changes_nothing(spark, lake):
    root, _, _ = lake
    before = ledger.read_log(spark, f"{root}/control").count()
    assert run_bronze(spark, str(root), "review", now(1, 9))["files"] == 0
    assert run_silver(spark, str(root), "review", now(1, 9)) == []
    assert run_flat(spark, str(root), now(1, 9)) == []
    assert run_mart(spark, str(root), "top_drinkers", now(1, 9)) == []
    assert ledger.read_log(spark, f"{root}/control").count() == before


def test_second_and_third_day(spark, lake):
    root, _, _ = lake
    random.seed(3)
    changed = [review(i, "update", month=5, rating=1.0) for i in range(0, 40, 3)]  # leave their months
    deleted = [review(i, "delete", month=i % 3) for i in range(1, 40, 9)]
    fresh = [review(i, month=1) for i in range(100, 110)]
    write(root, "review", "s-2.json.gz", changed + deleted + fresh + [review(100, "update", month=2, rating=5.0)])
    assert run_bronze(spark, str(root), "review", now(2))["valid"] == len(changed) + len(deleted) + 11
    run_all(spark, root, 2)
    check_marts(spark, root)
    silver = spark.read.schema(ENTITIES["review"].silver).parquet(f"{root}/silver/review")
    assert silver.count() == silver.select("review_id").distinct().count() == 50
    assert silver.filter("deleted_at IS NOT NULL").count() == len(deleted)
    assert silver.filter("review_id = 100").first().review_overall == 5.0  # the later line of the file
    assert {r.partitioned_at for r in silver.select("partitioned_at").distinct().collect()} == {"20240201", "20240202"}
    assert silver.filter("review_id = 0").first().created_at.day == 1

    # Everything left of day one moves on: its partitions and months must not keep stale rows.
    write(root, "review", "s-3.json.gz", [review(i, "update", month=7) for i in range(40)])
    run_bronze(spark, str(root), "review", now(3))
    months = run_all(spark, root, 3)
    check_marts(spark, root)
    silver = spark.read.schema(ENTITIES["review"].silver).parquet(f"{root}/silver/review")
    assert silver.count() == 50 and silver.filter("partitioned_at = '20240201'").count() == 0
    assert (2024, 1) in months["top_drinkers"]
    assert spark.read.schema(mart_schema("top_drinkers")).parquet(f"{root}/gold/top_drinkers").filter("review_month = 1").count() == 0


def test_failure_is_recorded_and_retried(spark, tmp_path):
    write(tmp_path, "brewery", "s-1.json.gz", [{"brewery_id": 1, "brewery_name": "A", "operation": "insert"}])
    assert run_bronze(spark, str(tmp_path), "brewery", now(1), mask=["no_such_column"])["files"] == 0
    log = ledger.read_log(spark, f"{tmp_path}/control")
    current = ledger.ledger_current(log).first()
    assert (current.status, current.attempt_count) == ("error", 1) and current.error_message
    assert run_bronze(spark, str(tmp_path), "brewery", now(1, 5), mask=None)["valid"] == 1
    done = ledger.by_object_key(ledger.read_log(spark, f"{tmp_path}/control"), "raw/brewery/s-1.json.gz").first()
    assert (done.status, done.attempt_count, done.error_message) == ("success", 2, None)


def silver_rows(spark, root, table):
    run_silver(spark, str(root), table, now(1, 8))
    return spark.read.schema(ENTITIES[table].silver).parquet(f"{root}/silver/{table}")


def bronze_folder(root, table="brewery"):
    return f"{root}/bronze/{table}"


def brewery(i, name, operation="insert"):
    return {"brewery_id": i, "brewery_name": name, "operation": operation}


def test_each_file_is_read_in_its_format(spark, tmp_path):
    write(tmp_path, "brewery", "dm-batch-process-1.csv.gz", [{"brewery_id": i, "brewery_name": f"c{i}"} for i in range(5)])
    write(tmp_path, "brewery", "s-1.json.gz", [brewery(i, f"j{i}") for i in range(5, 9)])
    assert run_bronze(spark, str(tmp_path), "brewery", now(1)) == {"files": 2, "valid": 9, "rejected": 0}
    assert {r.brewery_name for r in silver_rows(spark, tmp_path, "brewery").collect()} == {*(f"c{i}" for i in range(5)), *(f"j{i}" for i in range(5, 9))}
    counts = {r.object_key: r.record_count for r in ledger.ledger_current(ledger.read_log(spark, f"{tmp_path}/control")).filter("schema_name = 'dm_bronze'").collect()}
    assert counts == {"raw/brewery/dm-batch-process-1.csv.gz": 5, "raw/brewery/s-1.json.gz": 4}


@pytest.mark.parametrize("larger", ["older", "newer"])
def test_the_newer_file_wins_whatever_its_size(spark, tmp_path, larger):
    import os

    filler = [brewery(i, f"filler {i}") for i in range(100, 3000)]
    older, newer = [brewery(1, "first"), brewery(1, "old", "update")], [brewery(1, "mid", "update"), brewery(1, "new", "update")]
    for name, rows, at in (("s-b.json.gz", older, 1_700_000_000), ("s-a.json.gz", newer, 1_700_000_300)):
        write(tmp_path, "brewery", name, rows + (filler if (larger == "older") == (rows is older) else []))
        os.utime(tmp_path / "raw" / "brewery" / name, (at, at))
    run_bronze(spark, str(tmp_path), "brewery", now(1))
    assert silver_rows(spark, tmp_path, "brewery").filter("brewery_id = 1").first().brewery_name == "new"


def test_one_bad_file_does_not_hold_up_the_others(spark, tmp_path):
    for i in range(4):
        write(tmp_path, "brewery", f"s-{i}.json.gz", [brewery(i, f"n{i}")])
    (tmp_path / "raw" / "brewery" / "s-2.json.gz").write_bytes(b"\x1f\x8b broken")
    for attempt in range(4):
        run_bronze(spark, str(tmp_path), "brewery", now(1, attempt))
    state = {r.object_key: (r.status, r.attempt_count) for r in ledger.ledger_current(ledger.read_log(spark, f"{tmp_path}/control")).filter("schema_name = 'dm_bronze'").collect()}
    assert state.pop("raw/brewery/s-2.json.gz") == ("error", 3)
    assert set(state.values()) == {("success", 1)} and len(state) == 3
    assert silver_rows(spark, tmp_path, "brewery").count() == 3


def test_a_retry_replaces_what_an_attempt_wrote(spark, tmp_path, monkeypatch):
    from sparge.plans import bronze

    write(tmp_path, "brewery", "s-1.json.gz", [brewery(1, "A"), brewery("x", "B")])
    with monkeypatch.context() as crash:
        crash.setattr(bronze, "bronze_entries", lambda *a: 1 / 0)
        assert run_bronze(spark, str(tmp_path), "brewery", now(1))["files"] == 0
    assert run_bronze(spark, str(tmp_path), "brewery", now(2)) == {"files": 1, "valid": 1, "rejected": 1}
    assert spark.read.parquet(bronze_folder(tmp_path)).count() == 1
    assert spark.read.json(f"{tmp_path}/rejected/brewery").count() == 1


def test_only_new_files_are_read(spark, tmp_path):
    for i in range(6):
        write(tmp_path, "brewery", f"s-{i}.json.gz", [brewery(i, f"n{i}")])
    run_bronze(spark, str(tmp_path), "brewery", now(1))
    for f in (tmp_path / "raw" / "brewery").iterdir():
        f.write_bytes(b"\x1f\x8b broken since")  # would fail any read
    write(tmp_path, "brewery", "s-new.json.gz", [brewery(99, "new")])
    assert run_bronze(spark, str(tmp_path), "brewery", now(2)) == {"files": 1, "valid": 1, "rejected": 0}
    entries = ledger.ledger_current(ledger.read_log(spark, f"{tmp_path}/control"))
    assert entries.filter("status = 'error'").count() == 0 and entries.filter("schema_name = 'dm_silver'").count() == 7


def test_files_beyond_one_round(spark, tmp_path):
    for i in range(3):
        write(tmp_path, "brewery", f"s-{i}.json.gz", [brewery(i, f"n{i}")])
    assert run_bronze(spark, str(tmp_path), "brewery", now(1), round_files=2)["files"] == 3


def test_unknown_operations_are_rejected_and_counted(spark, tmp_path):
    write(tmp_path, "brewery", "s-1.json.gz", [brewery(1, "A"), brewery(2, "B", "load"), brewery(3, "C", "")])
    assert run_bronze(spark, str(tmp_path), "brewery", now(1)) == {"files": 1, "valid": 1, "rejected": 2}
    reasons = {r.brewery_id: [x.reason for x in r.reasons] for r in spark.read.json(f"{tmp_path}/rejected/brewery").collect()}
    assert reasons == {"2": ["unknown_operation"], "3": ["missing_value"]}


def test_personal_data_in_the_last_row_only_does_not_hide(spark, tmp_path):
    people = [{"profile_id": i, "profile_name": f"P {i}", "email": "unknown" if i < 10 else f"p{i}@example.com", "state": "WA", "operation": "insert"} for i in range(500)]
    write(tmp_path, "profile", "s-1.json.gz", people)
    run_bronze(spark, str(tmp_path), "profile", now(1))
    assert spark.read.parquet(bronze_folder(tmp_path, "profile")).filter("email LIKE '%@%'").count() == 0


def test_work_registered_while_a_day_runs_is_not_hidden(spark):
    day = spark.createDataFrame([("20240201", 3)], "day string, record_count bigint")
    first = ledger.day_entries(day, now(1))
    running = ledger.start(first, now(1, 1))
    again = ledger.day_entries(day, now(1, 2))
    log = first.unionByName(running).unionByName(again).unionByName(ledger.finish(running, now(1, 3)))
    assert [r.status for r in ledger.eligible(log).collect()] == ["pending"]


def test_append_mode_has_partial_rows(spark, lake, tmp_path):
    root, _, _ = lake
    flat_path = f"{root}/silver/review_flat"
    flat = spark.read.schema(REVIEW_FLAT).parquet(flat_path)
    days = sorted(r.partitioned_at for r in flat.select("partitioned_at").distinct().collect())
    for day in days:
        append_days(spark, flat_path, "state_by_review_volume", f"{tmp_path}/mart", [day])
    appended = spark.read.schema(mart_schema("state_by_review_volume")).parquet(f"{tmp_path}/mart")
    parts = sum(build_mart(flat.filter(F.col("partitioned_at") == d), "state_by_review_volume").count() for d in days)
    assert appended.count() == parts
    assert refresh_mart(spark, flat, "state_by_review_volume", f"{tmp_path}/fresh", days)


def test_manifest(spark, tmp_path):
    import hashlib

    text = 'brewery_id,brewery_name\n1,"A\nB"\n2,C\n'
    folder = tmp_path / "raw" / "brewery"
    folder.mkdir(parents=True)
    two_members = gzip.compress(text[:20].encode()) + gzip.compress(text[20:].encode())
    (folder / "dm-batch-process-1.csv.gz").write_bytes(gzip.compress(text.encode()))
    (folder / "dm-batch-process-2.csv.gz").write_bytes(two_members)
    (folder / "plain.csv").write_text(text)
    rows = {r.object_key: r for r in raw_manifest(spark, str(tmp_path), "brewery", "csv", checksums=True).collect()}
    assert {r.record_count for r in rows.values()} == {2}
    assert {r.checksum for r in rows.values()} == {hashlib.sha256(text.encode()).hexdigest()}
    assert rows["raw/brewery/dm-batch-process-2.csv.gz"].file_size == len(two_members)
    prints = {r.checksum for r in raw_manifest(spark, str(tmp_path), "brewery", "csv").collect()}
    assert len(prints) == 1
    by_row = sorted(map(tuple, content_checksums(spark, str(folder)).collect()))
    assert hashlib.sha256(two_members).hexdigest() in {stored for _, _, stored, _ in by_row}
    assert sorted(map(tuple, content_checksums(spark, str(folder), max_row_bytes=0).collect())) == by_row


def test_seed(spark, tmp_path):
    write(tmp_path, "brewery", "seed.csv.gz", [{"brewery_id": 1, "brewery_name": " A "}, {"brewery_id": "", "brewery_name": "B"}])
    assert [tuple(r) for r in load_seed(spark, " Brewery ", str(tmp_path / "raw" / "brewery"))[0].collect()] == [(1, "A")]


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
