from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparge.contracts import columns
from sparge.session import empty_frame, scratch_path
from sparge.sinks import files as sinks
from sparge.sources.catalog import add_partition, register_external
from sparge.sources.files import read_partitions, read_table

DAYS = columns("id bigint, day string")
MONTHS = columns("k bigint, n bigint, review_year int, review_month int")


def frame(spark, rows):
    return spark.createDataFrame(rows, DAYS)


def read(spark, path):
    return sorted(map(tuple, spark.read.schema(DAYS).parquet(path).collect()), key=str)


def files(df):
    return {r.p for r in df.select(F.col("_metadata.file_path").alias("p")).distinct().collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_empty_input_is_an_error(spark):
    with pytest.raises(sinks.EmptyInputError):
        sinks.write_parquet(empty_frame(spark, DAYS), scratch_path(spark, "x"))


def test_parquet_is_snappy(spark):
    path = scratch_path(spark, "x")
    sinks.write_parquet(frame(spark, [(1, "a")]), path)
    assert all(f.endswith(".snappy.parquet") for f in spark.read.parquet(path).inputFiles())


def test_overwrite_keeps_other_partitions(spark):
    path = scratch_path(spark, "x")
    sinks.append_partitioned(frame(spark, [(1, "20240101"), (2, "20240102")]), path, "day")
    sinks.append_partitioned(frame(spark, [(3, "20240101")]), path, "day")
    sinks.overwrite_partitions(frame(spark, [(9, "20240102")]), path, "day")
    assert read(spark, path) == [(1, "20240101"), (3, "20240101"), (9, "20240102")]


def test_replace_empties_touched_partitions(spark):
    path = scratch_path(spark, "x")
    sinks.append_partitioned(frame(spark, [(1, "a"), (2, "b"), (3, None)]), path, "day")
    kept = spark.read.schema(DAYS).parquet(path).filter("day = 'b'")  # reads what it replaces
    sinks.replace_partitions(spark, kept, path, [("a",), ("b",), (None,), ("never",)], "day")
    assert read(spark, path) == [(2, "b")]


def test_partition_values_stay_text_and_prune(spark):
    path = scratch_path(spark, "x")
    sinks.append_partitioned(frame(spark, [(1, "20240101"), (2, "20240102")]), path, "day")
    chosen = read_partitions(spark, path, ["20240102"], DAYS, "day")
    assert [tuple(r) for r in chosen.collect()] == [(2, "20240102")]
    assert "PartitionFilters: [(day#" in plan(chosen) or "PartitionFilters: [isnotnull(day#" in plan(chosen)
    assert len(files(chosen)) == 1


def test_publish_modes(spark):
    path = scratch_path(spark, "mart")
    sinks.publish_mart(spark.createDataFrame([(1, 5, 2024, 1), (1, 6, 2024, 2)], MONTHS), path)
    sinks.publish_mart(spark.createDataFrame([(1, 7, 2024, 2)], MONTHS), path)
    table = spark.read.schema(MONTHS).parquet(path)
    assert sorted(map(tuple, table.collect())) == [(1, 5, 2024, 1), (1, 7, 2024, 2)]
    sinks.publish_mart(spark.createDataFrame([(1, 8, 2024, 2)], MONTHS), path, mode="append")
    assert spark.read.schema(MONTHS).parquet(path).count() == 3
    with pytest.raises(ValueError):
        sinks.publish_mart(table, path, mode="upsert")


def test_compact_leaves_one_file_per_small_day(spark):
    path = scratch_path(spark, "x")
    for n in range(6):
        rows = spark.range(n * 100, n * 100 + 100).withColumn("day", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
        rows.write.mode("append").partitionBy("day").parquet(path)
    before = spark.read.schema(DAYS).parquet(path)
    assert len(files(before)) > 12
    sinks.compact(spark, path, DAYS, "day")
    after = spark.read.schema(DAYS).parquet(path)
    assert len(files(after)) == 2
    assert after.count() == 600 and after.distinct().count() == 600


def test_compact_splits_a_large_day(spark):
    path = scratch_path(spark, "x")
    rows = spark.range(0, 400_000, numPartitions=8).select("id", F.when(F.col("id") < 390_000, "hot").otherwise("cold").alias("day"))
    rows.withColumn("id", F.xxhash64("id")).write.partitionBy("day").parquet(path)
    sinks.compact(spark, path, DAYS, "day", target_mb=1)
    after = spark.read.schema(DAYS).parquet(path)
    assert after.count() == 400_000
    assert len(files(after.filter("day = 'hot'"))) > 1


def test_compact_only_named_days(spark):
    path = scratch_path(spark, "x")
    for n in range(3):
        frame(spark, [(n, "a"), (n, "b")]).write.mode("append").partitionBy("day").parquet(path)
    sinks.compact(spark, path, DAYS, "day", values=["a"])
    table = spark.read.schema(DAYS).parquet(path)
    assert len(files(table.filter("day = 'a'"))) == 1
    assert len(files(table.filter("day = 'b'"))) == 3


def test_external_table(spark):
    path = scratch_path(spark, "x")
    sinks.append_partitioned(frame(spark, [(1, "20240101")]), path, "day")
    register_external(spark, "daily_rows", DAYS, path, ("day",))
    try:
        assert [tuple(r) for r in read_table(spark, "daily_rows").collect()] == [(1, "20240101")]
        sinks.append_partitioned(frame(spark, [(2, "20240102")]), path, "day")
        add_partition(spark, "daily_rows", day="20240102")
        spark.catalog.refreshTable("daily_rows")
        assert read_table(spark, "daily_rows").filter("day = '20240102'").count() == 1
    finally:
        spark.sql("DROP TABLE daily_rows")
