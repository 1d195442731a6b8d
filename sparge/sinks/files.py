"""Parquet writers and partition maintenance."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from sparge.session import advisory_size, remove, staged


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class EmptyInputError(ValueError):
    """Raised instead of writing a dataset without rows."""


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Snappy Parquet; an input without rows is an error.

    Rows are counted as they are written, so the input runs once. Nothing stays behind
    where a new folder was to be made; in other modes the write has happened.
    """
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.mode(mode).option("compression", "snappy").parquet(path)
    if not rows.get["n"]:
        if mode == "errorifexists":
            remove(df.sparkSession, path)
        raise EmptyInputError(f"nothing to write to {path}")


def write_bronze(
    df: DataFrame, path: str, created_at: Column, mode: str = "append", file: Column | None = None,
    drop: Iterable[str] = (),
) -> None:
    """Bronze layout `year=YYYY/month=MM/day=DD` by the ledger's `created_at`.

    With `file`, the base name of each row's raw file, that is a folder of its own below
    the day, and what an earlier attempt wrote for the same file is replaced. Columns of
    `drop` serve those two and are not written.
    """
    parts = {
        "year": F.date_format(created_at, "yyyy"),
        "month": F.date_format(created_at, "MM"),
        "day": F.date_format(created_at, "dd"),
    }
    if file is not None:
        parts["file"] = file
    writer = df.withColumns(parts).drop(*drop).write
    if file is not None:
        mode, writer = "overwrite", writer.option("partitionOverwriteMode", "dynamic")
    writer.mode(mode).partitionBy(*parts).option("compression", "snappy").parquet(path)


def append_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    _balanced(df, columns).write.mode("append").partitionBy(*columns).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace exactly the partitions that `df` has rows for."""
    (
        _balanced(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def replace_partitions(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    touched: Iterable[tuple],
    *columns: str,
    filled: Iterable[tuple] | None = None,
) -> None:
    """Replace all `touched` partitions by the rows of `df`, also those left without rows.

    `df` may read from `path`: it is staged first, so the overwrite reads only
    staged files and can be repeated after a failure. Where `df` reads other tables
    alone and the partitions it has rows for are known, pass them as `filled`: then
    it is written straight away.
    """
    touched = set(touched)
    if filled is not None:
        filled = set(filled) & touched
        _replace(spark, df, path, touched, filled, columns)
        return
    with staged(df, "replace", *columns) as rows:
        filled = {tuple(row) for row in rows.select(*columns).distinct().toLocalIterator()}
        _replace(spark, rows, path, touched, filled, columns)


def _replace(
    spark: SparkSession, df: DataFrame, path: str, touched: set[tuple], filled: set[tuple], columns: Iterable[str]
) -> None:
    if filled:
        overwrite_partitions(df, path, *columns)
    for values in sorted(touched - filled, key=str):
        clear_partition(spark, path, dict(zip(columns, values)))


def clear_partition(spark: SparkSession, path: str, values: dict[str, object]) -> None:
    """Remove one partition; a dynamic overwrite never does that by itself."""
    remove(spark, "/".join([path.rstrip("/"), *(f"{n}={NULL_PARTITION if v is None else v}" for n, v in values.items())]))


def publish_mart(df: DataFrame, path: str, mode: str = "replace") -> None:
    """Write a mart by month: `replace` swaps the months present, `append` adds to them."""
    if mode == "append":
        append_partitioned(df, path, "review_year", "review_month")
    elif mode == "replace":
        overwrite_partitions(df, path, "review_year", "review_month")
    else:
        raise ValueError(f"unknown mode: {mode}")


def publish_ordered(df: DataFrame, path: str, *order: str | Column) -> None:
    """Write `df` in global order: by range, sorted within each file, so files follow each other by their number.

    Ranges are sampled, which reads the rows once more; they are staged for that. No task sees more than its range, and
    nothing is sorted in one place. Order columns have to tell all rows apart.
    """
    spark = df.sparkSession
    with staged(df, "ordered") as rows:
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, schema: T.StructType, rank: str = "rank") -> DataFrame:
    """Rows of `publish_ordered` with their place in the whole, from 1, told by file and row number alone.

    Only the number of rows of each file is collected, from the footers; no row is compared with another one.
    """
    name = F.col("_metadata.file_name")
    rows = spark.read.schema(schema).parquet(path)
    counts = sorted(map(tuple, rows.groupBy(name.alias("file")).count().collect()))
    before, at = [], 0
    for file, count in counts:
        before.append((file, at))
        at += count
    base = spark.createDataFrame(before, "_file string, _before bigint")
    placed = rows.withColumns({"_file": name, "_row": F.col("_metadata.row_index")}).join(base, "_file")
    return placed.select(*schema.names, (F.col("_before") + F.col("_row") + 1).alias(rank))


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    column: str,
    values: Iterable[str] | None = None,
    target_mb: int = 128,
) -> None:
    """Rewrite partitions into one file each, or several of about `target_mb` where they are larger.

    Rows of one partition value meet in one task, unless the value is large: then
    the rebalance splits it.
    """
    table = spark.read.schema(schema).parquet(path)
    if values is not None:
        table = table.filter(F.col(column).isin(sorted(values)))
    with advisory_size(spark, target_mb), staged(_balanced(table, (column,)), "compact", column) as rows:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def _balanced(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in columns])
