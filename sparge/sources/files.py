"""Batch readers for raw files and lake tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sparge.contracts import EVENT_TIME
from sparge.session import empty_frame, path_exists

CORRUPT = "_corrupt_record"


def _csv_reader(spark: SparkSession):
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", True)
    )


def read_csv_gz(spark: SparkSession, path: str | list[str], schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """Typed read of gzip CSV with a header.

    A gzip file is one task, so parallelism comes from the number of files.
    Headers are checked against the schema rather than ignored.
    """
    return _csv_reader(spark).option("mode", mode).schema(schema).csv(path)


def read_csv_split(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Typed read of few large gzip CSV files, parsed by all cores.

    One task can only inflate a gzip file; its lines are then spread over the
    cluster and parsed there. That costs a shuffle of the text, which pays while
    there are fewer files than cores. Lines are the unit, so columns must be ones
    that cannot hold a line break. Each file's first line is its header; lines are
    dealt out by their number, so one that occurs often does not gather anywhere.
    """
    if any(isinstance(f.dataType, T.StringType) for f in schema.fields):
        raise ValueError("text columns may hold line breaks; use read_csv_gz")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    # One column that no separator or quote divides: the reader takes off the header and leaves the lines whole.
    lines = (
        spark.read.option("header", True)
        .option("enforceSchema", True)
        .option("sep", "\x01")
        .option("quote", "")
        .schema("value string")
        .csv(path)
    )
    # Dealt by their number, so without the sort that dealing in turn needs to be repeatable.
    spread = lines.repartition(spark.sparkContext.defaultParallelism, F.monotonically_increasing_id())
    return spread.select(F.from_csv("value", ddl, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def read_csv_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text plus `_corrupt_record`, for `operators.validate`.

    Columns are named by the header, so their order is free; the files of one call
    must agree on it, or the read fails. Column pruning is off because a pruned
    parser does not notice short or long rows.
    """
    names = spark.read.option("header", True).csv(path if isinstance(path, str) else path[0]).columns
    schema = T.StructType([T.StructField(n.strip(), T.StringType()) for n in (*names, CORRUPT)])
    return (
        _csv_reader(spark)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .schema(schema)
        .csv(path)
    )


def read_json_gz(spark: SparkSession, path: str | list[str], schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """Typed read of gzip JSON, one object per line."""
    return spark.read.option("mode", mode).schema(schema).json(path)


def read_json_raw(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON fields as text, the envelope's time and `_corrupt_record`, for `operators.validate`."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in (*schema.names, EVENT_TIME, CORRUPT)])
    return (
        spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(text).json(path)
    )


def read_table(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path with its contract.

    Passing the contract keeps partition values such as `20250801` text; inferred,
    they would become numbers.
    """
    if "/" not in source:
        return spark.read.table(source)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(source)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return empty_frame(spark, schema)


def read_partitions(
    spark: SparkSession, source: str, days: Iterable[str], schema: T.StructType, column: str = "partitioned_at"
) -> DataFrame:
    """Only the named partitions; the filter prunes folders before any file is opened."""
    return read_table(spark, source, schema).filter(F.col(column).isin(sorted(days)))


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`(object_path, file_size, modified_at)` of all files below a folder or several; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("path").alias("object_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at")
    )


def with_raw_order(raw: DataFrame, root: str) -> DataFrame:
    """Adds each raw row's time, file time, key, block and place, in which order it is newer than others.

    `raw` must be a file scan. Rows of one block are numbered as they are read. A row has the time of its envelope, if
    it names one that is a time, else that of its file: copying an old file again makes no change newer.
    """
    file_time = F.col("_metadata.file_modification_time")
    made = F.coalesce(F.try_to_timestamp(EVENT_TIME), file_time) if EVENT_TIME in raw.columns else file_time
    return raw.withColumns(
        {
            EVENT_TIME: made,
            "_raw_time": F.col("_metadata.file_modification_time"),
            "_raw_key": key_of_path(F.col("_metadata.file_path"), root),
            "_raw_block": F.col("_metadata.file_block_start"),
            "_raw_row": F.monotonically_increasing_id(),
        }
    )


def key_of_path(path: Column, root: str) -> Column:
    """Key of a file relative to the lake root, whatever scheme its path is written with."""
    local_root = root.rstrip("/").split("://", 1)[-1].removeprefix("file:")
    return F.substring_index(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), f"{local_root}/", -1)


def read_batch(spark: SparkSession, root: str, entries: DataFrame, schema: T.StructType) -> DataFrame:
    """All bronze files of a ledger batch in one scan.

    `entries` holds `object_key` (relative to `root`, all of one table) and `created_at`.
    Each row gets its file's time as `_control_ts`, and its place in the batch as
    `_position`. The scan is narrowed to the days of the batch, whose number is small;
    the files are then selected by a join on their keys, so no list of keys is
    collected.
    """
    root = root.rstrip("/")
    day = F.regexp_extract("object_key", r"^(.*/year=[0-9]+/month=[0-9]+/day=[0-9]+)/", 1)
    days = [row.day for row in entries.select(day.alias("day")).distinct().collect()]
    if not days:
        raise ValueError("the batch has no files")
    folders = [f"{root}/{d}" for d in sorted(days)]
    files = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)
    key_of_file = key_of_path(F.col("_metadata.file_path"), root)
    position = F.struct(key_of_file.alias("file"), F.col("_metadata.row_index").alias("row"))
    stamps = entries.groupBy(F.col("object_key").alias("_key")).agg(F.max("created_at").alias("_control_ts"))
    # An entry names a file, or the folder that holds the rows of one raw file.
    placed = files.withColumns({"_file": key_of_file, "_position": position})
    folder = F.regexp_replace("_file", "/[^/]*$", "")
    placed = placed.withColumn("_key", F.when(folder.contains("/file="), folder).otherwise(F.col("_file")))
    return placed.join(stamps, "_key").drop("_key", "_file")


def read_costs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Cost table partitioned by `billing_period` (folder name in any case)."""
    return spark.read.schema(schema).parquet(path)
