"""Index of a partitioned table: for each key its partition, creation time and version.

Kept below `_keys` in the table's folder, in buckets by key hash. A merge appends the keys it changed, under its number;
the entry of the last merge counts. When the appended entries outgrow the keys, the index is written anew as the next generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sparge.session import child_names, path_exists, remove
from sparge.sinks.swap import NULL_PARTITION

FOLDER = "_keys"
BUCKETS = 64
# Appended merges after which the index is written anew.
APPENDED = 50


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _generations(spark: SparkSession, path: str) -> list[int]:
    """Complete generations, oldest first."""
    names = [n for n in child_names(spark, f"{path}/{FOLDER}") if n.startswith("gen=")]
    whole = [n for n in names if path_exists(spark, f"{path}/{FOLDER}/{n}/_SUCCESS")]
    return sorted(int(n.removeprefix("gen=")) for n in whole)


def entries(rows: DataFrame, key: str, number: int) -> DataFrame:
    """Index rows of table rows that carry their `_version`, put there by the merge of this number."""
    day = F.coalesce("partitioned_at", F.lit(NULL_PARTITION)).alias("partitioned_at")
    return rows.select(key, day, "created_at", "_version", F.lit(number).cast("bigint").alias("_merge_no"), _bucket(key).alias("bucket"))


def start(spark: SparkSession, path: str, key: str, rows: DataFrame) -> None:
    """First generation, from all rows of the table (with their versions)."""
    _write(entries(rows, key, 0), f"{path}/{FOLDER}/gen=0", "overwrite")


def _write(rows: DataFrame, path: str, mode: str) -> None:
    rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket").write.mode(mode).partitionBy("bucket").parquet(path)


def append(spark: SparkSession, path: str, key: str, rows: DataFrame) -> None:
    """Entries of a merge. Appending them twice changes nothing."""
    found = _generations(spark, path)
    place = f"{path}/{FOLDER}/gen={found[-1]}"
    _write(rows, place, "append")
    merges = max((len(child_names(spark, f"{place}/bucket={b}")) for b in range(BUCKETS)), default=0)
    if merges > APPENDED:
        now = spark.read.parquet(place)
        _write(_newest(now, key).withColumn("bucket", _bucket(key)), f"{path}/{FOLDER}/gen={found[-1] + 1}", "overwrite")
        found.append(found[-1] + 1)
    for old in found[:-1]:
        remove(spark, f"{path}/{FOLDER}/gen={old}")


def _newest(rows: DataFrame, key: str) -> DataFrame:
    last = F.max_by(F.struct("partitioned_at", "created_at", "_version", "_merge_no"), "_merge_no")
    return rows.groupBy(key).agg(last.alias("_last")).select(key, "_last.*")


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_generations(spark, path))


def lookup(spark: SparkSession, path: str, key: str, changes: DataFrame) -> DataFrame:
    """Changed keys that the table has: key, `_known_day`, `_known_created`, `_known_version`.

    Buckets without a changed key are not opened; of the others only the index columns are read, never the table.
    """
    wanted = [r["bucket"] for r in changes.select(_bucket(key).alias("bucket")).distinct().collect()]  # at most BUCKETS
    shape = T.StructType(
        [changes.schema[key], T.StructField("partitioned_at", T.StringType()), T.StructField("created_at", T.TimestampType()),
         changes.schema["_version"], T.StructField("_merge_no", T.LongType()), T.StructField("bucket", T.IntegerType())]
    )
    place = f"{path}/{FOLDER}/gen={_generations(spark, path)[-1]}"
    stored = spark.read.schema(shape).parquet(place).filter(F.col("bucket").isin(wanted))
    known = stored.join(changes.select(key), key, "left_semi")
    return _newest(known, key).select(
        key, F.col("partitioned_at").alias("_known_day"), F.col("created_at").alias("_known_created"),
        F.col("_version").alias("_known_version"),
    )


def version_of_rows(rows: DataFrame, version: T.StructType) -> DataFrame:
    """Rows of a table that had no index, with their update time as version."""
    first, *rest = version.fields
    fields = [F.col("updated_at").cast(first.dataType).alias(first.name), *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest]]
    return rows.withColumn("_version", F.struct(*fields))
