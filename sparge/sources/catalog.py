"""Registration of partitioned Parquet folders as catalog tables."""

from __future__ import annotations

from pyspark.sql import SparkSession, types as T


def register_external(
    spark: SparkSession, table: str, schema: T.StructType, path: str, partition_by: tuple[str, ...] = ()
) -> None:
    """Create the table over `path` if it is new, and pick up the partitions found there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {partitions} LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(table)


def add_partition(spark: SparkSession, table: str, location: str | None = None, **values: str) -> None:
    """Make a partition known, at `location` or, without one, in the table's own folder."""
    quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spec = ", ".join(f"{name} = {quoted(value)}" for name, value in values.items())
    place = f" LOCATION {quoted(location)}" if location else ""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}){place}")
