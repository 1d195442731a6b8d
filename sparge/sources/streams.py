"""Change-stream source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_cdc_stream(spark: SparkSession, source: str, fmt: str = "text", **options: str) -> DataFrame:
    """Stream of `value string` envelopes.

    A folder of line-delimited files by default; any connector that gives a
    `value` column (for example Kafka) works through `fmt` and `options`.
    """
    stream = spark.readStream.format(fmt).options(**options)
    if fmt == "text":
        return stream.schema("value string").load(source)
    return stream.load(source) if source else stream.load()
