"""Per-file facts of a raw folder: records, lines, size, checksums."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Up to this size a file's stored bytes travel in one row; Spark's own limit is 2 GiB.
MAX_ROW_BYTES = 256 << 20


def file_manifest(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """One row per file: `object_path, record_count, line_count, file_size, fingerprint`.

    Files are read once as lines and aggregated per file with map-side partial
    aggregation. The fingerprint is a sum of line hashes, so it does not depend on
    how a file was split. For CSV, records are parsed records without the header:
    a quoted field may span lines.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    hashed = F.xxhash64("value")  # summed as two halves, which stay within 64 bits
    per_file = lines.groupBy(
        F.col("_metadata.file_path").alias("object_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(
        F.count("*").alias("line_count"),
        F.count_if(F.btrim("value") != "").alias("record_count"),
        F.sum(hashed.bitwiseAND(F.lit(0xFFFFFFFF))).alias("_low"),
        F.sum(F.shiftrightunsigned(hashed, 32)).alias("_high"),
    ).withColumn("fingerprint", F.concat_ws("-", F.hex("_high"), F.hex("_low"))).drop("_low", "_high")
    if fmt != "csv":
        return per_file.select("object_path", "record_count", "line_count", "file_size", "fingerprint")
    parsed = (
        spark.read.option("recursiveFileLookup", True)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .schema("first_column string")
        .csv(path)
        .groupBy(F.col("_metadata.file_path").alias("object_path"))
        .agg(F.count("*").alias("record_count"))
    )
    return per_file.drop("record_count").join(parsed, "object_path", "left").select(
        "object_path", F.coalesce("record_count", F.lit(0)).alias("record_count"), "line_count", "file_size", "fingerprint"
    )


def content_checksums(spark: SparkSession, path: str, max_row_bytes: int = MAX_ROW_BYTES) -> DataFrame:
    """SHA-256 of each file's stored bytes and of its uncompressed content.

    A digest needs the bytes of a file in order, so each file is the work of one task.
    Files above `max_row_bytes` are read as a stream inside the task instead of
    as one row.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    small = files.filter(F.col("length") <= max_row_bytes).withColumn("digest", _digests(F.col("content")))
    large = files.filter(F.col("length") > max_row_bytes).select("path", "length")
    # Few rows, each much work: one task per file.
    large = large.repartition(spark.sparkContext.defaultParallelism, "path").withColumn("digest", _digests(F.col("path")))
    both = small.select("path", "length", "digest").unionByName(large)
    return both.select("path", "length", F.col("digest.stored").alias("stored_sha256"), F.col("digest.inflated").alias("checksum"))


def _digests(source: Column) -> Column:
    """Digests of file content (binary) or of the file at a path (text), chunk by chunk."""

    # Nested, so that executors need no copy of this package.
    def chunks(value: bytes | str) -> Iterator[memoryview]:
        step = 1 << 22
        if isinstance(value, bytes):
            view = memoryview(value)
            for start in range(0, len(view), step):
                yield view[start : start + step]
            return
        from pyarrow import fs

        uri = value.replace("file:/", "file:///", 1) if value.startswith("file:/") and "://" not in value else value
        system, name = fs.FileSystem.from_uri(uri)
        with system.open_input_stream(name, compression=None) as stream:
            while chunk := stream.read(step):
                yield memoryview(chunk)

    def digest(value: bytes | str) -> tuple[str, str]:
        stored, inflated = hashlib.sha256(), hashlib.sha256()
        member = None
        is_gzip = None
        for chunk in chunks(value):
            stored.update(chunk)
            if is_gzip is None:
                is_gzip = bytes(chunk[:2]) == b"\x1f\x8b"
            if not is_gzip:
                inflated.update(chunk)
                continue
            rest = chunk
            while len(rest):  # a gzip file may hold several members
                if member is None or member.eof:
                    member = zlib.decompressobj(wbits=31)
                inflated.update(member.decompress(rest))
                rest = memoryview(member.unused_data)
        return stored.hexdigest(), inflated.hexdigest()

    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([digest(value) for value in batch], columns=["stored", "inflated"])

    pair = T.StructType([T.StructField("stored", T.StringType()), T.StructField("inflated", T.StringType())])
    return F.pandas_udf(digests, pair)(source)
