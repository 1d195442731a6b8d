"""Object keys of the lake: `<prefix>/<table>/<file>` and their derived forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# File suffixes removed, one after the other, to get the base name.
FILE_SUFFIXES = (".json.gz", ".csv.gz", ".gz", ".parquet")

# Prefix of layer schemas, and the name part that tells batch CSV files from streamed JSON.
LAYER_PREFIX = "dm_"
BATCH_MARKER = "dm-batch-process"


def layer_schema(layer: str) -> str:
    return f"{LAYER_PREFIX}{layer.strip().lower()}"


def key_table(key: Column) -> Column:
    return F.split_part(key, F.lit("/"), F.lit(2))


def base_name(file_name: Column) -> Column:
    name = file_name
    for suffix in FILE_SUFFIXES:
        pattern = suffix.replace(".", r"\.") + "$"
        name = F.regexp_replace(name, pattern, "")
    return name


def destination_key(key: Column, layer: str, created_at: Column) -> Column:
    """Key of the same file in another layer; lake layers are laid out by day of `created_at`."""
    table = key_table(key)
    name = base_name(F.split_part(key, F.lit("/"), F.lit(3)))
    if layer == "raw":
        return F.concat(F.lit("raw/"), table, F.lit("/"), name, F.lit(".gz"))
    day = F.date_format(created_at, "'year='yyyy/'month='MM/'day='dd")
    return F.concat(F.lit(f"{layer}/"), table, F.lit("/"), day, F.lit("/"), name, F.lit(".parquet"))


def key_partition(key: Column) -> Column:
    """The day of `.../partitioned_at=<day>`."""
    return F.element_at(F.split(key, "partitioned_at="), -1)


def file_format(key: Column) -> Column:
    return F.when(key.contains(BATCH_MARKER), "csv").otherwise("json")


def control_id(*parts: Column) -> Column:
    """Deterministic id, so that registering a file twice gives the same row."""
    return F.sha2(F.concat_ws("|", *parts), 256)
