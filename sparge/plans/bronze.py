"""Raw files to bronze Parquet, driven by the ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sparge.contracts import ENTITIES, RAW_ORDER
from sparge.functions.keys import base_name, layer_schema
from sparge.operators import ledger
from sparge.operators.governance import columns_to_mask, mask_columns, tag_pii
from sparge.operators.validate import accepted, checked, conform, rejected, validate
from sparge.plans.control import log_path, run_entries
from sparge.session import path_exists, read_note, staged, write_note
from sparge.sinks.files import write_bronze
from sparge.sources.files import key_of_path, list_files, read_csv_gz, read_csv_raw, read_csv_split, read_json_raw, with_raw_order
from sparge.sources.manifest import content_checksums, file_manifest


# Files of one round; their names are arguments of one scan. Further files are taken in further rounds.
ROUND_FILES = 2_000


def raw_manifest(spark: SparkSession, root: str, table: str, fmt: str, checksums: bool = False) -> DataFrame:
    """Manifest of `<root>/raw/<table>/` from the files' content, with keys relative to `root`.

    The checksum is the order-insensitive fingerprint; with `checksums` it is the
    SHA-256 of the uncompressed content. The jobs do not need it: they register
    files from the listing and count records as they parse.
    """
    path = f"{root.rstrip('/')}/raw/{table}"
    files = file_manifest(spark, path, fmt).withColumn("checksum", F.col("fingerprint"))
    if checksums:
        digests = content_checksums(spark, path).select(_relative("path", "raw", table).alias("_key"), "checksum")
        files = files.drop("checksum").withColumn("_key", _relative("object_path", "raw", table)).join(
            digests, "_key", "left"
        )
    return files.select(
        _relative("object_path", "raw", table).alias("object_key"),
        "record_count",
        "file_size",
        F.coalesce("checksum", "fingerprint").alias("checksum"),
    )


def raw_listing(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Files of `<root>/raw/<table>/` as the file system lists them; no file is opened."""
    path = f"{root.rstrip('/')}/raw/{table}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "object_key string, record_count bigint, file_size bigint, checksum string")
    return listed(list_files(spark, path), table)


def listed(files: DataFrame, table: str) -> DataFrame:
    """Raw files (`object_path, file_size`) as a manifest whose counts are not known yet."""
    return files.select(
        _relative("object_path", "raw", table).alias("object_key"),
        F.lit(None).cast("bigint").alias("record_count"),
        "file_size",
        F.lit(None).cast("string").alias("checksum"),
    )


def _relative(column: str, layer: str, table: str) -> Column:
    prefix = f"{layer}/{table}/"
    return F.concat(F.lit(prefix), F.substring_index(column, f"/{prefix}", -1))


def raw_rows(spark: SparkSession, root: str, keys: Sequence[str], table: str, fmt: str) -> DataFrame:
    """Raw rows of some files as text, each with its time, file and place."""
    paths = [f"{root}/{key}" for key in keys]
    raw = read_csv_raw(spark, paths) if fmt == "csv" else read_json_raw(spark, paths, ENTITIES[table].bronze)
    raw = with_raw_order(raw, root)
    # Batch files hold plain inserts.
    return raw if "operation" in raw.columns else raw.withColumn("operation", F.lit("insert"))


def masked_rows(
    spark: SparkSession, root: str, rows: DataFrame, table: str, mask: str | Sequence[str] | None = "auto"
) -> DataFrame:
    """Valid rows of staged `checked` ones, masked, tagged and in contract order.

    Detection looks at all rows. What it once found in a column holds for the table from then on, so a
    later batch in which few values match does not go unmasked; findings are kept below `<root>/control_pii`.
    """
    schema = ENTITIES[table].bronze
    names = columns_to_mask(accepted(rows, schema).drop("operation"), mask)
    if mask == "auto":
        noted = f"{root}/control_pii/{table}"
        before = set((read_note(spark, noted) or "").split())
        if set(names) - before:
            write_note(spark, noted, "\n".join(sorted({*before, *names})))
        names = sorted({*before, *names})
    valid = accepted(rows, schema, RAW_ORDER.names)
    return tag_pii(conform(mask_columns(valid, names), T.StructType([*schema.fields, *RAW_ORDER.fields])), names)


def load_seed(spark: SparkSession, name: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Seed rows of one entity from gzip CSV, validated against its contract, and the rejected ones."""
    return validate(read_csv_raw(spark, path), ENTITIES[name.strip().lower()].columns)


def run_bronze(
    spark: SparkSession, root: str, table: str, now: Column, mask: str | Sequence[str] | None = "auto",
    round_files: int = ROUND_FILES,
) -> dict[str, int]:
    """Process all eligible raw files of one table: bronze rows, rejected rows, ledger states.

    New files are registered from the listing; only files that have to be processed are
    read, each in the format its entry names. A file that cannot be read becomes an
    error by itself. Rows of a raw file have a bronze folder of their own, so a retry
    replaces what an earlier attempt wrote. Every processed file is pending for silver
    afterwards, with the number of its rows.
    """
    root = root.rstrip("/")
    return process_files(spark, root, table, now, raw_listing(spark, root, table), mask, round_files)


def process_files(
    spark: SparkSession, root: str, table: str, now: Column, listing: DataFrame,
    mask: str | Sequence[str] | None = "auto", round_files: int = ROUND_FILES, only_listed: bool = False,
) -> dict[str, int]:
    """Register the files of `listing` that are new, and process what is eligible; see `run_bronze`.

    With `only_listed`, no other entries are taken, and listed ones also where an attempt was cut short.

    A batch of files is inflated, parsed and checked once. The result is staged; detection of personal data, both
    outputs and the counts per file are taken from there.
    """
    log = ledger.read_log(spark, log_path(root))
    fresh = ledger.register_files(log, listing, now)
    ledger.append(fresh.withColumn("compute_target", F.lit(None).cast("string")), log_path(root))
    done = {"files": 0, "valid": 0, "rejected": 0}

    def work(started: DataFrame) -> DataFrame:
        entries = started.select("object_key", "file_format", "created_at").collect()  # at most `round_files`
        tally = {"files": len(entries), "valid": 0, "rejected": 0}
        counts = []
        for fmt in sorted({e.file_format for e in entries}):
            paths = sorted(e.object_key for e in entries if e.file_format == fmt)
            raw = raw_rows(spark, root, paths, table, fmt)
            with staged(checked(raw, ENTITIES[table].bronze, RAW_ORDER.names), "checked") as rows:
                found = file_counts(rows, ENTITIES[table].bronze).collect()  # a row per file
                if any(f.valid for f in found):
                    store_rows(masked_rows(spark, root, rows, table, mask), started, f"{root}/bronze/{table}")
                if any(f.rejected for f in found):
                    store_rejected(rejected(rows, RAW_ORDER.names), f"{root}/rejected/{table}")
            counts += [(f["_raw_key"], f.valid, f.checksum) for f in found]
            tally["valid"] += sum(f.valid for f in found)
            tally["rejected"] += sum(f.rejected for f in found)
        counted = spark.createDataFrame(counts, "object_key string, _valid bigint, _checksum string")
        written = bronze_entries(spark, root, table, started, counted)
        ledger.append(ledger.next_layer(ledger.read_log(spark, log_path(root)), written.filter("record_count > 0"), now), log_path(root))
        for name, n in tally.items():
            done[name] += n
        return written.select("object_key", "record_count")

    wanted = listing if only_listed else None
    while run_entries(spark, root, layer_schema("bronze"), table, now, work, apart=True, most=round_files, keys=wanted):
        pass
    return done


def file_counts(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Per raw file of staged `checked` rows: valid and rejected ones, and a fingerprint of the valid ones.

    The fingerprint sums row hashes, so it does not depend on their order.
    """
    digest = F.when(F.col("_valid"), F.xxhash64(*schema.names))
    return rows.groupBy("_raw_key").agg(
        F.count_if("_valid").alias("valid"), F.count_if(~F.col("_valid")).alias("rejected"),
        F.concat_ws(
            "-", F.hex(F.sum(F.shiftrightunsigned(digest, 32))), F.hex(F.sum(digest.bitwiseAND(F.lit(0xFFFFFFFF))))
        ).alias("checksum"),
    )


def store_rows(valid: DataFrame, entries: DataFrame, path: str) -> None:
    """Write bronze rows below the day on which their raw file was registered, a folder for each raw file."""
    days = entries.select(F.col("object_key").alias("_raw_key"), F.col("created_at").alias("_registered"))
    dated = valid.join(days, "_raw_key")
    at, file = F.col("_registered"), file_folder(F.col("_raw_key"))
    write_bronze(dated.select(*valid.columns, "_registered"), path, at, file=file, drop=["_registered"])


def store_rejected(rejected: DataFrame, path: str) -> None:
    """Write rejected rows, in place of what an earlier attempt wrote for the same raw files."""
    (
        rejected.withColumn("file", file_folder(F.col("_raw_key")))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("file")
        .json(path)
    )


def file_folder(raw_key: Column) -> Column:
    """Name of a raw file's folder in bronze: its base name, made distinct by a digest of the whole key."""
    return F.concat(base_name(F.element_at(F.split(raw_key, "/"), -1)), F.lit("-"), F.left(F.sha2(raw_key, 256), F.lit(12)))


def bronze_entries(
    spark: SparkSession, root: str, table: str, started: DataFrame, counted: DataFrame
) -> DataFrame:
    """The entries just processed with their number of rows and what was written for them.

    `counted` holds `object_key, _valid, _checksum`. Sizes come from the listing of the days of these entries; no file
    is opened. A file without rows has written nothing.
    """
    day = F.date_format("created_at", "'year='yyyy/'month='MM/'day='dd")
    folder = F.concat(F.lit(f"bronze/{table}/"), day, F.lit("/file="), file_folder(F.col("object_key")))
    own = started.withColumn("new_object_key", folder).join(counted, "object_key", "left")
    own = own.withColumn("record_count", F.coalesce("_valid", F.lit(0).cast("bigint")))
    days = [r[0] for r in own.filter("record_count > 0").select(day).distinct().collect()]
    sizes = spark.createDataFrame([], "_folder string, new_file_size bigint")
    if days:
        paths = [f"{root}/bronze/{table}/{d}" for d in sorted(days)]
        key = F.regexp_replace(key_of_path(F.col("object_path"), root), "/[^/]*$", "")
        sizes = list_files(spark, paths).groupBy(key.alias("_folder")).agg(F.sum("file_size").alias("new_file_size"))
    own = own.join(sizes, F.col("_folder") == F.col("new_object_key"), "left")
    return own.withColumn("new_checksum", F.col("_checksum")).drop("_folder", "_valid", "_checksum")


def convert_csv(
    spark: SparkSession, source: str | list[str], target: str, table: str = "review", split: bool = False
) -> None:
    """Gzip CSV to snappy Parquet with typed columns, without validation.

    `split` parses with all cores when there are fewer files than that.
    """
    read = read_csv_split if split else read_csv_gz
    rows = read(spark, source, ENTITIES[table].columns)
    rows.write.mode("overwrite").option("compression", "snappy").parquet(target)
