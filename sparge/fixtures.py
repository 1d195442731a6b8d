"""Review-, change-, envelope-, ledger- and cost-shaped views over the given tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparge.contracts import AUDIT, REVIEW, REVIEW_FLAT, columns as schema
from sparge.functions import keys
from sparge.functions.time import partition_day
from sparge.operators.cdc import CONTROL_TS
from sparge.operators.flat import DIMENSION_COLUMNS, build_review_flat
from sparge.session import folder_bytes

ENTITY_NAMES = ("brewery", "beer", "profile", "review")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- star -----------------------------------------------------------------

# Review columns that come from the order rather than the line.
ORDER_COLUMNS = ("profile_id", "created_at", "updated_at", "deleted_at", "partitioned_at")


def review(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Order lines as reviews; the order is joined only for columns that need it."""
    wanted = list(columns or (*REVIEW.columns.names, *AUDIT.names, "partitioned_at"))
    rows = table(spark, folder, "lineitem")
    if set(wanted) & set(ORDER_COLUMNS):
        orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    ordered = F.col("o_orderdate").cast("timestamp")
    expressions = {
        "review_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "brewery_id": F.col("l_suppkey"),
        "beer_id": F.col("l_partkey"),
        "profile_id": F.col("o_custkey"),
        "review_overall": F.col("l_quantity"),
        "review_aroma": F.col("l_discount"),
        "review_appearance": F.col("l_tax"),
        "review_palate": F.col("l_extendedprice"),
        "review_taste": F.nullif(F.col("l_discount"), F.lit(0.0)),
        "review_time": F.unix_seconds(F.col("l_shipdate").cast("timestamp")),
        "created_at": ordered,
        "updated_at": ordered,
        "deleted_at": F.when(F.col("l_returnflag") == "R", ordered),
        "partitioned_at": partition_day(ordered),
    }
    return rows.select(*[expressions[c].alias(c) for c in wanted])


def beer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("beer_id"),
        F.regexp_extract("p_brand", "([0-9]+)$", 1).try_cast("bigint").alias("brewery_id"),
        F.col("p_name").alias("beer_name"),
        F.col("p_type").alias("beer_style"),
        F.col("p_size").cast("double").alias("beer_abv"),
    )


def brewery(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("brewery_id"), F.col("s_name").alias("brewery_name")
    )


def profile(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("profile_id"),
            F.col("c_name").alias("profile_name"),
            F.concat("c_name", F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("state"),
        )
    )


def review_flat(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The flat view; with `columns`, only the joins these need."""
    wanted = list(columns or REVIEW_FLAT.names)
    dims = {"beer": beer(spark, folder), "brewery": brewery(spark, folder), "profile": profile(spark, folder)}
    key_of = {c: key for key, supplied in DIMENSION_COLUMNS.values() for c in supplied}
    needed = dict.fromkeys([key_of.get(c, c) for c in wanted])
    return build_review_flat(review(spark, folder, list(needed)), **dims, columns=wanted)


# --- raw files ------------------------------------------------------------

# Default size of one input split.
SPLIT_BYTES = 128 * 1024 * 1024


def spread(df: DataFrame, source: str) -> DataFrame:
    """One raw file per core where `source` has fewer splits than cores; else one per split."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = folder_bytes(df.sparkSession, source) < cores * SPLIT_BYTES
    return df.repartition(cores) if few else df


def write_csv_gz(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("compression", "gzip").option("escape", '"').csv(path)


def write_json_gz(df: DataFrame, path: str) -> None:
    df.write.option("compression", "gzip").json(path)


def raw_review_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews as CSV lines, with defects that depend on the quantity.

    1: rating is not a number, 2: a field is missing, 3: a field too many, 4: blank
    required key, 5: blank optional rating, 6: key is not an integer, 7: padded values.
    """
    q = F.col("review_overall").cast("int")
    columns = ("review_id", "brewery_id", "beer_id", "review_overall", "review_time")
    rows = review(spark, folder, columns)
    text = {c: F.col(c).cast("string") for c in columns}
    line = F.concat_ws(
        ",",
        text["review_id"],
        F.when(q == 6, F.concat(text["brewery_id"], F.lit(".5"))).otherwise(text["brewery_id"]),
        F.when(q == 4, F.lit("  ")).when(q == 7, F.concat(F.lit("  "), text["beer_id"], F.lit(" "))).otherwise(text["beer_id"]),
        F.when(q == 1, F.lit("n/a")).when(q == 5, F.lit("")).otherwise(text["review_overall"]),
        F.when(q == 2, F.lit(None)).otherwise(text["review_time"]),
        F.when(q == 3, F.lit("extra")),
    )
    return rows.select(line.alias(",".join(columns)))


def write_lines(df: DataFrame, path: str) -> None:
    """A one-column frame as gzip text files that start with the column name."""
    (
        df.write.option("header", True)
        .option("sep", "\x01")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip")
        .csv(path)
    )


RAW_REVIEW = schema(
    "review_id bigint not null, brewery_id bigint not null, beer_id bigint not null,"
    " review_overall double, review_time bigint"
)


# --- changes --------------------------------------------------------------

EVENT_STATE = schema(
    "user_id bigint, event_id bigint, value double, props string,"
    " created_at timestamp, updated_at timestamp, deleted_at timestamp, partitioned_at string"
)
EVENT_BRONZE = schema("user_id bigint, event_id bigint, value double, props string, operation string")


def operation_of(event_type: Column) -> Column:
    return F.when(event_type == "signup", "insert").when(event_type == "error", "delete").otherwise("update")


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as changes of their user."""
    return table(spark, folder, "events").select(
        "user_id",
        "event_id",
        "value",
        "props",
        operation_of(F.col("event_type")).alias("operation"),
        F.col("ts").cast("timestamp").alias(CONTROL_TS),
    )


# --- envelopes ------------------------------------------------------------

def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as change envelopes; small values get a defect each."""
    value = F.col("value")
    table_name = F.when(value >= 2, F.col("event_type"))
    data = F.to_json(F.struct("event_id", "user_id", "value"))
    meta = F.to_json(F.struct(table_name.alias("table-name"), operation_of(F.col("event_type")).alias("operation")))
    whole = F.concat(F.lit('{"data":'), data, F.lit(',"metadata":'), meta, F.lit("}"))
    return table(spark, folder, "events").select(
        "event_id",
        F.when(value < 1, F.concat(F.lit('{"data":'), data))
        .when((value >= 2) & (value < 3), F.concat(F.lit('{"data":['), data, F.lit('],"metadata":'), meta, F.lit("}")))
        .when((value >= 3) & (value < 4), F.concat(F.lit('{"data":'), data, F.lit(',"metadata":{"table-name":7}}')))
        .otherwise(whole)
        .alias("value"),
    )


# --- ledger ---------------------------------------------------------------

def file_key(number: Column) -> Column:
    """Object key of the file with this number: four tables in turn, CSV and JSON alternating."""
    name = F.element_at(F.array(*map(F.lit, ENTITY_NAMES)), (number % 4 + 1).cast("int"))
    stem = F.when(number % 2 == 0, F.lit("/dm-batch-process-")).otherwise(F.lit("/part-"))
    suffix = F.when(number % 2 == 0, F.lit(".csv.gz")).otherwise(F.lit(".json.gz"))
    return F.concat(F.lit("raw/"), name, stem, number.cast("string"), suffix)


def ledger_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as ledger rows: one file per user, whose states follow the event types."""
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    whole = F.floor("value").cast("bigint")
    status = (
        F.when(kind == "signup", "pending")
        .when(kind == "purchase", "success")
        .when(kind == "error", "error")
        .otherwise("running")
    )
    key = file_key(F.col("user_id"))
    done = status.isin("success", "error")
    return table(spark, folder, "events").select(
        keys.control_id(F.lit("dm_bronze"), keys.key_table(key), key).alias("control_id"),
        key.alias("object_key"),
        F.lit("dm_bronze").alias("schema_name"),
        keys.key_table(key).alias("table_name"),
        (whole * 2000).alias("record_count"),
        keys.file_format(key).alias("file_format"),
        (whole * 64).alias("file_size"),
        F.sha2("props", 256).alias("checksum"),
        status.alias("status"),
        F.floor(F.col("value") / 20).cast("int").alias("attempt_count"),
        F.when(whole * 2000 <= 100000, "small").otherwise("bulk").alias("compute_target"),
        F.when(status != "pending", ts).alias("started_at"),
        F.when(done, F.timestamp_add("SECOND", whole, ts)).alias("finished_at"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
        F.when(done, whole * 1000).alias("duration"),
        F.when(status == "error", F.col("props")).alias("error_message"),
    )


def customer_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One raw file per customer, many of them not in the ledger yet."""
    return table(spark, folder, "customer").select(
        file_key(F.col("c_custkey")).alias("object_key"),
        (F.col("c_custkey") * 150).alias("record_count"),
        (F.col("c_custkey") * 64).alias("file_size"),
        F.sha2("c_name", 256).alias("checksum"),
    )


# --- costs ----------------------------------------------------------------

def costs(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as cost lines."""
    part = table(spark, folder, "part").select("p_partkey", "p_type")
    day = F.col("l_shipdate")
    return (
        table(spark, folder, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(
            F.concat(
                F.date_format(day, "yyyy-MM-dd'T'00:00:00'Z'"),
                F.lit("/"),
                F.date_format(day + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'00:00:00'Z'"),
            ).alias("identity_time_interval"),
            F.col("l_returnflag").alias("line_item_line_item_type"),
            F.col("p_type").alias("line_item_product_code"),
            F.col("l_extendedprice").alias("line_item_unblended_cost"),
            F.col("l_linestatus").alias("line_item_usage_type"),
            # Lines without a discount have no tags, cheap ones a single one.
            F.when(F.col("l_discount") == 0, None)
            .when(F.col("l_quantity") > 25, F.create_map(F.lit("status"), "l_linestatus", F.lit("flag"), "l_returnflag"))
            .otherwise(F.create_map(F.lit("status"), "l_linestatus"))
            .alias("resource_tags"),
            F.date_format(day, "yyyy-MM").alias("billing_period"),
        )
    )
