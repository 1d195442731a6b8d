"""One query per operator, run on views over the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sparge import fixtures as fx
from sparge.contracts import COSTS, ENTITIES, columns
from sparge.operators import cdc, costs, flat, governance, ledger, routing
from sparge.plans import dashboards
from sparge.operators.marts import MARTS, Mart, build_mart
from sparge.operators.validate import conform, normalize_blanks, union_all, validate
from sparge.plans.bronze import load_seed
from sparge.plans.gold import mart_schema, rebuild_months
from sparge.plans.silver import apply_changes
from sparge.session import configure, empty_frame, folder_bytes, scratch_path, stage
from sparge.sinks.files import append_partitioned, compact, publish_mart, write_bronze, write_parquet
from sparge.sources import files
from sparge.sources.manifest import file_manifest

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; `oracles` uses the same ones.
YEAR, MONTH = 1998, 7
BILLING_PERIOD = "1998-07"
DAYS = ("20240103", "20240111", "20240125")
ORDER_DAYS = ("19970214", "19980703", "20001009")
MIN_REVIEWS = {"top_beers_by_rating": 3, "top_breweries_by_rating": 10}
NOW = "2024-02-01 00:00:00"
LATER = "2024-02-01 00:01:30"

_REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query: session settings first, zone-free timestamps last."""

    @functools.wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark, folder_bytes(spark, folder))
        return _zone_free(build(spark, folder))

    _REGISTRY[build.__name__.rstrip("_")] = run
    return run


def _zone_free(df: DataFrame) -> DataFrame:
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


def all_queries() -> dict[str, Query]:
    from sparge.registry import job_queries  # noqa: F401, registers its own

    return dict(_REGISTRY)


def _now(text: str = NOW):
    return F.lit(text).cast("timestamp")


# --- sources and sinks ----------------------------------------------------

def _bronze_events(spark: SparkSession, folder: str) -> str:
    """Events written in the bronze layout; returns the lake root."""
    root = scratch_path(spark, "lake")
    write_bronze(fx.changes(spark, folder), f"{root}/bronze/events", F.col(cdc.CONTROL_TS))
    return root


@query
def scan_parquet(spark, folder):
    root = _bronze_events(spark, folder)
    path = F.col("_metadata.file_path")
    key = F.concat(F.lit("bronze/events/"), F.substring_index(path, "/bronze/events/", -1))
    written = spark.read.schema(fx.EVENT_BRONZE).option("recursiveFileLookup", True).parquet(f"{root}/bronze/events")
    day = F.regexp_extract("object_key", "year=([0-9]+)/month=([0-9]+)/day=([0-9]+)/", 0)
    entries = written.select(key.alias("object_key")).distinct().withColumn(
        "created_at", F.to_timestamp(day, "'year='yyyy'/month='MM'/day='dd'/'")
    )
    batch = files.read_batch(spark, root, entries, fx.EVENT_BRONZE)
    return batch.select("event_id", "user_id", "operation", F.col(cdc.CONTROL_TS).alias("control_ts"))


@query
def scan_dims(spark, folder):
    root = scratch_path(spark, "seed")
    dims = {
        "brewery": fx.brewery(spark, folder),
        "beer": fx.beer(spark, folder).select(*ENTITIES["beer"].columns.names),
        "profile": fx.profile(spark, folder),
    }
    parts = []
    for name, dim in dims.items():
        fx.write_csv_gz(dim, f"{root}/{name}")
        loaded, _ = load_seed(spark, name, f"{root}/{name}")
        parts.append(
            loaded.select(F.lit(name).alias("entity"), F.col(f"{name}_id").alias("id"), F.col(f"{name}_name").alias("name"))
        )
    return union_all(parts)


def _daily_events(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "events-by-day")
    rows = cdc.with_audit(fx.changes(spark, folder)).drop("operation", cdc.CONTROL_TS)
    append_partitioned(conform(rows, fx.EVENT_STATE), path, "partitioned_at")
    return path


@query
def scan_partition_pruned(spark, folder):
    days = files.read_partitions(spark, _daily_events(spark, folder), DAYS, fx.EVENT_STATE)
    return days.select("event_id", "user_id", "value", "partitioned_at")


@query
def probe_partition(spark, folder):
    table = files.read_table(spark, _daily_events(spark, folder), fx.EVENT_STATE)
    return spark.sql(
        "SELECT partitioned_at, count(*) AS row_count, count(deleted_at) AS deleted_count,"
        " min(event_id) AS first_event, max(event_id) AS last_event"
        " FROM {events} GROUP BY partitioned_at",
        events=table,
    )


@query
def compact_partition_counts(spark, folder):
    path = _daily_events(spark, folder)
    compact(spark, path, fx.EVENT_STATE, "partitioned_at")
    table = files.read_table(spark, path, fx.EVENT_STATE)
    return table.groupBy("partitioned_at").agg(F.count("*").alias("row_count"), F.sum("event_id").alias("event_sum"))


@query
def bronze_partition_layout(spark, folder):
    root = _bronze_events(spark, folder)
    layout = T.StructType([*fx.EVENT_BRONZE.fields, *columns("year string, month string, day string").fields])
    rows = spark.read.schema(layout).parquet(f"{root}/bronze/events")
    return rows.groupBy("year", "month", "day").agg(F.count("*").alias("row_count"))


@query
def bronze_csv_roundtrip(spark, folder):
    root = scratch_path(spark, "csv")
    schema = ENTITIES["review"].columns
    fx.write_csv_gz(fx.spread(fx.review(spark, folder, schema.names), f"{folder}/lineitem.parquet"), f"{root}/raw")
    write_parquet(files.read_csv_gz(spark, f"{root}/raw", schema), f"{root}/bronze")
    return files.read_table(spark, f"{root}/bronze", schema)


@query
def bronze_json_roundtrip(spark, folder):
    root = scratch_path(spark, "json")
    schema = ENTITIES["profile"].columns
    fx.write_json_gz(fx.profile(spark, folder), f"{root}/raw")
    write_parquet(files.read_json_gz(spark, f"{root}/raw", schema), f"{root}/bronze")
    return files.read_table(spark, f"{root}/bronze", schema)


@query
def file_manifest_(spark, folder):
    root = scratch_path(spark, "manifest")
    fx.write_csv_gz(fx.profile(spark, folder), f"{root}/raw/profile")
    reviews = fx.review(spark, folder, ENTITIES["review"].columns.names)
    fx.write_json_gz(fx.spread(reviews, f"{folder}/lineitem.parquet"), f"{root}/raw/review")
    found = union_all(
        [
            file_manifest(spark, f"{root}/raw/profile", "csv").withColumn("file_format", F.lit("csv")),
            file_manifest(spark, f"{root}/raw/review", "json").withColumn("file_format", F.lit("json")),
        ]
    )
    name = F.regexp_extract("object_path", "/raw/([a-z]+)/", 1)
    # Spark puts a header into every CSV file, so lines exceed records by one per file.
    headers = F.when(F.col("file_format") == "csv", 1).otherwise(0)
    return found.groupBy(name.alias("table_name"), "file_format").agg(
        F.sum("record_count").alias("record_count"), F.sum(F.col("line_count") - headers).alias("data_lines")
    )


@query
def costs_scan(spark, folder):
    path = scratch_path(spark, "costs")
    append_partitioned(fx.costs(spark, folder), path, "billing_period")
    return files.read_costs(spark, path, COSTS).select(
        "billing_period",
        "identity_time_interval",
        "line_item_product_code",
        "line_item_line_item_type",
        "line_item_usage_type",
        "line_item_unblended_cost",
        F.size(F.coalesce("resource_tags", F.create_map().cast("map<string,string>"))).alias("tag_count"),
    )


# --- validation -----------------------------------------------------------

def _raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    fx.write_lines(fx.spread(fx.raw_review_lines(spark, folder), f"{folder}/lineitem.parquet"), path)
    return files.read_csv_raw(spark, path)


@query
def validate_valid(spark, folder):
    valid, _ = validate(_raw_reviews(spark, folder), fx.RAW_REVIEW)
    return valid


@query
def validate_rejected(spark, folder):
    _, rejected = validate(_raw_reviews(spark, folder), fx.RAW_REVIEW)
    reason = F.explode("reasons").alias("reason")
    return (
        rejected.select(reason)
        .groupBy(F.col("reason.column").alias("field"), F.col("reason.reason").alias("reason"))
        .agg(F.count("*").alias("row_count"))
    )


@query
def normalize_blanks_(spark, folder):
    """Whole texts, with line breaks and blanks around them cut off."""
    documents = fx.table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return normalize_blanks(documents).select("doc_id", F.md5("text").alias("text_md5"), "lang", "source")


@query
def conform_types(spark, folder):
    orders = fx.table(spark, folder, "orders")
    text = orders.select(*[F.col(c).cast("string").alias(c) for c in reversed(orders.columns)])
    schema = columns("o_orderkey bigint, o_custkey int, o_totalprice double, o_orderdate timestamp, o_orderpriority int")
    return conform(text, schema, lenient=True)


# --- change data capture --------------------------------------------------

@query
def cdc_split_counts(spark, folder):
    return cdc.operation_counts(fx.changes(spark, folder))


@query
def cdc_audit_columns(spark, folder):
    return cdc.with_audit(fx.changes(spark, folder)).drop(cdc.CONTROL_TS, "props")


@query
def cdc_latest(spark, folder):
    later = fx.changes(spark, folder).filter(F.col("operation").isin("update", "delete"))
    latest = cdc.latest_by_key(later, ["user_id"], [cdc.CONTROL_TS, "event_id"])
    return latest.withColumnRenamed(cdc.CONTROL_TS, "control_ts")


def _two_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    changes = fx.changes(spark, folder)
    half = F.lit("2024-01-16").cast("timestamp")
    return changes.filter(F.col(cdc.CONTROL_TS) < half), changes.filter(F.col(cdc.CONTROL_TS) >= half)


@query
def silver_state(spark, folder):
    """The first half of the month creates the table, the second is merged into it."""
    path = scratch_path(spark, "silver")
    for batch in _two_batches(spark, folder):
        apply_changes(spark, path, fx.EVENT_STATE, batch, "user_id", ["event_id"])
    return files.read_table(spark, path, fx.EVENT_STATE)


def _state(spark: SparkSession, batch: DataFrame, target: DataFrame | None = None) -> DataFrame:
    target = empty_frame(spark, fx.EVENT_STATE) if target is None else target
    return cdc.apply_cdc(target, batch, "user_id", ["event_id"])


@query
def silver_soft_deleted(spark, folder):
    state = _state(spark, fx.changes(spark, folder))
    return state.filter(F.col("deleted_at").isNotNull()).select("user_id", "event_id", "created_at", "deleted_at")


@query
def silver_active(spark, folder):
    return cdc.active(_state(spark, fx.changes(spark, folder))).select("user_id", "event_id", "updated_at")


@query
def silver_partition_move(spark, folder):
    first, second = _two_batches(spark, folder)
    before = stage(_state(spark, first), "before")
    after = _state(spark, second, before)
    old = before.select("user_id", F.col("partitioned_at").alias("old_partition"))
    new = after.select("user_id", F.col("partitioned_at").alias("new_partition"))
    return new.join(old, "user_id").filter("old_partition <> new_partition")


@query
def silver_strict_append(spark, folder):
    """Inserts kept as rows of their own; the last update or delete reaches all rows of its key."""
    target = empty_frame(spark, fx.EVENT_STATE)
    state = cdc.apply_cdc(target, fx.changes(spark, folder), "user_id", ["event_id"], strict_append=True)
    return state.groupBy("user_id").agg(
        F.count("*").alias("row_count"),
        F.max("event_id").alias("event_id"),
        F.min("created_at").alias("first_created"),
        F.max("updated_at").alias("updated_at"),
        F.count("deleted_at").alias("deleted_count"),
    )


# --- flat table -----------------------------------------------------------

@query
def review_flat(spark, folder):
    return fx.review_flat(spark, folder)


@query
def review_flat_active(spark, folder):
    wanted = ("review_id", "beer_id", "profile_id", "state", "review_overall", "deleted_at")
    return cdc.active(fx.review_flat(spark, folder, wanted)).drop("deleted_at")


@query
def fk_orphans(spark, folder):
    """Unmatched keys per reference; documents without a label give a case that has some."""
    review = fx.review(spark, folder, ("beer_id", "brewery_id", "profile_id"))
    documents = fx.table(spark, folder, "documents").select("doc_id")
    checks = {
        "review.beer_id": (review, fx.beer(spark, folder), "beer_id"),
        "review.brewery_id": (review, fx.brewery(spark, folder), "brewery_id"),
        "review.profile_id": (review, fx.profile(spark, folder), "profile_id"),
        "beer.brewery_id": (fx.beer(spark, folder), fx.brewery(spark, folder), "brewery_id"),
        "document.label": (documents, fx.table(spark, folder, "labels"), "doc_id"),
    }
    return union_all(
        [
            flat.orphans(fact, dim, key).agg(
                F.lit(name).alias("reference"),
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"),
            )
            for name, (fact, dim, key) in checks.items()
        ]
    )


@query
def affected_months(spark, folder):
    return flat.affected_months(fx.review_flat(spark, folder, ("review_time", "partitioned_at")), ORDER_DAYS)


# --- marts and dashboards -------------------------------------------------

def _mart(spark: SparkSession, folder: str, name: str, min_reviews: int | None = None) -> DataFrame:
    mart = MARTS[name]
    least = MIN_REVIEWS.get(name) if min_reviews is None else min_reviews
    return build_mart(fx.review_flat(spark, folder, mart.columns), mart, least)


@query
def gold_top_beers(spark, folder):
    return _mart(spark, folder, "top_beers_by_rating")


@query
def gold_top_breweries(spark, folder):
    return _mart(spark, folder, "top_breweries_by_rating")


@query
def gold_state_volume(spark, folder):
    return _mart(spark, folder, "state_by_review_volume")


@query
def gold_top_styles(spark, folder):
    return _mart(spark, folder, "top_styles_by_popularity")


@query
def gold_top_drinkers(spark, folder):
    return _mart(spark, folder, "top_drinkers")


@query
def gold_top_brands(spark, folder):
    """The beer aggregate with the brand as beer, which passes the usual threshold."""
    brands = fx.table(spark, folder, "part").select(F.col("p_partkey").alias("beer_id"), F.col("p_brand").alias("brand"))
    rows = fx.review(spark, folder, ("beer_id", "review_overall", "review_time")).join(brands, "beer_id", "left")
    mart = Mart("top_brands", ("brand",), ("avg_rating", "total_reviews"), 25, "avg_rating")
    return build_mart(rows, mart)


@query
def gold_active_styles(spark, folder):
    mart = MARTS["top_styles_by_popularity"]
    return build_mart(fx.review_flat(spark, folder, (*mart.columns, "deleted_at")), mart, active_only=True)


@query
def gold_published_styles(spark, folder):
    """Written by month, then written again: replacing leaves one row per key."""
    path = scratch_path(spark, "mart")
    result = stage(_mart(spark, folder, "top_styles_by_popularity"), "result")
    publish_mart(result, path)
    publish_mart(result, path)
    return files.read_table(spark, path, mart_schema("top_styles_by_popularity"))


@query
def gold_affected_states(spark, folder):
    """State volumes recomputed for the months that a few processing days touch."""
    rows = fx.review_flat(spark, folder, ("state", "review_time", "partitioned_at"))
    months = flat.affected_months(rows, ORDER_DAYS).collect()
    return rebuild_months(
        rows, "state_by_review_volume", [(m.review_year, m.review_month) for m in months]
    )


_PUBLISHED: dict[tuple, str] = {}


def _published(spark: SparkSession, folder: str, name: str, publish: Callable[[str], None]) -> str:
    """Path of a table that is written when it is first asked for, and read by every panel of the session after that."""
    known = (spark.sparkContext.applicationId, folder, name)
    if known not in _PUBLISHED:
        path = scratch_path(spark, name)
        publish(path)
        _PUBLISHED[known] = path
    return _PUBLISHED[known]


def _stored_mart(spark: SparkSession, folder: str, name: str, least: int | None = None) -> DataFrame:
    """A mart as `run_mart` leaves it: by year and month, so a panel opens one folder and a picker none of the columns."""
    path = _published(spark, folder, f"{name}-{least}", lambda p: publish_mart(_mart(spark, folder, name, least), p))
    return files.read_table(spark, path, mart_schema(name))


@query
def dash_years(spark, folder):
    return dashboards.years(_stored_mart(spark, folder, "top_breweries_by_rating"))


@query
def dash_months(spark, folder):
    return dashboards.months(_stored_mart(spark, folder, "top_breweries_by_rating"))


def _dash(spark: SparkSession, folder: str, name: str, mart: str, least: int | None = None) -> DataFrame:
    return dashboards.panel(_stored_mart(spark, folder, mart, least), name, YEAR, MONTH)


@query
def dash_top_beers(spark, folder):
    return _dash(spark, folder, "top_beers", "top_beers_by_rating", 1)


@query
def dash_top_breweries(spark, folder):
    return _dash(spark, folder, "top_breweries", "top_breweries_by_rating", 1)


@query
def dash_state_volume(spark, folder):
    return _dash(spark, folder, "state_volume", "state_by_review_volume")


@query
def dash_styles(spark, folder):
    return _dash(spark, folder, "styles", "top_styles_by_popularity")


@query
def dash_top_drinkers(spark, folder):
    return _dash(spark, folder, "top_drinkers", "top_drinkers")


# --- costs ----------------------------------------------------------------

def _stored_costs(spark: SparkSession, folder: str) -> DataFrame:
    path = _published(spark, folder, "costs", lambda p: append_partitioned(fx.costs(spark, folder), p, "billing_period"))
    return files.read_costs(spark, path, COSTS)


@query
def costs_periods(spark, folder):
    return costs.billing_periods(_stored_costs(spark, folder))


@query
def costs_by_service(spark, folder):
    return costs.costs_by_service(_stored_costs(spark, folder), BILLING_PERIOD)


@query
def costs_detail(spark, folder):
    return costs.costs_detail(_stored_costs(spark, folder), BILLING_PERIOD)


@query
def costs_daily(spark, folder):
    return costs.costs_daily(_stored_costs(spark, folder), BILLING_PERIOD)


@query
def costs_cumulative(spark, folder):
    return costs.costs_cumulative(_stored_costs(spark, folder), BILLING_PERIOD)


# --- governance -----------------------------------------------------------

@query
def pii_fields(spark, folder):
    return governance.detect_pii(fx.profile(spark, folder))


@query
def mask_profile(spark, folder):
    return governance.mask_columns(fx.profile(spark, folder), ["profile_name", "email", "state"])


@query
def pii_document_counts(spark, folder):
    return governance.pii_profile(fx.table(spark, folder, "documents"), ["text"])


@query
def pii_documents(spark, folder):
    """Documents that hold personal data, with counts by kind."""
    counted = governance.with_pii_counts(fx.table(spark, folder, "documents").select("doc_id", "text"), "text")
    kinds = [f"{r.name}_count" for r in governance.RULES]
    return counted.drop("text").filter(" + ".join(kinds) + " > 0")


# --- routing --------------------------------------------------------------

@query
def router_accepted(spark, folder):
    ok, _ = routing.route_cdc(fx.envelopes(spark, folder))
    row = F.from_json("payload", columns("event_id bigint, user_id bigint, value double, operation string"))
    return ok.select("table_name", row.alias("row")).select("table_name", "row.*")


@query
def router_dropped(spark, folder):
    _, dropped = routing.route_cdc(fx.envelopes(spark, folder))
    return dropped.select("event_id", "table_name", "operation", "drop_reason")


@query
def router_summary(spark, folder):
    return routing.routing_summary(fx.envelopes(spark, folder))


# --- ledger ---------------------------------------------------------------

@query
def ledger_current(spark, folder):
    return ledger.ledger_current(fx.ledger_log(spark, folder))


@query
def ledger_eligible(spark, folder):
    todo = ledger.eligible(fx.ledger_log(spark, folder))
    return todo.select("control_id", "table_name", "status", "attempt_count", "updated_at")


@query
def ledger_pending_tables(spark, folder):
    return ledger.pending_tables(fx.ledger_log(spark, folder), "dm_bronze")


@query
def ledger_register(spark, folder):
    rows = ledger.register_files(fx.ledger_log(spark, folder), fx.customer_manifest(spark, folder), _now())
    return rows.drop("started_at", "finished_at", "duration", "error_message")


@query
def ledger_size_class(spark, folder):
    kind = ledger.size_class(F.col("record_count")).alias("size_class")
    return fx.customer_manifest(spark, folder).groupBy(kind).agg(
        F.count("*").alias("file_count"), F.sum("record_count").alias("record_count")
    )


@query
def ledger_run(spark, folder):
    """Eligible entries started and finished; reviews fail, the rest succeed."""
    started = stage(ledger.start(ledger.eligible(fx.ledger_log(spark, folder)), _now()), "started")
    failed = ledger.finish(started.filter("table_name = 'review'"), _now(LATER), "no such file")
    passed = ledger.finish(started.filter("table_name <> 'review'"), _now(LATER))
    log = union_all([fx.ledger_log(spark, folder), started, failed, passed])
    current = ledger.ledger_current(log).filter(F.col("updated_at") >= _now())
    return current.select(
        "control_id", "table_name", "status", "attempt_count", "started_at", "finished_at", "duration", "error_message"
    )


def _succeeded(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.ledger_current(fx.ledger_log(spark, folder)).filter("status = 'success'")


@query
def ledger_next_layer(spark, folder):
    rows = ledger.next_layer(fx.ledger_log(spark, folder), _succeeded(spark, folder), _now())
    return rows.select(
        "control_id", "object_key", "schema_name", "table_name", "record_count", "file_format", "compute_target", "status"
    )


@query
def ledger_flat_days(spark, folder):
    rows = ledger.flat_entries(ledger.ledger_current(fx.ledger_log(spark, folder)), _now())
    return rows.select("control_id", "object_key", "schema_name", "table_name", "record_count", "status", "attempt_count")


@query
def ledger_mart_fanout(spark, folder):
    entries = ledger.flat_entries(ledger.ledger_current(fx.ledger_log(spark, folder)), _now())
    rows = ledger.mart_entries(entries, _now())
    return rows.select("control_id", "object_key", "schema_name", "table_name", "record_count", "status")


@query
def ledger_health(spark, folder):
    return ledger.health(fx.ledger_log(spark, folder))
