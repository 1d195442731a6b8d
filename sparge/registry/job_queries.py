"""Queries that run whole jobs and streams on files written from the given tables, and read back what they left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparge import fixtures as fx
from sparge.contracts import ENTITIES, EVENT_TIME, columns
from sparge.operators import cdc, governance, ledger
from sparge.operators.marts import MARTS, build_mart
from sparge.operators.validate import union_all
from sparge.plans.bronze import file_folder, process_files, raw_listing, run_bronze
from sparge.plans.gold import mart_schema
from sparge.plans.silver import run_silver
from sparge.registry.queries import MIN_REVIEWS, _now, query
from sparge.session import path_exists, scratch_path, write_note
from sparge.sinks.files import EmptyInputError, publish_ordered, read_ordered, write_parquet
from sparge.sinks.swap import read_table_state
from sparge.sources import catalog, files
from sparge.sources.streams import read_cdc_stream
from sparge.streaming import jobs

# Parts of the customers by number: this one is a file that cannot be read, that one a file of rejected rows alone.
FILES, BROKEN, REJECTED = 5, 3, 4
FIRST_KNOWN = 10
SNAPSHOT_AT = "2024-02-01 00:00:00"


def _wait(*streams) -> None:
    for stream in streams:
        stream.awaitTermination()


def _people(spark: SparkSession, folder: str) -> DataFrame:
    return fx.profile(spark, folder).withColumn("operation", F.lit("insert"))


# --- ledger -------------------------------------------------------------------

@query
def ledger_partial_failure(spark, folder):
    """A batch of files of which one is broken and one holds nothing valid: each has a fate of its own."""
    root = scratch_path(spark, "partial")
    number = F.pmod("profile_id", F.lit(FILES))
    people = _people(spark, folder).withColumn("file_no", number)
    people = people.withColumn("profile_id", F.when(number != REJECTED, F.col("profile_id"))).filter(F.col("file_no") != BROKEN)
    people.repartition("file_no").write.partitionBy("file_no").option("compression", "gzip").json(f"{root}/raw/profile")
    write_note(spark, f"{root}/raw/profile/file_no={BROKEN}/part.json.gz", "no gzip at all")
    run_bronze(spark, root, "profile", _now())
    log = ledger.ledger_current(ledger.read_log(spark, f"{root}/control"))
    file_no = lambda column: F.regexp_extract(column, "file_no=([0-9]+)/", 1).cast("int").alias("file_no")
    raw = log.filter("schema_name = 'dm_bronze'").select(file_no("object_key"), "object_key", "status", "attempt_count", "record_count")
    rejected = spark.read.json(f"{root}/rejected/profile").groupBy(file_no("_raw_key")).agg(F.count("*").alias("rejected_rows"))
    silver = log.filter("schema_name = 'dm_silver' AND status = 'pending'")
    silver = silver.select(F.substring_index("object_key", "/file=", -1).alias("_folder"), F.col("record_count").alias("pending_rows"))
    joined = raw.withColumn("_folder", file_folder(F.col("object_key"))).join(silver, "_folder", "left").join(rejected, "file_no", "left")
    return joined.select("file_no", "status", "attempt_count", "record_count", "pending_rows", "rejected_rows")


@query
def ledger_by_key(spark, folder):
    """Entries looked up by the keys of the first files, whatever became of them."""
    log = fx.ledger_log(spark, folder)
    keys = [r.object_key for r in fx.customer_manifest(spark, folder).orderBy("record_count").limit(5).collect()]
    found = union_all([ledger.by_object_key(log, key) for key in keys])
    return found.select("object_key", "control_id", "status", "attempt_count", "updated_at")


# --- streams ------------------------------------------------------------------

def _landing(spark: SparkSession, folder: str, path: str) -> None:
    fx.envelopes(spark, folder).select("value").write.text(path)


def _routed(spark: SparkSession, root: str) -> DataFrame:
    """What was delivered, one row per record."""
    place = lambda kind: F.regexp_extract("_metadata.file_path", f"/{kind}/([^/]+)/batch-", 1)
    lines = spark.read.option("recursiveFileLookup", True)
    row = F.from_json("value", columns("event_id bigint, user_id bigint, value double, operation string"))
    none = F.lit(None).cast("string")
    accepted = lines.text(f"{root}/raw").select(place("raw").alias("table_name"), none.alias("drop_reason"), row.alias("row"))
    accepted = accepted.select("table_name", "drop_reason", "row.event_id", "row.operation")
    error = F.from_json("value", columns("table_name string, operation string, value string"))
    event = F.regexp_extract(F.col("row.value"), '"event_id":([0-9]+)', 1).cast("bigint")
    dropped = lines.text(f"{root}/errors").select(place("errors").alias("drop_reason"), error.alias("row"))
    return accepted.unionByName(dropped.select("row.table_name", "drop_reason", event.alias("event_id"), "row.operation"))


@query
def stream_route(spark, folder):
    """Envelopes routed in two runs of one stream; the third finds nothing to do."""
    root = scratch_path(spark, "routed")
    for part in ("a", "b", "b"):
        if part == "a":
            _landing(spark, folder, f"{root}/landing/{part}")
        source = read_cdc_stream(spark, f"{root}/landing", recursiveFileLookup="true")
        _wait(jobs.write_routed_stream(source, root, f"{root}/checkpoint", available_now=True))
    return _routed(spark, root)


@query
def stream_raw_to_bronze(spark, folder):
    """Profiles as they arrive in bronze: masked though the first values are no addresses, incomplete ones rejected."""
    root = scratch_path(spark, "arriving")
    people = _people(spark, folder)
    known = F.col("profile_id") > FIRST_KNOWN
    people = people.withColumns({"email": F.when(known, F.col("email")).otherwise("unknown"), "state": F.when(F.pmod("profile_id", F.lit(50)) != 7, F.col("state"))})
    for part in range(2):  # the second half arrives later
        people.filter(F.pmod("profile_id", F.lit(2)) == part).write.mode("append").option("compression", "gzip").json(f"{root}/raw/profile")
        _wait(jobs.stream_raw_to_bronze(spark, root, "profile", f"{root}/checkpoint", _now(), available_now=True))
    done = spark.read.parquet(f"{root}/bronze/profile").select("profile_id", "profile_name", "email", "state", F.lit(0).alias("rejected"))
    bad = spark.read.json(f"{root}/rejected/profile")
    bad = bad.select(F.col("profile_id").cast("bigint"), "profile_name", F.lit(None).cast("string").alias("email"), F.lit(None).cast("string").alias("state"), F.size("reasons").alias("rejected"))
    # Silver has an entry for as many rows as went to bronze.
    handed = ledger.pending(ledger.read_log(spark, f"{root}/control"), "dm_silver", "profile").agg(F.sum("record_count").alias("handed_on"))
    return done.unionByName(bad).crossJoin(handed)  # a single row


@query
def stream_apply_cdc(spark, folder):
    """Changes streamed into a silver table in two runs; a third finds nothing to do."""
    root = scratch_path(spark, "upserted")
    changes = fx.changes(spark, folder)
    half = F.lit("2024-01-16").cast("timestamp")
    for part in (F.col(cdc.CONTROL_TS) < half, F.col(cdc.CONTROL_TS) >= half, None):
        if part is not None:
            changes.filter(part).write.mode("append").parquet(f"{root}/changes")
        stream = spark.readStream.schema(changes.schema).parquet(f"{root}/changes")
        _wait(jobs.stream_apply_cdc(stream, f"{root}/silver", fx.EVENT_STATE, "user_id", f"{root}/checkpoint", ["event_id"], available_now=True))
    return read_table_state(spark, f"{root}/silver", fx.EVENT_STATE)


@query
def stream_bootstrap(spark, folder):
    """Beers loaded in full while changes of before and after the snapshot are waiting, through to silver."""
    root = scratch_path(spark, "bootstrap")
    beers = fx.beer(spark, folder).select(*ENTITIES["beer"].columns.names)
    abv = F.col("beer_abv")
    operation = F.when(abv > 40, "update").when(abv < 5, "delete").when(abv.between(20, 25), "update")
    made = F.when(abv.between(20, 25), "2024-01-31T23:00:00Z").otherwise("2024-02-01T01:00:00Z")
    changed = beers.withColumns({"beer_name": F.concat("beer_name", F.lit(" (new)")), "operation": operation, "made": made})
    data = F.struct(*beers.columns)
    meta = F.struct(F.lit("beer").alias("table-name"), "operation", F.col("made").alias("timestamp"))
    lines = changed.filter("operation IS NOT NULL").select(F.to_json(F.struct(data.alias("data"), meta.alias("metadata"))).alias("value"))
    lines.write.text(f"{root}/changes/early")
    _wait(jobs.bootstrap_then_stream(spark, {"beer": beers}, F.lit(SNAPSHOT_AT).cast("timestamp"), f"{root}/changes", root, f"{root}/routing", available_now=True))
    _wait(jobs.stream_raw_to_bronze(spark, root, "beer", f"{root}/ingesting", _now(), available_now=True))
    run_silver(spark, root, "beer", _now())
    state = files.read_table(spark, f"{root}/silver/beer", ENTITIES["beer"].silver)
    return state.select("beer_id", "beer_name", "beer_style", F.col("deleted_at").isNotNull().alias("is_deleted"))


# --- jobs ---------------------------------------------------------------------

@query
def job_file_order(spark, folder):
    """A file of old changes is copied in after the newer one was applied: it adds keys, and undoes nothing."""
    root = scratch_path(spark, "file-order")
    people = _people(spark, folder)
    old = people.withColumns({"state": F.lit("old"), "operation": F.when(F.pmod("profile_id", F.lit(3)) == 0, "delete").otherwise("update"), EVENT_TIME: F.lit("2024-01-01T00:00:00Z")})
    new = people.filter(F.pmod("profile_id", F.lit(5)) != 0).withColumns({"state": F.lit("new"), EVENT_TIME: F.lit("2024-01-02T00:00:00Z")})
    for rows in (new, old):
        rows.write.mode("append").option("compression", "gzip").json(f"{root}/raw/profile")
        run_bronze(spark, root, "profile", _now(), mask=None)
        run_silver(spark, root, "profile", _now())
    state = files.read_table(spark, f"{root}/silver/profile", ENTITIES["profile"].silver)
    return state.select("profile_id", "state", F.col("deleted_at").isNotNull().alias("is_deleted"))


@query
def job_mixed_formats(spark, folder):
    """Batch CSV and delivered JSON in one raw folder, each read in its own format and merged by time."""
    root = scratch_path(spark, "mixed")
    people = _people(spark, folder)
    fx.write_csv_gz(people.drop("operation"), f"{root}/raw/profile/dm-batch-process-1")
    delivered = people.filter(F.pmod("profile_id", F.lit(4)) == 0).withColumns({"state": F.lit("moved"), "operation": F.lit("update")})
    fx.write_json_gz(delivered.withColumn(EVENT_TIME, F.lit("2999-01-01T00:00:00Z")), f"{root}/raw/profile/delivered")
    process_files(spark, root, "profile", _now(), raw_listing(spark, root, "profile"), mask=None)
    run_silver(spark, root, "profile", _now())
    state = files.read_table(spark, f"{root}/silver/profile", ENTITIES["profile"].silver)
    return state.select("profile_id", "profile_name", "state")


@query
def pii_masked_probe(spark, folder):
    """The probe of a masked column: how many values of each table column still match a rule, before and after."""
    root = scratch_path(spark, "probe")
    people = _people(spark, folder)
    fx.write_json_gz(people, f"{root}/raw/profile")
    run_bronze(spark, root, "profile", _now())
    stored = spark.read.parquet(f"{root}/bronze/profile")
    tagged = governance.pii_columns(stored)  # the mark is kept in the files
    texts = ["profile_name", "email", "state"]
    parts = []
    for name, rows in (("raw", people), ("bronze", stored)):
        counted = governance.pii_profile(rows, texts).filter("rule = 'email'")
        parts.append(counted.select(F.lit(name).alias("layer"), "field", "row_count", F.col("field").isin(tagged).alias("is_tagged")))
    return union_all(parts)


@query
def guard_empty_input(spark, folder):
    """Events written by kind: a kind without rows is refused and leaves nothing behind."""
    root = scratch_path(spark, "guarded")
    events = fx.table(spark, folder, "events")
    kinds = [r.event_type for r in events.select("event_type").distinct().collect()]
    rows = []
    for kind in [*sorted(kinds), "none such"]:
        try:
            write_parquet(events.filter(F.col("event_type") == kind), f"{root}/{kind}")
        except EmptyInputError:
            rows.append((kind, None, True, path_exists(spark, f"{root}/{kind}")))
        else:
            rows.append((kind, spark.read.parquet(f"{root}/{kind}").count(), False, True))
    return spark.createDataFrame(rows, "event_type string, row_count bigint, is_refused boolean, is_written boolean")


# --- marts and costs --------------------------------------------------------------

@query
def gold_ordered(spark, folder):
    """A mart published in order: files follow each other, and a row's place is its rank."""
    mart = MARTS["top_breweries_by_rating"]
    path = scratch_path(spark, "ordered")
    order = [F.desc(mart.sort), *mart.keys, "review_year", "review_month"]
    publish_ordered(build_mart(fx.review_flat(spark, folder, mart.columns), mart, MIN_REVIEWS[mart.name]), path, *order)
    return read_ordered(spark, path, mart_schema(mart), "rating_rank")


@query
def costs_add_partition(spark, folder):
    """A registered cost table, one of whose periods lies outside its folder."""
    root, period = scratch_path(spark, "cost-table"), "1998-07"
    table = f"costs_{root.rsplit('-', 1)[-1]}"
    rows = fx.costs(spark, folder)
    apart = F.col("billing_period") == period
    rows.filter(~apart).hint("rebalance", F.col("billing_period")).write.partitionBy("billing_period").parquet(f"{root}/table")
    rows.filter(apart).drop("billing_period").write.parquet(f"{root}/elsewhere")
    catalog.register_external(spark, table, rows.schema, f"{root}/table", ("billing_period",))
    catalog.add_partition(spark, table, f"{root}/elsewhere", billing_period=period)
    tags = F.sum(F.size("resource_tags")).alias("tag_count")
    found = spark.table(table).groupBy("billing_period").agg(F.count("*").alias("line_count"), tags)
    return found.select("billing_period", "line_count", F.coalesce("tag_count", F.lit(0)).alias("tag_count"))
