"""The physical plans that large tables depend on."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from sparge import fixtures as fx
from sparge.contracts import COSTS, REVIEW_FLAT
from sparge.operators import costs
from sparge.operators.cdc import fold_changes, merge_upsert
from sparge.operators.flat import DIMENSION_COLUMNS, build_review_flat, orphans
from sparge.operators.marts import MARTS, build_mart
from sparge.plans.dashboards import panel
from sparge.plans.gold import mart_schema, rebuild_months
from sparge.registry.queries import all_queries
from sparge.session import ADVISORY, configure, scratch_path
from sparge.sinks.files import append_partitioned, publish_mart, publish_ordered, read_ordered


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_join_only_what_they_need(spark, folder):
    styles = plan(build_mart(fx.review_flat(spark, folder, MARTS["top_styles_by_popularity"].columns), "top_styles_by_popularity"))
    assert "part.parquet" in styles
    assert not any(f"{t}.parquet" in styles for t in ("orders", "customer", "supplier", "nation"))
    assert "l_quantity" in styles and "l_discount" not in styles


def test_pruned_joins_do_not_change_results(spark, folder):
    for name, mart in MARTS.items():
        pruned = build_mart(fx.review_flat(spark, folder, mart.columns), mart, 1)
        full = build_mart(fx.review_flat(spark, folder), mart, 1)
        assert pruned.exceptAll(full).isEmpty() and full.exceptAll(pruned).isEmpty(), name


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_large_dimensions_are_not_broadcast(spark, folder, no_broadcast):
    text = plan(fx.review_flat(spark, folder))
    assert "Broadcast" not in text and text.count("SortMergeJoin") >= 4


@pytest.mark.parametrize("limit,large", [("-1", ()), ("1m", ("profile",)), ("1m", ("beer", "profile"))])
def test_shuffled_dimensions_come_before_broadcast_ones(spark, limit, large):
    """From the fact outwards: what shuffles the reviews, lesser columns first, and then what is broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, limit)
    try:
        dims = {}
        for dim, (key, supplied) in DIMENSION_COLUMNS.items():
            rows = spark.range(3_000_000 if dim in large else 3).withColumnRenamed("id", key)
            dims[dim] = rows.select(key, *[F.concat(F.lit(c), key).cast(REVIEW_FLAT[c].dataType).alias(c) for c in supplied])
        keys = [key for key, _ in DIMENSION_COLUMNS.values()]
        review = spark.range(5).select(*[F.col("id").alias(k) for k in keys], F.lit("kept").alias("partitioned_at"))
        wanted = [c for c in REVIEW_FLAT.names if c in keys or any(c in s for _, s in DIMENSION_COLUMNS.values())]
        flat = build_review_flat(review, **dims, columns=[*wanted, "partitioned_at"])
        joins = re.findall(r"(SortMerge|BroadcastHash)Join \[(\w+?)_id#", plan(flat))
        order = [dim for _, dim in reversed(joins)]
        assert order == {0: ["brewery", "beer", "profile"], 1: ["profile", "brewery", "beer"], 2: ["beer", "profile", "brewery"]}[len(large)]
        assert flat.count() == 5 and flat.filter("profile_name IS NULL").count() == (0 if large else 2)
    finally:
        spark.conf.set(name, before)


def test_merge_does_not_shuffle_the_table_for_a_small_batch(spark, folder):
    path = scratch_path(spark, "events")
    state = fold_changes(fx.changes(spark, folder), "user_id", ["event_id"]).drop("_inserted_at", "_first_at")
    state.withColumn("created_at", F.col("updated_at")).select(*fx.EVENT_STATE.names).write.parquet(path)
    target = spark.read.schema(fx.EVENT_STATE).parquet(path)
    batch_path = scratch_path(spark, "batch")
    fold_changes(fx.changes(spark, folder).limit(50), "user_id", ["event_id"]).write.parquet(batch_path)
    text = plan(merge_upsert(target, spark.read.parquet(batch_path), "user_id"))
    assert "SortMergeJoin" not in text and "LeftAnti, BuildRight" in text


def test_month_filter_reaches_the_scan(spark, folder):
    path = scratch_path(spark, "flat")
    fx.review_flat(spark, folder).write.parquet(path)
    flat = spark.read.schema(REVIEW_FLAT).parquet(path)
    text = plan(rebuild_months(flat, "state_by_review_volume", [(1998, 7), (1998, 8), (2000, 1)]))
    assert "GreaterThanOrEqual(review_time" in text
    assert "ReadSchema: struct<state:string,review_time:bigint>" in text


def test_dashboards_and_costs_prune_partitions(spark, folder):
    path = scratch_path(spark, "mart")
    publish_mart(build_mart(fx.review_flat(spark, folder, MARTS["state_by_review_volume"].columns), "state_by_review_volume"), path)
    mart = spark.read.schema(mart_schema("state_by_review_volume")).parquet(path)
    text = plan(panel(mart, "state_volume", 1998, 7))
    assert "PartitionFilters: [isnotnull(review_year" in text

    path = scratch_path(spark, "costs")
    append_partitioned(fx.costs(spark, folder), path, "billing_period")
    table = spark.read.schema(COSTS).parquet(path)
    text = plan(costs.costs_by_service(table, "1998-07"))
    assert "PartitionFilters: [isnotnull(billing_period" in text
    assert "ReadSchema: struct<line_item_product_code:string,line_item_unblended_cost:double>" in text
    assert "TakeOrderedAndProject" in text


def test_hot_key_of_a_join_is_split(spark, no_broadcast):
    """A third of the reviews name one profile; AQE reads that partition in several tasks."""
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        ids = spark.range(0, 300_000, numPartitions=8)
        hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5_000)
        review = ids.select(F.col("id").alias("review_id"), hot.alias("profile_id"), F.xxhash64("id").alias("review_time"))
        profile = spark.range(5_000).select(
            F.col("id").alias("profile_id"), F.lit("n").alias("profile_name"), F.lit("e").alias("email"), F.lit("WA").alias("state")
        )
        flat = build_review_flat(review, profile, profile, profile, columns=["review_id", "review_time", "profile_id", "state"])
        rows = flat.groupBy("state").count()
        assert [tuple(r) for r in rows.collect()] == [("WA", 300_000)]
        assert "skew=true" in plan(rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_orphans_reduce_before_a_shuffled_join(spark, folder, no_broadcast):
    text = plan(orphans(fx.review(spark, folder, ("beer_id",)), fx.beer(spark, folder), "beer_id"))
    assert text.index("LeftAnti") < text.index("partial_count")


@pytest.mark.parametrize("name", MARTS)
def test_marts_combine_before_the_shuffle(spark, folder, name):
    text = plan(build_mart(fx.review_flat(spark, folder, MARTS[name].columns), name))
    assert "partial_count(1)" in text and "Sort [review" not in text


def test_null_ratings_and_null_groups(spark):
    flat = spark.createDataFrame([(None, None, 0), (None, 4.0, 0), ("x", 5.0, 0)], "beer_style string, review_overall double, review_time bigint")
    rows = {r.beer_style: (r.total_reviews, r.avg_rating) for r in build_mart(flat, "top_styles_by_popularity", 1).collect()}
    assert rows == {None: (2, 4.0), "x": (1, 5.0)}
    ordered = build_mart(flat, "top_styles_by_popularity", 1, ordered=True).collect()
    assert [r.avg_rating for r in ordered] == [5.0, 4.0]


PANELS = ("dash_top_beers", "dash_top_breweries", "dash_state_volume", "dash_styles", "dash_top_drinkers")
PERIODS = ("costs_by_service", "costs_detail", "costs_daily", "costs_cumulative")


@pytest.mark.parametrize("name", [*PANELS, *PERIODS])
def test_registered_panels_open_one_partition(spark, folder, name):
    text = plan(all_queries()[name](spark, folder))
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", text)
    assert filters and ("billing_period" if name in PERIODS else "review_year") in filters[1]
    assert "lineitem.parquet" not in text


@pytest.mark.parametrize("name", ["dash_years", "dash_months", "costs_periods"])
def test_registered_pickers_read_no_column(spark, folder, name):
    text = plan(all_queries()[name](spark, folder))
    assert "ReadSchema: struct<>" in text and "lineitem.parquet" not in text


def test_marts_are_published_once(spark, folder):
    first = all_queries()["dash_years"](spark, folder).inputFiles()
    assert sorted(first) == sorted(all_queries()["dash_months"](spark, folder).inputFiles())


def test_ordered_files_follow_each_other(spark, tmp_path):
    rows = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("value"), F.lit("x").alias("other"))
    publish_ordered(rows, f"{tmp_path}/o", F.desc("value"))
    read = read_ordered(spark, f"{tmp_path}/o", rows.schema)
    assert all(r["rank"] == 5000 - r.value for r in read.collect())
    assert spark.read.parquet(f"{tmp_path}/o").select(F.input_file_name()).distinct().count() > 1


def test_tasks_stay_small_however_large_the_input(spark):
    """What AQE may join to one task has a bound, and the partitions it starts from grow with the input."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before, partitions = spark.conf.get(ADVISORY), spark.conf.get(initial, None)
    try:
        for given, kept in (("64MB", "16777216b"), ("1g", "16777216b"), ("8m", "8m")):
            spark.conf.set(ADVISORY, given)
            assert configure(spark).conf.get(ADVISORY) == kept
        for gigabytes in (6, 60):
            assert int(configure(spark, gigabytes << 30).conf.get(initial)) == gigabytes * 32
        assert int(configure(spark, 1 << 30).conf.get(initial)) == 60 * 32
    finally:
        spark.conf.set(ADVISORY, before)
        spark.conf.set(initial, partitions) if partitions else spark.conf.unset(initial)
