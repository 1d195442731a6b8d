"""Flat review table to monthly marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sparge.contracts import REVIEW_FLAT
from sparge.functions.keys import layer_schema
from sparge.functions.time import in_months
from sparge.operators import ledger
from sparge.operators.flat import affected_months
from sparge.operators.marts import MARTS, Mart, build_mart
from sparge.plans.control import run_entries
from sparge.plans.silver import MONTHS
from sparge.sinks.files import publish_mart, replace_partitions
from sparge.sources.files import read_or_empty, read_partitions


def mart_schema(mart: Mart | str) -> T.StructType:
    mart = MARTS[mart] if isinstance(mart, str) else mart
    types = {f.name: f.dataType for f in REVIEW_FLAT.fields} | {
        "review_year": T.IntegerType(),
        "review_month": T.IntegerType(),
        "avg_rating": T.DoubleType(),
        "total_reviews": T.LongType(),
    }
    names = (*mart.keys, *mart.measures, "review_year", "review_month")
    return T.StructType([T.StructField(n, types[n]) for n in names])


def rebuild_months(flat: DataFrame, mart: Mart | str, months: Sequence[tuple[int, int]], **options) -> DataFrame:
    """The mart recomputed for whole months only.

    Months are ranges on the stored `review_time`, which the Parquet scan can skip
    row groups by.
    """
    return build_mart(flat.filter(in_months(F.col("review_time"), months)), mart, **options)


def refresh_months(
    spark: SparkSession, flat: DataFrame, mart: Mart | str, path: str, months: Sequence[tuple[int, int]], **options
) -> None:
    """Recompute and replace months; a month whose groups all miss the threshold is emptied."""
    if months:
        result = rebuild_months(flat, mart, months, **options)
        replace_partitions(spark, result, path, months, "review_year", "review_month")


def refresh_mart(
    spark: SparkSession, flat: DataFrame, mart: Mart | str, path: str, days: Sequence[str], **options
) -> list[tuple[int, int]]:
    """Recompute the months that the given processing days touch; one row per month is collected."""
    months = _months(affected_months(flat, days))
    refresh_months(spark, flat, mart, path, months, **options)
    return months


def _months(df: DataFrame) -> list[tuple[int, int]]:
    rows = df.select("review_year", "review_month").distinct().collect()
    return sorted([(r.review_year, r.review_month) for r in rows], key=str)


def append_days(
    spark: SparkSession, flat_path: str, mart: Mart | str, path: str, days: Sequence[str], **options
) -> None:
    """Append the aggregates of the given processing days alone.

    A month fed on two days then has two rows per key; with `refresh_mart` it has one.
    """
    flat = read_partitions(spark, flat_path, days, REVIEW_FLAT)
    publish_mart(build_mart(flat, mart, **options), path, mode="append")


def run_mart(spark: SparkSession, root: str, name: str, now: Column, **options) -> list[tuple[int, int]]:
    """Refresh one mart for its pending days; returns the months rewritten."""
    done: list[tuple[int, int]] = []

    def work(started: DataFrame) -> None:
        days = ledger.entry_days(started)
        log = read_or_empty(spark, f"{root}/control_months", MONTHS)
        months = _months(log.filter(F.col("day").isin(list(days))))
        flat = spark.read.schema(REVIEW_FLAT).parquet(f"{root}/silver/review_flat")
        refresh_months(spark, flat, name, f"{root}/gold/{name}", months, **options)
        done.extend(months)

    run_entries(spark, root, layer_schema("gold"), name, now, work)
    return done
