"""Cost-and-usage aggregates for one billing period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparge.functions.time import interval_day
from sparge.operators.marts import top_k


def _cost() -> Column:
    # Decimal sums do not depend on the order tasks finish in; line items carry up to 12 decimals.
    cost = F.col("line_item_unblended_cost").cast("double").cast("decimal(28,12)")
    return F.sum(cost).cast("double")


def billing_periods(costs: DataFrame) -> DataFrame:
    return costs.select("billing_period").distinct().orderBy(F.desc("billing_period"))


def _period(costs: DataFrame, billing_period: str) -> DataFrame:
    return costs.filter(F.col("billing_period") == billing_period)


def costs_by_service(costs: DataFrame, billing_period: str, k: int = 10) -> DataFrame:
    totals = _period(costs, billing_period).groupBy(F.col("line_item_product_code").alias("Service"))
    return top_k(totals.agg(_cost().alias("Total Cost")), "Total Cost", k, ["Service"])


def costs_detail(costs: DataFrame, billing_period: str) -> DataFrame:
    return (
        _period(costs, billing_period)
        .groupBy(
            F.col("line_item_line_item_type").alias("Type"),
            F.col("line_item_product_code").alias("Service"),
            F.col("line_item_usage_type").alias("Usage Type"),
        )
        .agg(_cost().alias("Cost"))
        .orderBy(F.desc("Cost"), "Type", "Service", "Usage Type")
    )


def costs_daily(costs: DataFrame, billing_period: str) -> DataFrame:
    return _by_day(costs, billing_period).select("Time", F.col("_day_cost").cast("double").alias("Total Cost")).orderBy("Time")


def costs_cumulative(costs: DataFrame, billing_period: str) -> DataFrame:
    """Running total by day; the unpartitioned window sees one row per day of the period."""
    running = F.sum("_day_cost").over(Window.orderBy("Time"))
    return _by_day(costs, billing_period).select("Time", running.cast("double").alias("Cumulative Cost")).orderBy("Time")


def _by_day(costs: DataFrame, billing_period: str) -> DataFrame:
    cost = F.col("line_item_unblended_cost").cast("double").cast("decimal(28,12)")
    return (
        _period(costs, billing_period)
        .groupBy(interval_day(F.col("identity_time_interval")).alias("Time"))
        .agg(F.sum(cost).alias("_day_cost"))
    )
