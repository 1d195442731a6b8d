"""Monthly marts over the flat review table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sparge.functions.time import review_month, review_year
from sparge.operators.cdc import active


@dataclass(frozen=True)
class Mart:
    """One monthly aggregate: group keys, measures in output order, threshold, sort measure."""

    name: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    min_reviews: int
    sort: str

    @property
    def columns(self) -> tuple[str, ...]:
        """Flat columns the mart reads."""
        rating = ("review_overall",) if "avg_rating" in self.measures else ()
        return (*self.keys, *rating, "review_time")


MARTS = {
    m.name: m
    for m in (
        Mart("top_beers_by_rating", ("beer_id", "beer_name", "beer_style"), ("avg_rating", "total_reviews"), 25, "avg_rating"),
        Mart("top_breweries_by_rating", ("brewery_id", "brewery_name"), ("avg_rating", "total_reviews"), 25, "avg_rating"),
        Mart("state_by_review_volume", ("state",), ("total_reviews",), 0, "total_reviews"),
        Mart("top_styles_by_popularity", ("beer_style",), ("total_reviews", "avg_rating"), 25, "avg_rating"),
        Mart("top_drinkers", ("profile_id", "profile_name", "state"), ("total_reviews", "avg_rating"), 0, "total_reviews"),
    )
}


def build_mart(
    flat: DataFrame,
    mart: Mart | str,
    min_reviews: int | None = None,
    ordered: bool = False,
    active_only: bool = False,
) -> DataFrame:
    """Aggregate reviews by the mart's keys and review month.

    Null keys from unmatched dimensions form their own group, `total_reviews` counts
    rows without a rating and `avg_rating` leaves them out. The sort is for reading;
    before a partitioned write it would only cost a shuffle.
    """
    mart = MARTS[mart] if isinstance(mart, str) else mart
    measures = {"avg_rating": F.avg("review_overall"), "total_reviews": F.count("*")}
    rows = active(flat) if active_only else flat
    result = rows.groupBy(
        *mart.keys,
        review_year(F.col("review_time")).alias("review_year"),
        review_month(F.col("review_time")).alias("review_month"),
    ).agg(*[measures[m].alias(m) for m in mart.measures])
    threshold = mart.min_reviews if min_reviews is None else min_reviews
    if threshold:
        result = result.filter(F.col("total_reviews") >= threshold)
    if ordered:
        result = result.orderBy(F.desc(mart.sort), *mart.keys, "review_year", "review_month")
    return result


def top_k(df: DataFrame, measure: str, k: int = 10, tie: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest measure; `tie` columns make the choice definite."""
    return df.orderBy(F.desc(measure), *tie).limit(k)
