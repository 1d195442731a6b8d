"""Dashboard panels over the marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sparge.operators.marts import top_k


@dataclass(frozen=True)
class Panel:
    """Shown columns by title, for one month; with `by`, only the `k` largest.

    `ties` settle which rows are shown among equals.
    """

    shown: dict[str, str]
    by: str | None = None
    ties: tuple[str, ...] = ()
    k: int = 10


PANELS = {
    "top_beers": Panel({"Beer": "beer_name", "Avg Rating": "avg_rating"}, "avg_rating", ("beer_name", "beer_id")),
    "top_breweries": Panel(
        {"Brewery": "brewery_name", "Avg Rating": "avg_rating"}, "avg_rating", ("brewery_name", "brewery_id")
    ),
    "state_volume": Panel({"State": "state", "Reviews": "total_reviews"}),
    "styles": Panel({"Style": "beer_style", "Reviews": "total_reviews", "Avg Rating": "avg_rating"}),
    "top_drinkers": Panel(
        {"Profile": "profile_name", "Tastings": "total_reviews"}, "total_reviews", ("profile_name", "profile_id")
    ),
}


def panel(mart: DataFrame, name: str, review_year: int, review_month: int) -> DataFrame:
    """One panel of a mart, e.g. `panel(mart, "styles", 1998, 7)`.

    The month is compared with the partition columns, so only its folder is read.
    """
    chosen = PANELS[name]
    rows = mart.filter((F.col("review_year") == review_year) & (F.col("review_month") == review_month))
    if chosen.by:
        rows = top_k(rows, chosen.by, chosen.k, chosen.ties)
    return rows.select(*[F.col(column).alias(title) for title, column in chosen.shown.items()])


def years(mart: DataFrame) -> DataFrame:
    """Years to pick from, latest first."""
    return _choices(mart, "review_year", F.col("review_year").cast("string")).orderBy(F.desc("review_year"))


def months(mart: DataFrame) -> DataFrame:
    """Months to pick from, as two digits."""
    return _choices(mart, "review_month", F.lpad(F.col("review_month").cast("string"), 2, "0")).orderBy("review_month")


def _choices(mart: DataFrame, name: str, text: Column) -> DataFrame:
    return mart.select(name).distinct().select(text.alias(name))
