"""Denormalised review fact and referential checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from sparge.contracts import REVIEW_FLAT
from sparge.functions.time import review_month, review_year
from sparge.session import may_broadcast

# Which dimension supplies which column of the flat table, and by which key of the fact.
DIMENSION_COLUMNS = {
    "beer": ("beer_id", ("beer_name", "beer_style", "beer_abv")),
    "brewery": ("brewery_id", ("brewery_name",)),
    "profile": ("profile_id", ("profile_name", "email", "state")),
}

# Bytes that a column adds to a row, as the optimizer assumes; 8 where it is not text.
_WIDTH = {T.StringType(): 20}


def build_review_flat(
    review: DataFrame,
    beer: DataFrame,
    brewery: DataFrame,
    profile: DataFrame,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Reviews left-joined to beer, brewery and profile by the review's own keys.

    Silver dimensions hold one row per key, so a left join never changes the number
    of reviews; with `columns`, dimensions that supply none of them are not joined.
    No join is hinted: Spark broadcasts a dimension when its size allows, and AQE
    splits a hot key's partition in the sort-merge join otherwise. Joins that shuffle
    the reviews come first, those that add little before those that add more: what a
    shuffle carries is then no wider than it has to be.
    """
    wanted = list(columns or REVIEW_FLAT.names)
    parts = []
    for name, dim in {"beer": beer, "brewery": brewery, "profile": profile}.items():
        key, supplied = DIMENSION_COLUMNS[name]
        used = [c for c in supplied if c in wanted]
        if used:
            part = dim.select(key, *used)
            parts.append((may_broadcast(part), sum(_WIDTH.get(REVIEW_FLAT[c].dataType, 8) for c in used), key, used, part))
    flat = review
    for _, _, key, used, part in sorted(parts, key=lambda p: p[:2]):
        flat = flat.drop(*used).join(part, key, "left")
    return flat.select(*wanted)


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keys of the fact that the dimension lacks, with their row counts.

    The fact is reduced to its distinct keys before the join, so a hot key costs
    one row. Null keys reference nothing and are not orphans.
    """
    counts = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    return counts.join(dim.select(key), key, "left_anti")


def affected_months(flat: DataFrame, days: Sequence[str], by_day: bool = False) -> DataFrame:
    """Distinct review months of the rows stored under the given processing days.

    Reviews without a time have the month `(null, null)`.
    """
    changed = flat.filter(F.col("partitioned_at").isin(sorted(days)))
    day = [F.col("partitioned_at").alias("day")] if by_day else []
    return changed.select(
        *day,
        review_year(F.col("review_time")).alias("review_year"),
        review_month(F.col("review_time")).alias("review_month"),
    ).distinct()
