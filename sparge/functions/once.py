"""Costly expressions evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read instead of recomputing.

    Catalyst moves a filter below the projection that defines its input by copying
    the defining expression into the filter. That is right for cheap expressions,
    but parses a text once per use. Filters do not move below a generator, so the
    columns come out of one that makes exactly one row.
    """
    values = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    return df.select("*", F.inline_outer(values))
