"""Calendar keys. The session zone is UTC (see `session.configure`)."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, functions as F


def partition_day(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def review_year(epoch_seconds: Column) -> Column:
    return F.year(F.timestamp_seconds(epoch_seconds))


def review_month(epoch_seconds: Column) -> Column:
    return F.month(F.timestamp_seconds(epoch_seconds))


def month_start(year: int, month: int) -> int:
    """Epoch seconds at the start of a month; month 13 is the next January."""
    year, month = (year + 1, 1) if month == 13 else (year, month)
    return int(datetime(year, month, 1, tzinfo=timezone.utc).timestamp())


def month_ranges(months: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open epoch ranges that cover the months; neighbouring months share one."""
    ranges: list[tuple[int, int]] = []
    for year, month in sorted(set(months)):
        start, end = month_start(year, month), month_start(year, month + 1)
        if ranges and ranges[-1][1] == start:
            start = ranges.pop()[0]
        ranges.append((start, end))
    return ranges


def in_months(epoch_seconds: Column, months: Iterable[tuple[int | None, int | None]]) -> Column:
    """Month test as plain ranges on the stored column, which Parquet row groups can answer."""
    months = list(months)
    test = epoch_seconds.isNull() if (None, None) in months else F.lit(False)
    for start, end in month_ranges(m for m in months if m != (None, None)):
        test = test | ((epoch_seconds >= start) & (epoch_seconds < end))
    return test


def interval_day(interval: Column) -> Column:
    """Day of the start of an ISO `start/end` interval."""
    start = F.replace(F.split_part(interval, F.lit("/"), F.lit(1)), F.lit("Z"), F.lit(""))
    return F.date_trunc("day", F.to_timestamp(start, "yyyy-MM-dd'T'HH:mm:ss"))


def duration_ms(started: Column, finished: Column) -> Column:
    return F.unix_millis(finished) - F.unix_millis(started)
