"""Wall-clock time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def seconds_between(start: Column, end: Column) -> Column:
    """Signed seconds from start to end, for timestamps without time zone."""
    return (end - start).cast("interval second").cast("bigint")


def month_of(ts: Column) -> Column:
    """'yyyy-MM' of a date or wall-clock time, whatever the session time zone."""
    return F.substring(ts.cast("string"), 1, 7)


def next_month(month: str) -> str:
    year, number = map(int, month.split("-"))
    return f"{year + 1:04d}-01" if number == 12 else f"{year:04d}-{number + 1:02d}"


def in_months(column: str, months: tuple[str, ...]) -> Column:
    """Rows whose date or wall-clock time lies in the given months.

    Written as ranges on the stored column, so that they reach the scan and
    prune files or partitions; adjoining months make one range.
    """
    ranges: list[list[str]] = []
    for month in sorted(months):
        if ranges and ranges[-1][1] == month:
            ranges[-1][1] = next_month(month)
        else:
            ranges.append([month, next_month(month)])
    value = F.col(column)
    hit = F.lit(False)
    for i, (a, b) in enumerate(ranges):
        inside = (value >= F.lit(f"{a}-01").cast("timestamp_ntz")) & (value < F.lit(f"{b}-01").cast("timestamp_ntz"))
        hit = inside if i == 0 else hit | inside
    return hit
