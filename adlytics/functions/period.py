"""Date-window predicates that reach the scan.

Bounds are literals of the compared column's own kind, so Parquet gets them as pushed
filters. Fact tables written by ``adlytics.sources.write_fact`` also carry a partition
column holding the day; where it is present the same window prunes partitions.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_PARTITION = "day_partition"
CLICK_DAY_PARTITION = "click_day_partition"


def _midnight(day: date) -> Column:
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def days_before(as_of: date, days: int) -> date:
    return as_of - timedelta(days=days)


def _prune(facts: DataFrame, first: date, last: date | None = None) -> DataFrame:
    if DAY_PARTITION not in facts.columns:
        return facts
    kept = F.col(DAY_PARTITION) >= F.lit(first)
    if last is not None:
        kept = kept & (F.col(DAY_PARTITION) <= F.lit(last))
    return facts.where(kept)


def since(facts: DataFrame, timestamp: str, day: date, strictly: bool = False) -> DataFrame:
    """Rows at or after midnight of ``day`` (after it when ``strictly``)."""
    start = _midnight(day)
    column = F.col(timestamp)
    return _prune(facts, day).where(column > start if strictly else column >= start)


def between_days(facts: DataFrame, timestamp: str, start: date, end: date) -> DataFrame:
    """Rows from midnight of ``start`` to 23:59:59 of ``end``, both included.

    The last fraction of a second of ``end`` is outside, as in the report definition.
    """
    last_second = F.lit(f"{end.isoformat()} 23:59:59").cast("timestamp_ntz")
    return _prune(facts, start, end).where(
        F.col(timestamp).between(_midnight(start), last_second)
    )


def since_day(facts: DataFrame, column: str, day: date) -> DataFrame:
    """Rows of a table of dates from ``day`` on."""
    return _prune(facts, day).where(F.col(column) >= F.lit(day))


def between_dates(facts: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Rows of a table of dates from ``start`` to ``end``, both included."""
    return _prune(facts, start, end).where(F.col(column).between(F.lit(start), F.lit(end)))


def since_click_day(installs: DataFrame, day: date) -> DataFrame:
    """Rows stored by click day, from ``day`` on; other tables as they are."""
    if CLICK_DAY_PARTITION not in installs.columns:
        return installs
    return installs.where(F.col(CLICK_DAY_PARTITION) >= F.lit(day))
