"""Small helpers for hand-made rows and plans."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame


def plain(value):
    return float(value) if isinstance(value, Decimal) else value


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as tuples in a stable order, decimals as floats."""
    wanted = columns or df.columns
    found = [tuple(plain(row[c]) for c in wanted) for row in df.collect()]
    return sorted(found, key=str)


def plan(df: DataFrame) -> str:
    """Physical plan before any re-planning."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]
