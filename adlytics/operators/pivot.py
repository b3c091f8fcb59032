"""Tall-to-wide pivots as conditional aggregates.

The column list is known, so one ``groupBy`` with one conditional aggregate per column
does it in a single shuffle; ``DataFrame.pivot`` would need two. A value that does not
occur gives NULL, not 0.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def conditional_sum(
    label: Column, columns: Mapping[str, str], measure: Column, guard: Column | None = None
) -> list[Column]:
    """One ``sum(measure)`` per label; ``guard`` further limits the rows counted."""
    return [
        F.sum(F.when(_hit(label, value, guard), measure)).alias(name)
        for value, name in columns.items()
    ]


def conditional_max(label: Column, columns: Mapping[str, str], measure: Column) -> list[Column]:
    """One ``max(measure)`` per label."""
    return [
        F.max(F.when(label == value, measure)).alias(name) for value, name in columns.items()
    ]


def _hit(label: Column, value: str, guard: Column | None) -> Column:
    return label == value if guard is None else guard & (label == value)
