"""Relational building blocks shared by the reports."""

from adlytics.operators.asof import asof_join, asof_join_bucketed, asof_join_unkeyed
from adlytics.operators.pivot import conditional_max, conditional_sum

__all__ = [
    "asof_join",
    "asof_join_bucketed",
    "asof_join_unkeyed",
    "conditional_max",
    "conditional_sum",
]
