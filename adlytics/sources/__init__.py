"""Input tables: declared schemas, reading and writing."""

from adlytics.sources.contract import count_repeats, counted
from adlytics.sources.schemas import SCHEMAS
from adlytics.sources.tables import (
    LAYOUTS,
    read_tables,
    write_clicks,
    write_fact,
    write_report,
)

__all__ = [
    "LAYOUTS",
    "SCHEMAS",
    "count_repeats",
    "counted",
    "read_tables",
    "write_clicks",
    "write_fact",
    "write_report",
]
