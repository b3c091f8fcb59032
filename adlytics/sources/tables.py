"""Reading the input tables and writing facts and reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.functions.latency import CLICK_TIME, clicked
from adlytics.functions.period import CLICK_DAY_PARTITION, DAY_PARTITION
from adlytics.sources.schemas import SCHEMAS

AS_OF_PARTITION = "as_of"
#: Columns a stored table has besides those of its schema, by layout.
LAYOUTS: dict[str, str] = {
    "plain": "",
    "day": f", {DAY_PARTITION} date",
    "click_day": f", {CLICK_TIME} timestamp_ntz, {CLICK_DAY_PARTITION} date",
}


def read_tables(
    spark: SparkSession,
    root: str,
    names: Iterable[str] = tuple(SCHEMAS),
    source_format: str = "parquet",
    partitioned: Iterable[str] = (),
    layouts: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Lazy scans of ``root/<table>``, by table name.

    ``layouts`` says how a table was stored: ``day`` by ``write_fact``, ``click_day`` by
    ``write_clicks``, ``plain`` (the default) with the columns of its schema alone. The
    partition column is read too, and the report windows prune on it. ``partitioned``
    names tables of the layout ``day``.
    """
    stored = {**dict.fromkeys(partitioned, "day"), **(layouts or {})}
    if unknown := set(stored.values()) - set(LAYOUTS):
        raise ValueError(f"no such layout: {', '.join(sorted(unknown))}")
    return {
        name: spark.read.schema(SCHEMAS[name] + LAYOUTS[stored.get(name, "plain")])
        .format(source_format)
        .load(f"{root}/{name}")
        for name in names
    }


def write_fact(facts: DataFrame, path: str, timestamp: str, rewrite: bool = False) -> None:
    """Writes a fact table as Parquet, partitioned by the day of ``timestamp``.

    Rows are brought together by day and in pieces of about the advisory partition size,
    so that a day holding much of the table is written by several tasks. With ``rewrite``
    the days that ``facts`` holds replace those stored before, and other days stay: a
    repeated run of a day leaves the table as the first one did. Without it an existing
    table raises.
    """
    _by_day(facts.withColumn(DAY_PARTITION, F.to_date(timestamp)), path, DAY_PARTITION, rewrite)


def write_clicks(
    installs: DataFrame, path: str, strict: bool = False, rewrite: bool = False
) -> None:
    """Writes installs with their click time as a column, partitioned by the click's day.

    The click-to-install report then reads the days of its window instead of all history.
    Installs without a click time are in a partition of their own. ``rewrite`` is that of
    ``write_fact``, by click day.
    """
    clicks = installs.withColumn(CLICK_TIME, clicked(installs, strict)).withColumn(
        CLICK_DAY_PARTITION, F.to_date(CLICK_TIME)
    )
    _by_day(clicks, path, CLICK_DAY_PARTITION, rewrite)


def _by_day(rows: DataFrame, path: str, day: str, rewrite: bool) -> None:
    (
        rows.hint("rebalance", day)
        .write.mode("overwrite" if rewrite else "error")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def write_report(
    report: DataFrame, path: str, target_format: str = "parquet", as_of: date | None = None
) -> None:
    """Writes a report; an existing one is left alone and raises.

    With ``as_of`` the report is one of a series of days below ``path``: that day is
    replaced, by an empty report too, and the others stay. Reading ``path`` gives all days,
    with their date as the column ``as_of``.
    """
    if as_of is None:
        report.write.mode("error").format(target_format).save(path)
    else:
        own = f"{path.rstrip('/')}/{AS_OF_PARTITION}={as_of.isoformat()}"
        report.write.mode("overwrite").format(target_format).save(own)
