"""Daily partials of the rolling screens.

A rolling screen reads the raw facts of all days of its window, each day. Its partials hold
what one day adds, by source: written once a day (``write_fact`` with ``rewrite``), they are
summed over the window instead. The sums are exact, so a report from partials equals the
report from facts; a day's partials are a few rows per source, or one per source and IP.

Partials carry the day as ``date`` and are pruned like any table of dates. The rules that
choose rows (excluded providers and sources) are fixed when partials are made; windows and
thresholds are those of the report.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.functions import period
from adlytics.plans import fraud


def daily_ips(
    installs: DataFrame, excluded_providers: Sequence[int] = fraud.EXCLUDED_PROVIDERS
) -> DataFrame:
    """Installs per day, source and IP."""
    return (
        installs.where(~F.col("source_provider_id").isin(*excluded_providers))
        .withColumn("date", F.to_date("install_time"))
        .groupBy("date", *fraud.SUB_PUBLISHER_COUNTRY, "ip")
        .agg(F.count("ip").alias("uses"))
    )


def duplicate_ip_sources(
    ips: DataFrame,
    apps: DataFrame,
    as_of: date,
    days: int = 2,
    min_total: int = 20,
    max_ratio: Decimal = Decimal("0.90"),
) -> DataFrame:
    """``fraud.duplicate_ip_sources`` from ``daily_ips``."""
    per_ip = (
        period.since_day(ips, "date", period.days_before(as_of, days))
        .groupBy(*fraud.SUB_PUBLISHER_COUNTRY, "ip")
        .agg(F.sum("uses").alias("uses"))
    )
    return fraud.reused_ips(per_ip, apps, min_total, max_ratio)


def daily_counts(facts: DataFrame) -> DataFrame:
    """Rows per day and source, and how many of them at midnight sharp.

    The screen's window begins after midnight, which only the first day of a window knows.
    """
    midnight = F.col("install_time") == F.to_date("install_time").cast("timestamp_ntz")
    return (
        facts.withColumn("date", F.to_date("install_time"))
        .groupBy("date", *fraud.SUB_PUBLISHER_COUNTRY)
        .agg(
            F.count("install_time").alias("rows"),
            F.count(F.when(midnight, F.col("install_time"))).alias("at_midnight"),
        )
    )


def installs_without_events(
    installs: DataFrame, events: DataFrame, as_of: date, days: int = 7, min_installs: int = 10
) -> DataFrame:
    """``fraud.installs_without_events`` from ``daily_counts`` of installs and of events."""
    start = period.days_before(as_of, days)

    def counted(partials: DataFrame, name: str) -> DataFrame:
        inside = F.col("rows") - F.when(F.col("date") == F.lit(start), F.col("at_midnight")).otherwise(0)
        return (
            period.since_day(partials, "date", start)
            .groupBy(*fraud.SUB_PUBLISHER_COUNTRY)
            .agg(F.sum(inside).alias(name))
            .where(F.col(name) > 0)
        )

    enough = counted(installs, "installs").where(F.col("installs") >= min_installs)
    return fraud.without_events(enough, counted(events, "events"))


def daily_export(
    daily_events: DataFrame, excluded_sources: Sequence[str] = fraud.SELF_ATTRIBUTING_SOURCES
) -> DataFrame:
    """Installs and events of the export per day and source."""
    return fraud.export_totals(daily_events, ("date", *fraud.EXPORT_SOURCE), excluded_sources)


def aggregated_no_events(
    totals: DataFrame, as_of: date, days: int = 5, min_installs: int = 5
) -> DataFrame:
    """``fraud.aggregated_no_events`` from ``daily_export``."""
    summed = (
        period.since_day(totals, "date", period.days_before(as_of, days))
        .groupBy(*fraud.EXPORT_SOURCE)
        .agg(F.sum("installs").alias("installs"), F.sum("events").alias("events"))
    )
    return fraud.silent_sources(summed, min_installs)
