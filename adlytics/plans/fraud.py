"""Install-fraud screens.

All screens take an explicit ``as_of`` day, so a result can be reproduced later. A fact
table is read once and aggregated before any join: a source that holds a large share of
all installs is combined on the map side and crosses the network as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.functions import latency, period
from adlytics.operators.pivot import conditional_sum

SUB_PUBLISHER = ("app_id", "network_name", "network_publisher", "network_sub_publisher")
SUB_PUBLISHER_COUNTRY = (*SUB_PUBLISHER, "country_code")
EXPORT_SOURCE = ("app_id", "app_name", "country_code", "media_source", "campaign")

# Defaults of the screens.
EXCLUDED_PROVIDERS = (3,)
SELF_ATTRIBUTING_SOURCES = ("googleadwords_int", "Facebook Ads")
NON_EVENT_NAMES = ("impressions", "clicks", "conversions", "total_revenue")
ORGANIC = "Organic"


def _with_cohort(
    installs: DataFrame, as_of: date, app_ids: Sequence[int], days: int, strict: bool
) -> DataFrame:
    recent = period.since(installs, "install_time", period.days_before(as_of, days))
    elapsed = latency.latency_micros(F.col("click_time"), F.col("install_time"))
    # The click time is parsed once, then bucketed.
    return (
        recent.where(F.col("app_id").isin(*app_ids))
        .select(*SUB_PUBLISHER, "install_time", latency.clicked(installs, strict))
        .select(*SUB_PUBLISHER, latency.cohort_label(elapsed).alias("classification"))
    )


def install_cohorts(
    installs: DataFrame,
    as_of: date,
    app_ids: Sequence[int] = (1, 2, 3),
    days: int = 7,
    strict: bool = False,
) -> DataFrame:
    """Installs per sub-publisher and time-to-install cohort.

    Cohorts include their bound; a missing click time counts as the slowest one, and so does
    one that cannot be read, unless ``strict`` makes it an error.
    """
    return (
        _with_cohort(installs, as_of, app_ids, days, strict)
        .groupBy(*SUB_PUBLISHER, "classification")
        .agg(F.count("app_id").alias("total_installs"))
    )


def cohort_pivot(
    installs: DataFrame,
    as_of: date,
    app_ids: Sequence[int] = (1, 2, 3),
    days: int = 7,
    strict: bool = False,
) -> DataFrame:
    """Cohorts as columns beside the total, per sub-publisher, in one shuffle.

    A cohort without installs is NULL. Sources that are not fully known (any of the four
    names NULL) get a total but no cohorts: such a source equals no other source.
    """
    known = F.lit(True)
    for column in SUB_PUBLISHER:
        known = known & F.col(column).isNotNull()
    cohorts = {label: label for label in (">120", "<120", "<30")}
    return (
        _with_cohort(installs, as_of, app_ids, days, strict)
        .groupBy(*SUB_PUBLISHER)
        .agg(
            F.count("app_id").alias("total_installs"),
            *conditional_sum(F.col("classification"), cohorts, F.lit(1), known),
        )
    )


def fast_install_share(pivoted: DataFrame, apps: DataFrame) -> DataFrame:
    """Adds the share of installs within 30 seconds and the app name.

    An app listed more than once under one name gives one row.
    """
    named = apps.select(F.col("id").alias("__app"), "name").distinct()
    return (
        pivoted.join(named, F.col("app_id") == F.col("__app"), "inner")
        .drop("__app")
        .select(
            *pivoted.columns,
            (F.col("<30") / F.col("total_installs")).alias("<30_volume"),
            "name",
        )
    )


def click_to_install(
    installs: DataFrame,
    apps: DataFrame,
    as_of: date,
    days: int = 7,
    excluded_providers: Sequence[int] = EXCLUDED_PROVIDERS,
    strict: bool = False,
) -> DataFrame:
    """Installs per source, country and click-to-install bucket (hours, then days).

    The window is on the click time, so installs without one are left out, and so are those
    whose click time cannot be read, unless ``strict`` makes it an error. Facts that
    ``write_clicks`` has stored by click day are pruned to the window. Installs are
    counted before the join; an app listed more than once under one name multiplies them.
    """
    elapsed = latency.latency_micros(F.col("click_time"), F.col("install_time"))
    recent = period.days_before(as_of, days)
    counted = (
        period.since_click_day(installs, recent)
        .where(~F.col("source_provider_id").isin(*excluded_providers))
        .select(*SUB_PUBLISHER_COUNTRY, "install_time", latency.clicked(installs, strict))
        .where(F.col("click_time") >= F.lit(recent))
        .select(
            *SUB_PUBLISHER_COUNTRY, latency.distribution_label(elapsed).alias("classification")
        )
        .groupBy(*SUB_PUBLISHER_COUNTRY, "classification")
        .agg(F.count("classification").alias("__rows"))
    )
    named = apps.groupBy(F.col("id").alias("__app"), "name").agg(
        F.count(F.lit(1)).alias("__copies")
    )
    return counted.join(named, F.col("app_id") == F.col("__app"), "inner").select(
        "name",
        *SUB_PUBLISHER_COUNTRY,
        "classification",
        (F.col("__rows") * F.col("__copies")).alias("total_count"),
    )


def duplicate_ip_sources(
    installs: DataFrame,
    apps: DataFrame,
    as_of: date,
    days: int = 2,
    min_total: int = 20,
    max_ratio: Decimal = Decimal("0.90"),
    excluded_providers: Sequence[int] = EXCLUDED_PROVIDERS,
) -> DataFrame:
    """Sources whose installs come from few distinct IP addresses.

    Counting in two steps (per source and IP, then per source) spreads a hot source over
    the cluster by IP before its distinct IPs meet. The ratio is compared in exact
    decimals, and only where the count is large enough to divide by.
    """
    per_ip = (
        period.since(installs, "install_time", period.days_before(as_of, days))
        .where(~F.col("source_provider_id").isin(*excluded_providers))
        .groupBy(*SUB_PUBLISHER_COUNTRY, "ip")
        .agg(F.count("ip").alias("uses"))
    )
    return reused_ips(per_ip, apps, min_total, max_ratio)


def reused_ips(
    per_ip: DataFrame, apps: DataFrame, min_total: int, max_ratio: Decimal
) -> DataFrame:
    """Sources with few distinct IPs, from one row (source, IP, uses) each."""
    reused = (
        per_ip.groupBy(*SUB_PUBLISHER_COUNTRY)
        .agg(F.sum("uses").alias("total_ips"), F.count("ip").alias("distinct_ips"))
        .where(
            (F.col("total_ips") >= min_total)
            & (F.col("total_ips") > 0)
            & (F.col("distinct_ips") <= F.col("total_ips") * F.lit(max_ratio))
        )
        .withColumn("ratio", F.try_divide("distinct_ips", "total_ips"))
    )
    return _with_app_name(reused, apps)


def _with_app_name(counted: DataFrame, apps: DataFrame) -> DataFrame:
    named = apps.select(F.col("id").alias("__app"), "name")
    return counted.join(named, F.col("app_id") == F.col("__app"), "inner").select(
        "name", *counted.columns
    )


def installs_without_events(
    installs: DataFrame,
    events: DataFrame,
    as_of: date,
    days: int = 7,
    min_installs: int = 10,
) -> DataFrame:
    """Sources with enough installs and not one in-app event in the window.

    Both sides shrink to one row per source before they meet, and sources below the
    minimum are gone by then. Grouping both by the same column list leaves them partitioned
    alike, so the join itself shuffles nothing. A source with a NULL name or country
    matches nothing, so it is always reported.
    """
    start = period.days_before(as_of, days)
    counted = (
        period.since(installs, "install_time", start, strictly=True)
        .groupBy(*SUB_PUBLISHER_COUNTRY)
        .agg(F.count("install_time").alias("installs"))
        .where(F.col("installs") >= min_installs)
    )
    active = (
        period.since(events, "install_time", start, strictly=True)
        .groupBy(*SUB_PUBLISHER_COUNTRY)
        .agg(F.count("install_time").alias("events"))
    )
    return without_events(counted, active)


def without_events(counted: DataFrame, active: DataFrame) -> DataFrame:
    """Counted sources that are not among the active ones, in report order."""
    return (
        counted.join(active, list(SUB_PUBLISHER_COUNTRY), "left_anti")
        .select(*SUB_PUBLISHER, "installs", F.lit(None).cast("long").alias("events"))
        .orderBy(*(F.asc_nulls_last(c) for c in ("app_id", "network_name", "installs")))
    )


def aggregated_no_events(
    daily_events: DataFrame,
    as_of: date,
    days: int = 5,
    min_installs: int = 5,
    excluded_sources: Sequence[str] = SELF_ATTRIBUTING_SOURCES,
) -> DataFrame:
    """The same question on the daily export: installs, but events zero or absent.

    Organic traffic is exempt only where events are absent altogether.
    """
    recent = period.since_day(daily_events, "date", period.days_before(as_of, days))
    return silent_sources(
        export_totals(recent, EXPORT_SOURCE, excluded_sources), min_installs
    )


def export_totals(
    daily_events: DataFrame, keys: Sequence[str], excluded_sources: Sequence[str]
) -> DataFrame:
    """Installs and events of the daily export by ``keys``."""
    is_install = F.col("event_name") == "installs"
    return (
        daily_events.where(
            ~F.col("event_name").isin(*NON_EVENT_NAMES)
            & ~F.col("media_source").isin(*excluded_sources)
        )
        .groupBy(*keys)
        .agg(
            F.sum(F.when(is_install, F.col("count"))).alias("installs"),
            F.sum(F.when(~is_install, F.col("count"))).alias("events"),
        )
    )


def silent_sources(totals: DataFrame, min_installs: int) -> DataFrame:
    """Sources with enough installs whose events are zero or absent."""
    silent = (F.col("events") == 0) | (
        F.col("events").isNull() & (F.col("media_source") != ORGANIC)
    )
    return totals.where((F.col("installs") >= min_installs) & silent)
