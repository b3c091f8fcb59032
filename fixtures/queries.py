"""One runnable query per operator, over the whole test tables.

Screens come twice: with the window and threshold they are defined with (some thresholds
lowered to fit the data) and, as ``…_month``, over every day the tables hold.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlytics.functions import classify, prices
from adlytics.operators import asof_join, asof_join_bucketed, asof_join_unkeyed
from adlytics.plans import finance, fraud, funnel
from adlytics.plans.spec import FITNESS_EVENTS, FunnelSpec
from fixtures.spark_tables import (
    AS_OF,
    FIRST_DAY,
    LAST_DAY,
    STANDARD_APP,
    STANDARD_APP_IDS,
    FixtureTables,
)

Query = Callable[[SparkSession, str], DataFrame]

FINANCE_USER = 11
ALL_APPS = (1, 2, 3)
MONTH = 31
_COUNTRIES = tuple(f"REGION_{i}" for i in range(5))

BY_MEDIA = FunnelSpec(
    as_of=AS_OF,
    app_ids=ALL_APPS,
    country_codes=_COUNTRIES,
    markup_user_id=36,
    installs_since=FIRST_DAY,
)
BY_NETWORK = FunnelSpec(
    as_of=AS_OF,
    app_ids=ALL_APPS,
    country_codes=_COUNTRIES,
    markup_user_id=40,
    installs_since=FIRST_DAY,
    client_events=FITNESS_EVENTS,
    by_network=True,
)
NARROWED = {
    "app_ids": (1, 2),
    "country_codes": ("REGION_0", "REGION_2", "REGION_3"),
    "installs_since": date(2024, 1, 16),
    "lookback_days": 20,
}
# Events of the network funnel's client are those of the third app.
NARROWED_NETWORK = {**NARROWED, "app_ids": (2, 3)}


def comparable(df: DataFrame) -> DataFrame:
    """Integers as bigint, fractions as double with six decimals."""

    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            value = F.round(value.cast("double"), 6)
        elif isinstance(field.dataType, T.IntegralType):
            value = value.cast("bigint")
        return value.alias(field.name)

    return df.select(*(column(field) for field in df.schema.fields))


def _on_tables(build: Callable[[FixtureTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(FixtureTables(spark, sf_dir)))


def _daily(t: FixtureTables) -> DataFrame:
    return finance.daily_installs(
        t["apps_flyer_data"],
        t["apps_flyer_network_names"],
        t["countries"],
        FIRST_DAY,
        LAST_DAY,
    )


def _placed(t: FixtureTables) -> DataFrame:
    return finance.network_ids(
        _daily(t), t["apps_flyer_network_names"], t["apps_flyer_networks"]
    )


def _enriched(t: FixtureTables) -> DataFrame:
    return finance.enrich_sources(_daily(t), t, FIRST_DAY, LAST_DAY)


_PLACED_KEYS = (
    "app_id",
    "campaign",
    "network_name",
    "network_publisher",
    "network_sub_publisher",
    "country_code",
    "install_date",
    "source_provider_id",
)


def _asof_keyed(t: FixtureTables) -> DataFrame:
    history = t["mark_ups"].where(
        (F.col("user_id") == FINANCE_USER) & F.col("apps_flyer_network_id").isNotNull()
    )
    return asof_join(
        _placed(t).select("network_id", *_PLACED_KEYS, "installs"),
        history,
        {"network_id": "apps_flyer_network_id"},
        "install_date",
        "effective_date",
        {"markup_percent": "markup_percent"},
    )


def _asof_unkeyed(t: FixtureTables) -> DataFrame:
    history = t["mark_ups"].where(
        (F.col("user_id") == FINANCE_USER) & F.col("apps_flyer_network_id").isNull()
    )
    return asof_join_unkeyed(
        t["unconverting_sources"],
        history,
        "date",
        "effective_date",
        {"markup_percent": "markup_percent"},
    )


def _asof_orders(t: FixtureTables, join: Callable[..., DataFrame] = asof_join) -> DataFrame:
    """Every order as dated price of a key, looked up for every line item."""
    facts = t.source("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("l_shipdate")
    )
    history = t.source("orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate")
    )
    return join(
        facts,
        history,
        {"l_partkey": "o_custkey"},
        "l_shipdate",
        "o_orderdate",
        {"price_order": "o_orderkey", "price": "o_totalprice"},
    )


def _cpi_override(t: FixtureTables) -> DataFrame:
    cpi = prices.effective_cpi(
        F.col("sub_publisher_cpi"), F.col("publisher_cpi"), F.col("network_cpi")
    )
    return _enriched(t).select(*_PLACED_KEYS, cpi.alias("cpi"))


def _markup_override(t: FixtureTables) -> DataFrame:
    return finance.with_markup(
        _placed(t), t["mark_ups"], FINANCE_USER, "install_date", FIRST_DAY, LAST_DAY
    ).select(*_PLACED_KEYS, "network_id", "markup_percent")


def _install_spend(t: FixtureTables) -> DataFrame:
    cpi = prices.effective_cpi(
        F.col("sub_publisher_cpi"), F.col("publisher_cpi"), F.col("network_cpi")
    )
    spend = prices.install_spend(F.col("installs"), cpi)
    return _enriched(t).select(*_PLACED_KEYS, "installs", spend.alias("spend"))


def _media_labels(t: FixtureTables) -> DataFrame:
    label = classify.media_label(F.col("media_source"), F.col("campaign"))
    return (
        t.ev()
        .groupBy("media_source", "campaign", label.alias("media"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _campaign_types(t: FixtureTables) -> DataFrame:
    label = classify.campaign_type(F.col("campaign"))
    return (
        t.ev()
        .groupBy("campaign", label.alias("campaign_type"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _network_campaign_types(t: FixtureTables) -> DataFrame:
    source = ("network_type", "network_publisher", "network_sub_publisher")
    label = classify.network_campaign_type(*(F.col(c) for c in source))
    return (
        t["bime_export_installs"]
        .groupBy(*source, label.alias("campaign_type"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _paid_media(t: FixtureTables) -> DataFrame:
    return funnel.paid_media(
        t["google_campaign_performance"], t["facebook_campaign_performance"], STANDARD_APP
    )


def _funnel_full(t: FixtureTables, pre_aggregate: bool = False) -> DataFrame:
    wide = funnel.funnel_wide(funnel.funnel(t, BY_MEDIA), BY_MEDIA.event_columns)
    return funnel.funnel_full(
        wide, _paid_media(t), STANDARD_APP_IDS, STANDARD_APP, pre_aggregate
    )


def _pivot(t: FixtureTables, days: int) -> DataFrame:
    return fraud.cohort_pivot(t["apps_flyer_data"], AS_OF, ALL_APPS, days)


def _duplicates(t: FixtureTables, days: int, min_total: int, ratio: str) -> DataFrame:
    return fraud.duplicate_ip_sources(
        t["apps_flyer_data"], t["apps"], AS_OF, days, min_total, Decimal(ratio)
    )


def _without_events(t: FixtureTables, days: int, least: int) -> DataFrame:
    return fraud.installs_without_events(
        t["apps_flyer_data"], t["apps_flyer_events"], AS_OF, days, least
    )


def _aggregated(t: FixtureTables, days: int, least: int) -> DataFrame:
    return fraud.aggregated_no_events(t["bime_export_aggregated_events"], AS_OF, days, least)


BUILDERS: dict[str, Callable[[FixtureTables], DataFrame]] = {
    "u01_daily_installs": _daily,
    "u02_asof_keyed": _asof_keyed,
    "u02_asof_unkeyed": _asof_unkeyed,
    "u02_asof_orders": _asof_orders,
    "u02_asof_orders_bucketed": lambda t: _asof_orders(t, asof_join_bucketed),
    "u03_cpi_override": _cpi_override,
    "u04_markup_override": _markup_override,
    "u05_source_enrichment": _enriched,
    "u06_install_spend": _install_spend,
    "u07_unconverting_rows": lambda t: finance.unconverting_rows(
        t, FIRST_DAY, LAST_DAY, FINANCE_USER
    ),
    "u08_finance_report": lambda t: finance.finance_report(
        t, FIRST_DAY, LAST_DAY, FINANCE_USER
    ),
    "u09_install_cohorts": lambda t: fraud.install_cohorts(t["apps_flyer_data"], AS_OF),
    "u09_install_cohorts_month": lambda t: fraud.install_cohorts(
        t["apps_flyer_data"], AS_OF, ALL_APPS, MONTH
    ),
    "u10_cohort_pivot": lambda t: _pivot(t, 7),
    "u10_cohort_pivot_month": lambda t: _pivot(t, MONTH),
    "u11_fast_install_share": lambda t: fraud.fast_install_share(_pivot(t, 7), t["apps"]),
    "u11_fast_install_share_month": lambda t: fraud.fast_install_share(
        _pivot(t, MONTH), t["apps"]
    ),
    "u12_click_to_install": lambda t: fraud.click_to_install(
        t["apps_flyer_data"], t["apps"], AS_OF
    ),
    "u12_click_to_install_month": lambda t: fraud.click_to_install(
        t["apps_flyer_data"], t["apps"], AS_OF, MONTH + 5
    ),
    "u13_duplicate_ip": lambda t: _duplicates(t, 2, 3, "0.90"),
    "u13_duplicate_ip_month": lambda t: _duplicates(t, MONTH, 20, "0.90"),
    "u14_installs_without_events": lambda t: _without_events(t, 7, 3),
    "u14_installs_without_events_month": lambda t: _without_events(t, MONTH, 10),
    "u15_aggregated_no_events": lambda t: _aggregated(t, 5, 1),
    "u15_aggregated_no_events_month": lambda t: _aggregated(t, MONTH, 2),
    "u16_media_label": _media_labels,
    "u17_campaign_type": _campaign_types,
    "u18_network_campaign_type": _network_campaign_types,
    "u19_event_rollup": lambda t: funnel.event_rollup(
        t["bime_export_aggregated_events"], BY_MEDIA
    ),
    "u19_event_rollup_by_network": lambda t: funnel.event_rollup(
        t["bime_export_aggregated_events"], BY_NETWORK
    ),
    "u20_markup_spend": lambda t: funnel.markup_spend(t, BY_MEDIA),
    "u20_markup_spend_by_network": lambda t: funnel.markup_spend(t, BY_NETWORK),
    "u21_funnel": lambda t: funnel.funnel_report(t, BY_MEDIA),
    "u21_funnel_narrowed": lambda t: funnel.funnel_report(t, replace(BY_MEDIA, **NARROWED)),
    "u22_funnel_by_network_narrowed": lambda t: funnel.funnel_report(
        t, replace(BY_NETWORK, **NARROWED_NETWORK)
    ),
    "u22_funnel_by_network": lambda t: funnel.funnel_report(t, BY_NETWORK),
    "u23_funnel_wide": lambda t: funnel.funnel_wide_report(t, BY_MEDIA),
    "u24_funnel_wide_by_network": lambda t: funnel.funnel_wide_report(t, BY_NETWORK),
    "u25_paid_media": _paid_media,
    "u26_funnel_full": _funnel_full,
    "u26_funnel_full_pre_aggregated": lambda t: _funnel_full(t, pre_aggregate=True),
}

QUERIES: dict[str, Query] = {name: _on_tables(build) for name, build in BUILDERS.items()}
