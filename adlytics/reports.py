"""The published reports by name, with the parameters they are published with.

Every report takes the input tables and the day it is run for. Other parameters (apps,
countries, thresholds, users) are those of the functions in ``adlytics.plans``; call these
directly to change them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from adlytics.functions.period import days_before
from adlytics.plans import finance, fraud, funnel
from adlytics.plans.finance import Tables
from adlytics.plans.spec import fitness_funnel, marketplace_funnel

# Parameters of the published reports.
FINANCE_DAYS = 9
FINANCE_USER = 11
FULL_FUNNEL_APP = "Fixit Joe"

_HIERARCHY = (
    "apps",
    "countries",
    "mark_ups",
    "apps_flyer_network_names",
    "apps_flyer_networks",
    "apps_flyer_network_attributes",
    "apps_flyer_network_publishers",
    "apps_flyer_network_publisher_attributes",
    "apps_flyer_network_sub_publishers",
    "apps_flyer_network_sub_publisher_attributes",
)
_FUNNEL = (
    "bime_export_aggregated_events",
    "bime_export_installs",
    "apps_flyer_network_names",
    "apps_flyer_networks",
    "mark_ups",
)


@dataclass(frozen=True)
class Report:
    """Tables a report reads and the function that builds it."""

    tables: tuple[str, ...]
    build: Callable[[Tables, date], DataFrame]


def _finance(t: Tables, as_of: date) -> DataFrame:
    start, end = days_before(as_of, FINANCE_DAYS), days_before(as_of, 1)
    return finance.finance_report(t, start, end, FINANCE_USER)


def _fast_installs(t: Tables, as_of: date) -> DataFrame:
    return fraud.fast_install_share(
        fraud.cohort_pivot(t["apps_flyer_data"], as_of), t["apps"]
    )


REPORTS: dict[str, Report] = {
    "finance": Report(("apps_flyer_data", "unconverting_sources", *_HIERARCHY), _finance),
    "fast_installs": Report(("apps_flyer_data", "apps"), _fast_installs),
    "click_to_install": Report(
        ("apps_flyer_data", "apps"),
        lambda t, as_of: fraud.click_to_install(t["apps_flyer_data"], t["apps"], as_of),
    ),
    "duplicate_ips": Report(
        ("apps_flyer_data", "apps"),
        lambda t, as_of: fraud.duplicate_ip_sources(t["apps_flyer_data"], t["apps"], as_of),
    ),
    "no_events": Report(
        ("apps_flyer_data", "apps_flyer_events"),
        lambda t, as_of: fraud.installs_without_events(
            t["apps_flyer_data"], t["apps_flyer_events"], as_of
        ),
    ),
    "aggregated_no_events": Report(
        ("bime_export_aggregated_events",),
        lambda t, as_of: fraud.aggregated_no_events(t["bime_export_aggregated_events"], as_of),
    ),
    "funnel": Report(
        _FUNNEL, lambda t, as_of: funnel.funnel_report(t, marketplace_funnel(as_of))
    ),
    "funnel_wide": Report(
        _FUNNEL, lambda t, as_of: funnel.funnel_wide_report(t, marketplace_funnel(as_of))
    ),
    "funnel_full": Report(
        (*_FUNNEL, "google_campaign_performance", "facebook_campaign_performance"),
        lambda t, as_of: funnel.funnel_full_report(
            t, marketplace_funnel(as_of), FULL_FUNNEL_APP
        ),
    ),
    "network_funnel": Report(
        _FUNNEL, lambda t, as_of: funnel.funnel_report(t, fitness_funnel(as_of))
    ),
    "network_funnel_wide": Report(
        _FUNNEL, lambda t, as_of: funnel.funnel_wide_report(t, fitness_funnel(as_of))
    ),
}
