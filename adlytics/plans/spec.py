"""What distinguishes one client's funnel from another's."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

# Events every funnel has, and the column each one becomes.
TRAFFIC_COLUMNS = {"impressions": "impressions", "clicks": "clicks", "installs": "installs"}
RESULT_COLUMNS = {"conversions": "conversions", "total_revenue": "total_revenue"}

# Client events of the two published funnels.
MARKETPLACE_EVENTS = {
    "signup (Unique users)": "event_1",
    "category_choose (Event counter)": "event_2",
    "order_location (Event counter)": "event_3",
    "dummyevent1": "event_4",
    "dummyevent2": "event_5",
    "dummyevent3": "event_6",
}
FITNESS_EVENTS = {
    "created account (Unique users)": "event_1",
    "14 day trial started (Unique users)": "event_2",
    "1 week pass started (Unique users)": "event_3",
    "subscription started (Unique users)": "event_4",
    "started workout (Event counter)": "event_5",
    "finished workout (Event counter)": "event_6",
}


@dataclass(frozen=True)
class FunnelSpec:
    """Parameters of a funnel.

    ``client_events`` maps the six event names of the client to ``event_1`` … ``event_6``.
    ``by_network`` keeps the media source as a key of every stage.
    """

    as_of: date
    app_ids: tuple[int, ...]
    country_codes: tuple[str, ...]
    markup_user_id: int
    installs_since: date
    client_events: Mapping[str, str] = field(default_factory=lambda: MARKETPLACE_EVENTS)
    by_network: bool = False
    lookback_days: int = 93

    @property
    def event_columns(self) -> dict[str, str]:
        return {**TRAFFIC_COLUMNS, **self.client_events, **RESULT_COLUMNS}


def marketplace_funnel(as_of: date) -> FunnelSpec:
    """The published funnel by medium and campaign type."""
    return FunnelSpec(
        as_of=as_of,
        app_ids=(69, 70),
        country_codes=("IL",),
        markup_user_id=36,
        installs_since=date(2016, 1, 1),
    )


def fitness_funnel(as_of: date) -> FunnelSpec:
    """The published funnel that is also split by network."""
    return FunnelSpec(
        as_of=as_of,
        app_ids=(78,),
        country_codes=("US",),
        markup_user_id=40,
        installs_since=date(2016, 9, 1),
        client_events=FITNESS_EVENTS,
        by_network=True,
    )
