from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from adlytics.functions import prices
from adlytics.plans import finance
from adlytics.sources import SCHEMAS

START, END = date(2024, 1, 1), date(2024, 1, 9)


def jan(day: int, *time: int):
    return datetime(2024, 1, day, *time) if time else date(2024, 1, day)


@pytest.fixture
def make(spark):
    """Tables from short rows; tables not given are empty."""

    def build(**data):
        return {
            name: spark.createDataFrame(data.get(name, []), schema)
            for name, schema in SCHEMAS.items()
        }

    return build


def install(day=5, network="net", publisher="pub", sub="sub", country="US", app=1, when=None):
    return (
        app, "camp", network, publisher, sub, country, when or jan(day, 12), 1, "ip", None
    )


DIMENSIONS = {
    "apps": [(1, "one", "ios"), (2, "two", "android")],
    "countries": [(7, "US"), (8, "FR")],
    "apps_flyer_network_names": [(70, "net"), (71, "other")],
    "apps_flyer_networks": [(100, 1, 70, 7)],
}


def daily(t):
    return finance.daily_installs(
        t["apps_flyer_data"], t["apps_flyer_network_names"], t["countries"], START, END
    )


def test_period_ends_with_the_last_whole_second(make):
    t = make(
        **DIMENSIONS,
        apps_flyer_data=[
            install(when=jan(1, 0, 0, 0)),
            install(when=jan(9, 23, 59, 59)),
            install(when=jan(9, 23, 59, 59, 1)),
            install(when=datetime(2023, 12, 31, 23, 59, 59, 999999)),
            (*install()[:6], None, *install()[7:]),
        ],
    )
    assert rows(daily(t), "install_date", "installs") == [(jan(1), 1), (jan(9), 1)]


def test_unknown_networks_and_countries_are_dropped_but_not_null_publishers(make):
    t = make(
        **DIMENSIONS,
        apps_flyer_data=[
            install(network="unknown"), install(network=None), install(country="XX"),
            install(country=None), install(publisher=None), install(publisher=None),
        ],
    )
    assert rows(daily(t), "network_publisher", "country_id", "installs") == [(None, 7, 2)]


def test_a_repeated_dimension_row_multiplies_the_count(make):
    t = make(
        apps_flyer_network_names=[(70, "net"), (71, "net"), (72, "net")],
        countries=[(7, "US"), (7, "US"), (8, "US")],
        apps_flyer_data=[install(), install()],
    )
    assert rows(daily(t), "country_id", "installs") == [(7, 12), (8, 6)]


HIERARCHY = {
    **DIMENSIONS,
    "apps_flyer_network_publishers": [(10, 100, "pub"), (11, 999, "pub")],
    "apps_flyer_network_sub_publishers": [(20, 10, "sub"), (21, 11, "sub")],
    "apps_flyer_network_attributes": [(100, jan(2), 1.0, 5), (100, jan(6), 2.0, 6)],
    "apps_flyer_network_publisher_attributes": [(10, jan(4), 3.0)],
    "apps_flyer_network_sub_publisher_attributes": [(20, jan(7), 4.0), (21, jan(1), 9.0)],
}


def test_hierarchy_takes_prices_of_the_install_date(make):
    t = make(**HIERARCHY, apps_flyer_data=[install(day=d) for d in (1, 3, 5, 8)])
    enriched = finance.enrich_sources(daily(t), t, START, END)
    assert rows(
        enriched, "install_date", "network_type", "network_cpi", "publisher_cpi",
        "sub_publisher_cpi", "app_name", "os",
    ) == [
        (jan(1), None, None, None, None, "one", "ios"),
        (jan(3), 5, 1.0, None, None, "one", "ios"),
        (jan(5), 5, 1.0, 3.0, None, "one", "ios"),
        (jan(8), 6, 2.0, 3.0, 4.0, "one", "ios"),
    ]


def test_sources_missing_in_the_hierarchy(make):
    t = make(
        **HIERARCHY,
        apps_flyer_data=[
            install(publisher="unknown"), install(publisher=None), install(sub=None),
            install(network="other"), install(country="FR"), install(app=3),
        ],
    )
    enriched = finance.enrich_sources(daily(t), t, START, END)
    assert rows(
        enriched, "network_publisher", "network_sub_publisher", "publisher_id",
        "sub_publisher_id",
    ) == [("pub", None, 10, None), ("unknown", "sub", None, None), (None, "sub", None, None)]


def test_price_rules(spark):
    df = spark.createDataFrame(
        [(3, 1.0, 2.0, 4.0), (3, 1.0, 2.0, None), (3, 1.0, None, None), (3, None, None, None)],
        "installs bigint, cpi double, pub double, sub double",
    )
    cpi = prices.effective_cpi(F.col("sub"), F.col("pub"), F.col("cpi"))
    spend = prices.install_spend(F.col("installs"), cpi)
    assert rows(df.select(cpi.alias("cpi"), spend.alias("spend"))) == [
        (1.0, 3.0), (2.0, 6.0), (4.0, 12.0), (None, 0.0),
    ]


def test_money_rounds_half_away_from_zero_whatever_the_sum_order(spark):
    df = spark.createDataFrame(
        [(7.205,), (7.204999999999999,), (-7.205,), (7.204,), (None,)], "x double"
    )
    assert rows(df.select(prices.money(F.col("x")).alias("m"))) == [
        (-7.21,), (7.2,), (7.21,), (7.21,), (None,),
    ]


MARK_UPS = [
    (100, 11, jan(4), Decimal(10)),
    (100, 11, jan(6), Decimal(20)),
    (100, 36, jan(1), Decimal(99)),
    (None, 11, jan(3), Decimal(1)),
    (None, 11, jan(7), Decimal(2)),
    (None, 36, jan(1), Decimal(98)),
    (200, 11, jan(1), Decimal(97)),
]


def test_own_mark_up_wins_over_the_default(spark, make):
    t = make(mark_ups=MARK_UPS)
    facts = spark.createDataFrame(
        [(i, network, jan(day)) for i, (network, day) in enumerate(
            [(100, 2), (100, 3), (100, 4), (100, 8), (300, 2), (300, 3), (300, 9), (None, 9)]
        )],
        "fact bigint, network_id bigint, day date",
    )
    found = finance.with_markup(facts, t["mark_ups"], 11, "day")
    assert rows(found, "fact", "markup_percent") == [
        (0, None), (1, 1.0), (2, 10.0), (3, 20.0), (4, None), (5, 1.0), (6, 2.0), (7, 2.0),
    ]


def test_tied_mark_ups_fan_out(spark, make):
    t = make(
        mark_ups=[
            (100, 11, jan(1), Decimal(10)), (100, 11, jan(1), Decimal(20)),
            (None, 11, jan(1), Decimal(1)), (None, 11, jan(1), Decimal(2)),
        ]
    )
    facts = spark.createDataFrame([(100, jan(5)), (300, jan(5))], "network_id bigint, day date")
    found = finance.with_markup(facts, t["mark_ups"], 11, "day")
    assert rows(found, "network_id", "markup_percent") == [
        (100, 10.0), (100, 10.0), (100, 20.0), (100, 20.0), (300, 1.0), (300, 2.0),
    ]


def test_unconverting_rows(make):
    t = make(
        **DIMENSIONS,
        mark_ups=MARK_UPS,
        unconverting_sources=[
            (1, 7, jan(2), 5.0), (1, 7, jan(9), 6.0), (1, 7, jan(10), 7.0), (9, 7, jan(5), 8.0),
            (1, 9, jan(5), 9.0),
        ],
    )
    found = finance.unconverting_rows(t, START, END, 11)
    assert tuple(found.columns) == finance.REPORT_COLUMNS
    name = "unconverting_source"
    assert rows(found) == [
        (1, name, name, name, name, "US", 7, jan(2), 4, None, "one", "ios", 2, None, 5.0, None),
        (1, name, name, name, name, "US", 7, jan(9), 4, None, "one", "ios", 2, None, 6.0, 2.0),
    ]


def test_report_is_distinct_and_newest_first(make):
    t = make(
        **HIERARCHY,
        mark_ups=MARK_UPS,
        apps_flyer_data=[install(day=8), install(day=8), install(day=3)],
        unconverting_sources=[(1, 7, jan(5), 5.0), (1, 7, jan(5), 5.0)],
    )
    report = finance.finance_report(t, START, END)
    assert tuple(report.columns) == finance.REPORT_COLUMNS
    found = [(r.install_date, r.installs, r.cpi, r.spend, r.markup_percent)
             for r in report.collect()]
    assert found == [
        (jan(8), 2, 4.0, 8.0, Decimal(20)),
        (jan(5), None, None, 5.0, Decimal(1)),
        (jan(3), 1, 1.0, 1.0, Decimal(1)),
    ]


def test_report_without_broadcasts(make, sort_merge):
    t = make(
        **HIERARCHY,
        mark_ups=MARK_UPS,
        apps_flyer_data=[install(day=8), install(day=8), install(day=3)],
    )
    report = finance.finance_report(t, START, END)
    assert rows(report, "install_date", "spend", "markup_percent") == [
        (jan(3), 1.0, 1.0), (jan(8), 8.0, 20.0),
    ]


@pytest.mark.parametrize(
    "amount, expected",
    [
        (7.2049996, "7.20"),
        (1234567.2049999, "1234567.20"),
        (7.204999999999999, "7.21"),
        (7.205, "7.21"),
        (-7.205, "-7.21"),
        (None, None),
        (0.0, "0.00"),
    ],
)
def test_money_is_rounded_once_at_fifteen_digits(spark, amount, expected):
    df = spark.createDataFrame([(amount,)], "x double")
    found = df.select(prices.money(F.col("x")).cast("string").alias("m")).first().m
    assert found == expected
