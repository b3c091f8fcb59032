"""Reports from daily partials against reports from the facts, on every kind of day."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from helpers import plan, rows

from adlytics.plans import daily, fraud
from adlytics.sources import SCHEMAS, write_fact
from fixtures.spark_tables import AS_OF, FIRST_DAY, FixtureTables

DAYS = [FIRST_DAY + timedelta(days=n) for n in (0, 1, 5, 12, 20, 29)] + [AS_OF, AS_OF + timedelta(days=3)]
KEY = (1, "net", "pub", "sub", "US")


@pytest.fixture(scope="module")
def tables(spark):
    return FixtureTables(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def partials(spark, tables, tmp_path_factory):
    """Written as a daily job would: one day after the other, some of them twice."""
    root = str(tmp_path_factory.mktemp("partials"))
    made = {
        "ips": daily.daily_ips(tables["apps_flyer_data"]),
        "installs": daily.daily_counts(tables["apps_flyer_data"]),
        "events": daily.daily_counts(tables["apps_flyer_events"]),
        "export": daily.daily_export(tables["bime_export_aggregated_events"]),
    }
    out = {}
    for name, df in made.items():
        write_fact(df, f"{root}/{name}", "date")
        write_fact(df.where("date between '2024-01-05' and '2024-01-06'"), f"{root}/{name}", "date", rewrite=True)
        out[name] = spark.read.parquet(f"{root}/{name}")
    return out


@pytest.mark.parametrize("as_of", DAYS)
def test_reports_from_partials_equal_reports_from_facts(spark, tables, partials, as_of):
    apps = tables["apps"]
    pairs = [
        (
            fraud.duplicate_ip_sources(tables["apps_flyer_data"], apps, as_of, 2, 3),
            daily.duplicate_ip_sources(partials["ips"], apps, as_of, 2, 3),
        ),
        (
            fraud.installs_without_events(
                tables["apps_flyer_data"], tables["apps_flyer_events"], as_of, 7, 2
            ),
            daily.installs_without_events(partials["installs"], partials["events"], as_of, 7, 2),
        ),
        (
            fraud.aggregated_no_events(tables["bime_export_aggregated_events"], as_of, 5, 1),
            daily.aggregated_no_events(partials["export"], as_of, 5, 1),
        ),
    ]
    for facts, partial in pairs:
        assert facts.columns == partial.columns
        assert rows(partial) == rows(facts)


def test_midnight_counts_inside_a_window_but_not_at_its_start(spark):
    def installs(*times):
        return spark.createDataFrame(
            [(1, "c", *KEY[1:], t, 1, "ip", None) for t in times], SCHEMAS["apps_flyer_data"]
        )

    events = spark.createDataFrame([], SCHEMAS["apps_flyer_events"])
    facts = installs(
        *[datetime(2024, 1, 24)] * 3, datetime(2024, 1, 24, 0, 0, 1), datetime(2024, 1, 25)
    )
    for least, found in ((2, 1), (3, 0)):
        for report in (
            fraud.installs_without_events(facts, events, AS_OF, 7, least),
            daily.installs_without_events(
                daily.daily_counts(facts), daily.daily_counts(events), AS_OF, 7, least
            ),
        ):
            assert report.count() == found
    # A source whose events are all at the first midnight has none inside the window.
    sharp = spark.createDataFrame([(1, "US", "net", "pub", "sub", datetime(2024, 1, 24))], SCHEMAS["apps_flyer_events"])
    for report in (
        fraud.installs_without_events(facts, sharp, AS_OF, 7, 2),
        daily.installs_without_events(daily.daily_counts(facts), daily.daily_counts(sharp), AS_OF, 7, 2),
    ):
        assert report.count() == 1


def test_missing_names_ips_and_counts(spark, tables):
    installs = spark.createDataFrame(
        [(1, "c", None, "pub", "sub", "US", datetime(2024, 1, 30, h), p, ip, None)
         for h, p, ip in ((1, 1, "a"), (2, 1, "a"), (3, 1, None), (4, 3, "a"), (5, None, "a"))],
        SCHEMAS["apps_flyer_data"],
    )
    apps = spark.createDataFrame([(1, "one", "ios")], SCHEMAS["apps"])
    ratio = Decimal("0.90")
    facts = fraud.duplicate_ip_sources(installs, apps, AS_OF, 2, 1, ratio)
    partial = daily.duplicate_ip_sources(daily.daily_ips(installs), apps, AS_OF, 2, 1, ratio)
    assert rows(partial) == rows(facts) and facts.count() == 1


def test_days_outside_the_window_are_not_read(partials, tables):
    text = plan(daily.duplicate_ip_sources(partials["ips"], tables["apps"], AS_OF))
    assert "day_partition#" in text.split("PartitionFilters")[1].split("]")[0]
