from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from helpers import plan, rows

from adlytics.plans import fraud
from adlytics.sources import SCHEMAS, write_clicks, write_fact

AS_OF = date(2024, 1, 31)
NOON = datetime(2024, 1, 30, 12)


def installs(spark, *items):
    """Installs from dicts; anything not given has a harmless value."""
    default = {
        "app_id": 1, "campaign": "c", "network_name": "net", "network_publisher": "pub",
        "network_sub_publisher": "sub", "country_code": "US", "install_time": NOON,
        "source_provider_id": 1, "ip": "1.1.1.1", "raw_data": None,
    }
    data = [tuple({**default, **item}.values()) for item in items]
    return spark.createDataFrame(data, SCHEMAS["apps_flyer_data"])


def clicked(**before):
    """Raw data with a click that long before noon."""
    return f'{{"Click Time": "{NOON - timedelta(**before)}", "other": 1}}'


@pytest.fixture
def apps(spark):
    return spark.createDataFrame(
        [(1, "one", "ios"), (2, "two", "android"), (3, "three", "ios")], SCHEMAS["apps"]
    )


def labels(df):
    return {row["classification"]: row[df.columns[-1]] for row in df.collect()}


class TestCohorts:
    def test_bounds_are_inclusive_and_exact(self, spark):
        facts = installs(
            spark,
            {"raw_data": clicked(seconds=30)},
            {"raw_data": clicked(seconds=30, milliseconds=400)},
            {"raw_data": clicked(seconds=120)},
            {"raw_data": clicked(seconds=120, microseconds=1)},
        )
        assert labels(fraud.install_cohorts(facts, AS_OF)) == {"<30": 1, "<120": 2, ">120": 1}

    def test_negative_latency_is_fast_and_unknown_latency_is_slow(self, spark):
        facts = installs(
            spark,
            {"raw_data": clicked(hours=-5)},
            {"raw_data": None},
            {"raw_data": "{}"},
            {"raw_data": '{"Click Time": "soon"}'},
        )
        assert labels(fraud.install_cohorts(facts, AS_OF)) == {"<30": 1, ">120": 3}

    def test_window_starts_at_midnight_and_apps_are_filtered(self, spark):
        start = datetime(2024, 1, 24)
        facts = installs(
            spark,
            {"install_time": start},
            {"install_time": start - timedelta(microseconds=1)},
            {"app_id": 4},
        )
        assert rows(fraud.install_cohorts(facts, AS_OF), "total_installs") == [(1,)]

    def test_pivot_has_null_for_empty_cohorts_and_for_unknown_sources(self, spark):
        fast, slow = clicked(seconds=1), clicked(hours=1)
        facts = installs(
            spark,
            {"raw_data": fast},
            {"raw_data": fast},
            {"raw_data": slow},
            {"raw_data": fast, "network_publisher": None},
        )
        pivoted = fraud.cohort_pivot(facts, AS_OF)
        assert pivoted.columns[4:] == ["total_installs", ">120", "<120", "<30"]
        assert rows(pivoted, "network_publisher", *pivoted.columns[4:]) == [
            ("pub", 3, 1, None, 2),
            (None, 1, None, None, None),
        ]

    def test_share(self, spark, apps):
        facts = installs(
            spark,
            {"raw_data": clicked(seconds=1)},
            {"raw_data": clicked(hours=1)},
            {"raw_data": clicked(hours=1), "app_id": 2},
        )
        share = fraud.fast_install_share(fraud.cohort_pivot(facts, AS_OF), apps)
        assert rows(share, "name", "<30_volume") == [("one", 0.5), ("two", None)]

    def test_pivot_is_one_shuffle(self, spark):
        assert plan(fraud.cohort_pivot(installs(spark, {}), AS_OF)).count("Exchange") == 1


class TestDistribution:
    def test_buckets(self, spark, apps):
        hours = {1: "first_hour", 24: "first_day", 48: "second_day", 72: "third_day"}
        facts = installs(
            spark,
            *({"raw_data": clicked(hours=h)} for h in hours),
            *({"raw_data": clicked(hours=h, microseconds=1)} for h in hours),
            {"raw_data": clicked(hours=-1)},
        )
        assert labels(fraud.click_to_install(facts, apps, AS_OF)) == {
            "first_hour": 2, "first_day": 2, "second_day": 2, "third_day": 2,
            "more_than_3_days": 1,
        }

    def test_window_is_on_the_click_and_unknown_clicks_or_providers_are_out(self, spark, apps):
        facts = installs(
            spark,
            {"raw_data": None},
            {"raw_data": clicked(hours=1), "source_provider_id": 3},
            {"raw_data": clicked(hours=1), "source_provider_id": None},
            {"raw_data": clicked(days=6)},
            {"raw_data": clicked(days=7)},
            {"raw_data": clicked(hours=1), "app_id": 9},
        )
        assert labels(fraud.click_to_install(facts, apps, AS_OF)) == {"more_than_3_days": 1}


class TestDuplicateIps:
    def test_thresholds_are_inclusive(self, spark, apps):
        def source(name, total, distinct):
            return [
                {"network_name": name, "ip": f"ip{i % distinct}"} for i in range(total)
            ]

        facts = installs(
            spark,
            *source("at_ratio", 20, 18),
            *source("above_ratio", 20, 19),
            *source("too_small", 19, 1),
            *source("one_ip", 25, 1),
        )
        found = fraud.duplicate_ip_sources(facts, apps, AS_OF)
        assert found.columns == [
            "name", "app_id", "network_name", "network_publisher", "network_sub_publisher",
            "country_code", "total_ips", "distinct_ips", "ratio",
        ]
        assert rows(found, "network_name", "total_ips", "distinct_ips", "ratio") == [
            ("at_ratio", 20, 18, 0.9), ("one_ip", 25, 1, 0.04),
        ]

    def test_null_ips_are_not_counted_and_never_divide_by_zero(self, spark, apps):
        facts = installs(spark, {"ip": None}, {"ip": None, "country_code": None})
        found = fraud.duplicate_ip_sources(facts, apps, AS_OF, min_total=0)
        assert rows(found) == []

    def test_null_keys_form_a_source(self, spark, apps):
        facts = installs(spark, *({"country_code": None} for _ in range(20)))
        found = fraud.duplicate_ip_sources(facts, apps, AS_OF)
        assert rows(found, "country_code", "total_ips") == [(None, 20)]

    def test_provider_and_window(self, spark, apps):
        old = {"install_time": datetime(2024, 1, 28, 23, 59)}
        facts = installs(
            spark, *({"source_provider_id": 3} for _ in range(30)), *(old for _ in range(30))
        )
        assert rows(fraud.duplicate_ip_sources(facts, apps, AS_OF)) == []

    def test_hot_source_is_spread_by_ip(self, spark, apps):
        text = plan(fraud.duplicate_ip_sources(installs(spark, {}), apps, AS_OF))
        per_ip = [line for line in text.splitlines() if "hashpartitioning" in line]
        assert any("ip#" in line for line in per_ip)
        assert "Expand" not in text

    def test_ratio_is_exact(self, spark, apps):
        facts = installs(spark, *({"ip": f"ip{i % 7}"} for i in range(10)))
        found = fraud.duplicate_ip_sources(
            facts, apps, AS_OF, min_total=1, max_ratio=Decimal("0.7")
        )
        assert rows(found, "distinct_ips") == [(7,)]


class TestInstallsWithoutEvents:
    def events(self, spark, *items):
        default = {
            "app_id": 1, "country_code": "US", "network_name": "net",
            "network_publisher": "pub", "network_sub_publisher": "sub", "install_time": NOON,
        }
        return spark.createDataFrame(
            [tuple({**default, **item}.values()) for item in items],
            SCHEMAS["apps_flyer_events"],
        )

    def test_only_silent_sources_with_enough_installs(self, spark):
        facts = installs(
            spark,
            *({"network_name": "silent"} for _ in range(10)),
            *({"network_name": "active"} for _ in range(10)),
            *({"network_name": "small"} for _ in range(9)),
        )
        found = fraud.installs_without_events(
            facts, self.events(spark, {"network_name": "active"}), AS_OF
        )
        assert rows(found, "network_name", "installs", "events") == [("silent", 10, None)]

    def test_null_keys_never_match(self, spark):
        facts = installs(spark, *({"network_publisher": None} for _ in range(10)))
        found = fraud.installs_without_events(
            facts, self.events(spark, {"network_publisher": None}), AS_OF
        )
        assert rows(found, "network_publisher", "installs") == [(None, 10)]

    def test_window_excludes_its_first_instant(self, spark):
        start = datetime(2024, 1, 24)
        facts = installs(
            spark,
            *({"install_time": start} for _ in range(10)),
            *({"install_time": start + timedelta(microseconds=1)} for _ in range(10)),
        )
        found = fraud.installs_without_events(
            facts, self.events(spark, {"install_time": start}), AS_OF
        )
        assert rows(found, "installs") == [(10,)]

    def test_join_shuffles_nothing_of_its_own(self, spark, sort_merge):
        text = plan(
            fraud.installs_without_events(installs(spark, {}), self.events(spark, {}), AS_OF)
        )
        assert text.count("Exchange hashpartitioning") == 2

    def test_order(self, spark):
        facts = installs(
            spark, {"network_name": None}, {"network_name": "b"}, {"network_name": "a"},
            {"network_name": "a", "country_code": "FR"},
            {"network_name": "a", "country_code": "FR"},
        )
        found = fraud.installs_without_events(
            facts, self.events(spark), AS_OF, min_installs=1
        ).collect()
        assert [(r.network_name, r.installs) for r in found] == [
            ("a", 1), ("a", 2), ("b", 1), (None, 1),
        ]


class TestAggregatedNoEvents:
    def daily(self, spark, *items):
        default = {
            "date": date(2024, 1, 30), "app_id": 1, "app_name": "one", "country_code": "US",
            "os": "ios", "media_source": "net", "campaign": "c", "event_name": "installs",
            "count": Decimal(5),
        }
        return spark.createDataFrame(
            [tuple({**default, **item}.values()) for item in items],
            SCHEMAS["bime_export_aggregated_events"],
        )

    def found(self, df):
        return rows(fraud.aggregated_no_events(df, AS_OF), "media_source", "installs", "events")

    def test_organic_is_exempt_only_without_any_event_row(self, spark):
        zero = {"event_name": "purchase", "count": Decimal(0)}
        df = self.daily(
            spark,
            {"media_source": "absent"},
            {"media_source": "zero"}, {"media_source": "zero", **zero},
            {"media_source": "active"}, {"media_source": "active", "event_name": "purchase"},
            {"media_source": "Organic"},
            {"media_source": "Organic", "campaign": "z"},
            {"media_source": "Organic", "campaign": "z", **zero},
            {"media_source": "small", "count": Decimal(4)},
        )
        assert self.found(df) == [
            ("Organic", 5.0, 0.0), ("absent", 5.0, None), ("zero", 5.0, 0.0),
        ]

    def test_traffic_is_no_event_and_null_names_are_dropped(self, spark):
        df = self.daily(
            spark,
            {},
            {"event_name": "clicks"}, {"event_name": "impressions"},
            {"event_name": "conversions"}, {"event_name": "total_revenue"},
            {"event_name": None},
            {"media_source": None}, {"media_source": "Facebook Ads"},
            {"media_source": "googleadwords_int"},
        )
        assert self.found(df) == [("net", 5.0, None)]

    def test_one_shuffle(self, spark):
        text = plan(fraud.aggregated_no_events(self.daily(spark, {}), AS_OF))
        assert text.count("Exchange") == 1


class TestStoredClicks:
    def table(self, spark):
        return installs(
            spark,
            {"raw_data": clicked(minutes=5)},
            {"raw_data": clicked(days=40)},
            {"raw_data": None},
            {"raw_data": '{"Click Time": "soon"}'},
        )

    def test_same_rows_and_days_pruned(self, spark, apps, tmp_path):
        df = self.table(spark)
        write_clicks(df, f"{tmp_path}/clicks")
        stored = spark.read.parquet(f"{tmp_path}/clicks")
        plain = fraud.click_to_install(df, apps, AS_OF)
        pruned = fraud.click_to_install(stored, apps, AS_OF)
        assert rows(plain) == rows(pruned) and plain.count() == 1
        assert "click_day_partition#" in plan(pruned).split("PartitionFilters")[1].split("]")[0]
        assert rows(fraud.cohort_pivot(df, AS_OF)) == rows(fraud.cohort_pivot(stored, AS_OF))

    def test_strict_click_times(self, spark, apps):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            fraud.click_to_install(self.table(spark), apps, AS_OF, strict=True).collect()

    def test_repeated_apps_multiply_counts_but_not_shares(self, spark):
        df = self.table(spark)
        twice = spark.createDataFrame(
            [(1, "one", "ios"), (1, "one", "web"), (1, "uno", "ios")], SCHEMAS["apps"]
        )
        counts = fraud.click_to_install(df, twice, AS_OF)
        assert rows(counts, "name", "total_count") == [("one", 2), ("uno", 1)]
        shares = fraud.fast_install_share(fraud.cohort_pivot(df, AS_OF), twice)
        assert rows(shares, "name", "total_installs") == [("one", 4), ("uno", 4)]


def test_export_screen_prunes_days(spark, tmp_path):
    schema = SCHEMAS["bime_export_aggregated_events"]
    row = (date(2024, 1, 30), 1, "one", "US", "ios", "net", "c", "installs", 7)
    daily = spark.createDataFrame([(*row[:8], Decimal(7))], schema)
    write_fact(daily, f"{tmp_path}/daily", "date")
    stored = spark.read.schema(f"{schema}, day_partition date").parquet(f"{tmp_path}/daily")
    text = plan(fraud.aggregated_no_events(stored, AS_OF))
    assert "day_partition#" in text.split("PartitionFilters")[1].split("]")[0]
