"""What a report saw of its dimensions, from the pass that built it."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import rows

from adlytics.plans import fraud
from adlytics.reports import REPORTS
from adlytics.sources import SCHEMAS, counted

AS_OF = date(2016, 12, 10)


@pytest.fixture
def tables(spark):
    installs = [
        (1, "c", "net", "pub", "sub", "US", datetime(2016, 12, 9, 12), 1, "ip", None)
        for _ in range(20)
    ]
    return {
        "apps_flyer_data": spark.createDataFrame(installs, SCHEMAS["apps_flyer_data"]),
        "apps": spark.createDataFrame(
            [(1, "one", "ios"), (1, "uno", "ios"), (2, "two", "ios"), (None, "none", "ios")],
            SCHEMAS["apps"],
        ),
    }


def test_repeated_names_are_counted_in_the_report_s_own_pass(spark, tables):
    plain = REPORTS["duplicate_ips"].build(tables, AS_OF)
    watched, seen = counted(tables)
    report = REPORTS["duplicate_ips"].build(watched, AS_OF)
    # Both names of the app come out, as they do without the counts.
    assert rows(report) == rows(plain) and plain.count() == 2
    assert seen["apps"].get == {"rows": 4, "repeated": 2, "without_key": 1}
    assert set(seen) == {"apps"} and watched["apps"].columns == tables["apps"].columns


def test_one_job_gives_rows_and_counts(spark, tables):
    watched, seen = counted(tables)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("contract", "report with counts")
    found = fraud.duplicate_ip_sources(watched["apps_flyer_data"], watched["apps"], AS_OF).collect()
    spark.sparkContext.setJobGroup("after", "counts")
    before = len(tracker.getJobIdsForGroup("after"))
    assert seen["apps"].get["repeated"] == 2 and len(found) == 2
    assert len(tracker.getJobIdsForGroup("after")) == before == 0


def test_clean_and_stored_dimensions(spark, tables, tmp_path):
    spark.createDataFrame([(1, "one", "ios"), (2, "two", "ios")], SCHEMAS["apps"]).write.parquet(
        f"{tmp_path}/apps"
    )
    clean = {**tables, "apps": spark.read.schema(SCHEMAS["apps"]).parquet(f"{tmp_path}/apps")}
    watched, seen = counted(clean)
    REPORTS["duplicate_ips"].build(watched, AS_OF).collect()
    assert seen["apps"].get == {"rows": 2, "repeated": 0, "without_key": 0}
