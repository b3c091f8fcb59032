from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import plan, rows

from adlytics.functions import period
from adlytics.plans import finance, fraud
from adlytics.sources import SCHEMAS, read_tables, write_clicks, write_fact, write_report

AS_OF = date(2024, 1, 31)


def events(spark):
    return spark.createDataFrame(
        [(1, "US", "net", "pub", "sub", datetime(2024, 1, day, 12)) for day in range(1, 31)],
        SCHEMAS["apps_flyer_events"],
    )


@pytest.fixture
def stored(spark, tmp_path):
    write_fact(events(spark), f"{tmp_path}/apps_flyer_events", "install_time")
    return read_tables(
        spark, str(tmp_path), ["apps_flyer_events"], partitioned=["apps_flyer_events"]
    )["apps_flyer_events"]


def test_fact_round_trip(spark, stored):
    assert rows(stored.drop(period.DAY_PARTITION)) == rows(events(spark))


def test_windows_prune_partitions_and_push_the_timestamp(stored):
    recent = period.since(stored, "install_time", date(2024, 1, 24))
    assert recent.count() == 7
    text = plan(recent)
    assert "PartitionFilters: [isnotnull(day_partition" in text
    assert "PushedFilters: [IsNotNull(install_time), GreaterThanOrEqual(install_time" in text
    few = period.between_days(stored, "install_time", date(2024, 1, 2), date(2024, 1, 4))
    assert few.count() == 3
    assert "day_partition#" in plan(few).split("PartitionFilters")[1].split("]")[0]


def test_layouts_read_what_was_written(spark, tmp_path):
    clicked = '{"Click Time": "2024-01-29 10:00:00"}'
    installs = spark.createDataFrame(
        [(1, "c", "net", "pub", "sub", "US", datetime(2024, 1, 30), 1, "ip", raw)
         for raw in (clicked, "{}", None)],
        SCHEMAS["apps_flyer_data"],
    )
    write_clicks(installs, f"{tmp_path}/apps_flyer_data")

    def read(**how):
        return read_tables(spark, str(tmp_path), ["apps_flyer_data"], **how)["apps_flyer_data"]

    stored = read(layouts={"apps_flyer_data": "click_day"})
    assert stored.columns[-2:] == ["click_time", "click_day_partition"]
    assert rows(stored.select(installs.columns)) == rows(installs)
    assert rows(stored, "click_time", "click_day_partition") == sorted(
        [(datetime(2024, 1, 29, 10), date(2024, 1, 29)), (None, None), (None, None)], key=str
    )
    recent = period.since_click_day(stored, date(2024, 1, 24))
    assert "click_day_partition#" in plan(recent).split("PartitionFilters")[1].split("]")[0]
    assert "click_time" not in read().columns
    with pytest.raises(ValueError, match="no such layout: weekly"):
        read(layouts={"apps_flyer_data": "weekly"})


def test_strict_window(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 24),)], "t timestamp_ntz")
    assert period.since(df, "t", date(2024, 1, 24)).count() == 1
    assert period.since(df, "t", date(2024, 1, 24), strictly=True).count() == 0


def test_unpartitioned_tables_are_only_filtered(spark):
    df = events(spark)
    assert period.since(df, "install_time", date(2024, 1, 24)).columns == df.columns


def test_scan_reads_only_the_columns_a_screen_needs(spark, tmp_path):
    spark.createDataFrame([], SCHEMAS["apps_flyer_data"]).write.parquet(
        f"{tmp_path}/apps_flyer_data"
    )
    tables = read_tables(spark, str(tmp_path), ["apps_flyer_data"])
    apps = spark.createDataFrame([], SCHEMAS["apps"])
    text = plan(fraud.duplicate_ip_sources(tables["apps_flyer_data"], apps, AS_OF))
    scanned = text.split("FileScan parquet [")[1].split("]")[0]
    assert {column.split("#")[0] for column in scanned.split(",")} == {
        "app_id", "network_name", "network_publisher", "network_sub_publisher",
        "country_code", "install_time", "source_provider_id", "ip",
    }
    assert "GreaterThanOrEqual(install_time" in text


def test_an_existing_report_is_not_overwritten(spark, tmp_path):
    report = spark.createDataFrame([(1, Decimal("1.50"))], "a int, b decimal(9,2)")
    path = f"{tmp_path}/report"
    write_report(report, path)
    assert rows(spark.read.parquet(path)) == [(1, 1.5)]
    with pytest.raises(Exception, match="already exists"):
        write_report(report, path)


def test_every_report_runs_on_stored_empty_tables(spark, tmp_path):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}")
    tables = read_tables(spark, str(tmp_path))
    report = finance.finance_report(tables, date(2024, 1, 1), date(2024, 1, 9))
    assert rows(report) == []


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = spark.range(60_000).selectExpr(
            "id app_id", "'US' country_code", "uuid() network_name", "uuid() network_publisher",
            "uuid() network_sub_publisher", "timestamp_ntz'2024-01-02 12:00:00' install_time",
        )
        write_fact(hot, f"{tmp_path}/hot", "install_time")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "hot" / "day_partition=2024-01-02").glob("*.parquet"))) > 3


@pytest.mark.parametrize("kind", ["fact", "clicks"])
def test_a_repeated_run_of_a_day_leaves_the_others(spark, tmp_path, kind):
    def installs(days, ip):
        return spark.createDataFrame(
            [(1, "c", "net", "pub", "sub", "US", datetime(2024, 1, day, 12), 1, ip,
              f'{{"Click Time": "2024-01-{day:02d} 11:00:00"}}') for day in days],
            SCHEMAS["apps_flyer_data"],
        )

    def write(df, **how):
        if kind == "fact":
            write_fact(df, f"{tmp_path}/apps_flyer_data", "install_time", **how)
        else:
            write_clicks(df, f"{tmp_path}/apps_flyer_data", **how)

    def stored():
        layout = {"apps_flyer_data": "day" if kind == "fact" else "click_day"}
        found = read_tables(spark, str(tmp_path), ["apps_flyer_data"], layouts=layout)
        return rows(found["apps_flyer_data"], "install_time", "ip")

    write(installs([1, 2, 3], "old"))
    with pytest.raises(Exception, match="already exists"):
        write(installs([2], "new"))
    for _ in range(2):
        write(installs([2, 4], "new"), rewrite=True)
        assert stored() == [
            (datetime(2024, 1, 1, 12), "old"), (datetime(2024, 1, 2, 12), "new"),
            (datetime(2024, 1, 3, 12), "old"), (datetime(2024, 1, 4, 12), "new"),
        ]
    write(installs([], "none"), rewrite=True)
    assert len(stored()) == 4
