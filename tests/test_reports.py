from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import plan, rows

from adlytics.__main__ import main
from adlytics.reports import REPORTS
from adlytics.sources import SCHEMAS, read_tables, write_clicks, write_report

AS_OF = date(2016, 12, 10)
DATA = {
    "apps_flyer_data": [
        (1, "c", "net", "pub", "sub", "US", datetime(2016, 12, day, 23, 59, 59), 1, "ip",
         '{"Click Time": "2016-12-09 23:59:50"}')
        for day in [9] * 20 + [1, 10]
    ],
    "apps": [(1, "one", "ios"), (69, "fix", "ios")],
    "countries": [(7, "US"), (8, "IL")],
    "apps_flyer_network_names": [(70, "net")],
    "apps_flyer_networks": [(100, 1, 70, 7), (101, 69, 70, 8), (102, 78, 70, 7)],
    "mark_ups": [
        (None, 11, date(2016, 1, 1), Decimal(5)), (101, 36, date(2016, 1, 1), Decimal(50)),
        (None, 40, date(2016, 1, 1), Decimal(100)),
    ],
    "bime_export_aggregated_events": [
        (date(2016, 12, 8), app, "app", country, "ios", "net", "perf", "installs", Decimal(6))
        for app, country in ((69, "IL"), (78, "US"), (1, "US"))
    ],
    "bime_export_installs": [
        (1, app, "net", "p", "s", country, place, date(2016, 12, 8), 6, "app", "ios", "Non",
         None, 10.0, None, None)
        for app, country, place in ((69, "IL", 8), (78, "US", 7))
    ],
    "google_campaign_performance": [
        ("Fixit Joe", "ios", "media buy", "performance", "IL", date(2016, 12, 8), 3.0, 4, 5)
    ],
}
DAY = date(2016, 12, 8)
EXPECTED = {
    "finance": (("install_date", "installs", "spend", "markup_percent"),
                [(date(2016, 12, 1), 1, 0.0, 5.0), (date(2016, 12, 9), 20, 0.0, 5.0)]),
    "fast_installs": (("name", "total_installs", "<30"), [("one", 21, 20)]),
    "click_to_install": (("name", "classification", "total_count"),
                         [("one", "first_hour", 21), ("one", "second_day", 1)]),
    "duplicate_ips": (("name", "total_ips", "distinct_ips"), [("one", 21, 1)]),
    "no_events": (("network_name", "installs", "events"), [("net", 21, None)]),
    "aggregated_no_events": (("app_id", "installs", "events"),
                             [(1, 6.0, None), (69, 6.0, None), (78, 6.0, None)]),
    "funnel": (("date", "app_id", "event_name", "totals", "spend"),
               [(DAY, 69, "installs", 6.0, 15.0)]),
    "funnel_wide": (("app_id", "mrs_spend", "installs", "event_6"), [(69, 15.0, 6.0, None)]),
    "funnel_full": (("app_name_std", "mrs_cost", "gac_fb_cost", "total_cost"),
                    [("Fixit Joe", 15.0, 3.0, 15.0)]),
    "network_funnel": (("app_id", "media_source", "totals", "spend"),
                       [(78, "net", 6.0, 20.0)]),
    "network_funnel_wide": (("app_id", "network_name", "mrs_spend", "installs"),
                            [(78, "net", 20.0, 6.0)]),
}


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(DATA.get(name, []), schema).write.parquet(f"{folder}/{name}")
    return folder


@pytest.mark.parametrize("name", REPORTS)
def test_published_report(spark, root, name):
    report = REPORTS[name]
    columns, expected = EXPECTED[name]
    result = report.build(read_tables(spark, root, report.tables), AS_OF)
    assert rows(result, *columns) == expected


def test_command_line(spark, root, tmp_path):
    output = f"{tmp_path}/out"
    main(["duplicate_ips", "--tables", root, "--output", output, "--as-of", "2016-12-10"])
    assert rows(spark.read.parquet(output), "name", "total_ips") == [("one", 21)]


def test_command_line_reads_installs_by_click_day(spark, root, tmp_path, monkeypatch):
    """The stored click days are read end to end, and only those of the window."""
    stored = f"{tmp_path}/tables"
    for name in ("apps_flyer_data", "apps"):
        df = spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")
        if name == "apps":
            df.write.parquet(f"{stored}/{name}")
        else:
            write_clicks(df, f"{stored}/{name}")
    written = {}

    def keep(report, path, **how):
        written[path] = plan(report)
        write_report(report, path, **how)

    monkeypatch.setattr("adlytics.__main__.write_report", keep)
    given = ["click_to_install", "--as-of", "2016-12-10"]
    main([*given, "--tables", root, "--output", f"{tmp_path}/plain"])
    main(
        [*given, "--tables", stored, "--output", f"{tmp_path}/clicks",
         "--layout", "apps_flyer_data=click_day"]
    )
    found = spark.read.parquet(f"{tmp_path}/clicks")
    assert rows(found) == rows(spark.read.parquet(f"{tmp_path}/plain")) != []
    text = written[f"{tmp_path}/clicks"].split("PartitionFilters")[1].split("]")[0]
    assert "click_day_partition#" in text
    with pytest.raises(SystemExit):
        main([*given, "--tables", stored, "--output", "x", "--layout", "apps_flyer_data=weekly"])


def test_daily_reports_replace_their_own_day_only(spark, root, tmp_path):
    output = f"{tmp_path}/daily"
    given = ["duplicate_ips", "--tables", root, "--output", output, "--daily", "--as-of"]
    for day in ("2016-12-10", "2016-12-11", "2030-01-01"):
        main([*given, day])
    before = rows(spark.read.parquet(output))
    assert [(r[-1].isoformat(), r[6]) for r in before] == [("2016-12-10", 21), ("2016-12-11", 21)]
    main([*given, "2016-12-11"])
    assert rows(spark.read.parquet(output)) == before
    # A day whose report is now empty leaves no rows of the earlier run.
    write_report(spark.read.parquet(output).drop("as_of").limit(0), output, as_of=date(2016, 12, 11))
    assert [r[-1].isoformat() for r in rows(spark.read.parquet(output))] == ["2016-12-10"]
