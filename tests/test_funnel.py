from __future__ import annotations

import random
from collections import defaultdict
from datetime import date
from decimal import Decimal

import pytest
from helpers import plan, rows

from adlytics.plans import funnel
from adlytics.plans.spec import FunnelSpec, fitness_funnel, marketplace_funnel
from adlytics.sources import SCHEMAS

AS_OF = date(2024, 4, 30)
DAY = date(2024, 4, 1)
SPEC = FunnelSpec(
    as_of=AS_OF, app_ids=(69, 70), country_codes=("IL",), markup_user_id=36,
    installs_since=date(2016, 1, 1),
)
NETWORK_SPEC = FunnelSpec(
    as_of=AS_OF, app_ids=(69, 70), country_codes=("IL",), markup_user_id=36,
    installs_since=date(2016, 1, 1), by_network=True,
)


@pytest.fixture
def make(spark):
    def build(**data):
        return {
            name: spark.createDataFrame(data.get(name, []), schema)
            for name, schema in SCHEMAS.items()
        }

    return build


def event(name="installs", count=1, source="net", campaign="c", **other):
    row = {
        "date": DAY, "app_id": 69, "app_name": "app", "country_code": "IL", "os": "ios",
        "media_source": source, "campaign": campaign, "event_name": name,
        "count": Decimal(count), **other,
    }
    return tuple(row.values())


def export(installs=1, spend=10.0, network="net", **other):
    row = {
        "id": 1, "app_id": 69, "network_name": network, "network_publisher": "p",
        "network_sub_publisher": "s", "country_code": "IL", "country_id": 7,
        "install_date": DAY, "installs": installs, "app_name": "app", "os": "ios",
        "network_type": "Non", "cpi": None, "spend": spend, "created_at": None,
        "updated_at": None, **other,
    }
    return tuple(row.values())


NETWORKS = {
    "apps_flyer_network_names": [(70, "net"), (71, "net2")],
    "apps_flyer_networks": [(100, 69, 70, 7), (101, 69, 71, 7)],
    "mark_ups": [(100, 36, date(2024, 1, 1), Decimal(50)), (101, 36, DAY, Decimal(100))],
}


def test_rollup_filters_and_sums(make):
    t = make(
        bime_export_aggregated_events=[
            event(count=2), event(count=3, source="net2"), event(name="unknown"),
            event(name=None), event(app_id=71), event(country_code="US"),
            event(date=date(2024, 1, 27)), event(date=date(2024, 1, 28), count=7),
            event(source="Organic", count=4), event(campaign="Burst", count=5),
        ]
    )
    found = funnel.event_rollup(t["bime_export_aggregated_events"], SPEC)
    assert rows(found, "date", "media", "campaign_type", "totals") == [
        (date(2024, 1, 28), "media buy", "performance", 7.0),
        (DAY, "media buy", "burst", 5.0),
        (DAY, "media buy", "performance", 5.0),
        (DAY, "organic", "performance", 4.0),
    ]
    by_network = funnel.event_rollup(t["bime_export_aggregated_events"], NETWORK_SPEC)
    assert rows(by_network.where("date = '2024-04-01' AND media = 'media buy'"),
                "media_source", "campaign_type", "totals") == [
        ("net", "burst", 5.0), ("net", "performance", 2.0), ("net2", "performance", 3.0),
    ]


def test_spend_is_marked_up_per_network_and_lost_without_mark_up(make):
    t = make(
        **NETWORKS,
        bime_export_installs=[
            export(installs=2, spend=10.0),
            export(installs=1, spend=10.0, network="net2"),
            export(installs=4, spend=None),
            export(installs=8, spend=5.0, network="net2", install_date=date(2024, 3, 31)),
            export(network="unknown"), export(app_id=1),
            export(install_date=date(2015, 12, 31)),
        ],
    )
    assert rows(funnel.markup_spend(t, SPEC), "install_date", "media", "installs", "spend") == [
        (date(2024, 3, 31), "media buy", 8, None),
        (DAY, "media buy", 7, 35.0),
    ]
    by_network = funnel.markup_spend(t, NETWORK_SPEC)
    assert rows(by_network, "install_date", "network_name", "installs", "spend") == [
        (date(2024, 3, 31), "net2", 8, None), (DAY, "net", 6, 15.0), (DAY, "net2", 1, 20.0),
    ]


def test_tied_mark_ups_multiply_installs_and_spend(make):
    t = make(
        apps_flyer_network_names=NETWORKS["apps_flyer_network_names"],
        apps_flyer_networks=NETWORKS["apps_flyer_networks"],
        mark_ups=[(100, 36, DAY, Decimal(0)), (100, 36, DAY, Decimal(50))],
        bime_export_installs=[export(installs=3, spend=10.0)],
    )
    assert rows(funnel.markup_spend(t, SPEC), "installs", "spend") == [(6, 25.0)]


def test_spend_meets_bought_media_only_and_repeats_per_event(make):
    t = make(
        **NETWORKS,
        bime_export_aggregated_events=[
            event(), event(name="clicks", count=9), event(source="Organic"),
        ],
        bime_export_installs=[export(installs=2, spend=10.0)],
    )
    found = funnel.funnel_report(t, SPEC)
    assert found.columns == [
        "date", "app_id", "app_name", "country_code", "os", "media", "campaign_type",
        "event_name", "totals", "fin_installs", "spend",
    ]
    got = [(r.event_name, r.media, float(r.totals), r.fin_installs, r.spend)
           for r in found.collect()]
    assert got == [
        ("clicks", "media buy", 9.0, 2, Decimal("15.00")),
        ("installs", "media buy", 1.0, 2, Decimal("15.00")),
        ("installs", "organic", 1.0, None, None),
    ]


def test_network_funnel_joins_on_the_network(make):
    t = make(
        **NETWORKS,
        bime_export_aggregated_events=[event(), event(source="net3")],
        bime_export_installs=[export(spend=10.0), export(spend=10.0, network="net2")],
    )
    found = funnel.funnel_report(t, NETWORK_SPEC)
    assert found.columns[3] == "media_source"
    assert rows(found, "media_source", "spend") == [("net", 15.0), ("net3", None)]


def test_renamed_apps_fan_out_and_equal_ones_add_up(make):
    t = make(
        **NETWORKS,
        bime_export_aggregated_events=[event(count=3)],
        bime_export_installs=[
            export(spend=10.0), export(spend=10.0, app_name="new"),
            export(spend=4.0, app_name="newer"),
        ],
    )
    assert rows(funnel.funnel(t, SPEC), "totals", "fin_installs", "spend") == [
        (3.0, 1, 6.0), (6.0, 1, 15.0),
    ]


def test_wide_has_null_for_missing_events_and_can_repeat_keys(make):
    t = make(
        **NETWORKS,
        bime_export_aggregated_events=[event(count=3), event(name="conversions", count=2)],
        bime_export_installs=[
            export(installs=1, spend=10.0), export(installs=5, spend=10.0, app_name="new"),
        ],
    )
    wide = funnel.funnel_wide_report(t, SPEC)
    assert wide.columns[7:] == ["mrs_spend", *SPEC.event_columns.values()]
    assert rows(wide, "mrs_spend", "installs", "clicks", "conversions") == [
        (15.0, 3.0, None, 2.0), (15.0, 3.0, None, 2.0),
    ]


def test_wide_by_network_names_the_network(make):
    t = make(bime_export_aggregated_events=[event(count=3)])
    wide = funnel.funnel_wide_report(t, NETWORK_SPEC)
    assert wide.columns[:5] == ["date", "app_id", "app_name", "network_name", "country_code"]
    assert rows(wide, "network_name", "installs") == [("net", 3.0)]


def test_wide_adds_one_shuffle(make):
    t = make(**NETWORKS)
    long = funnel.funnel(t, SPEC)
    wide = funnel.funnel_wide(long, SPEC.event_columns)
    assert plan(wide).count("Exchange hash") - plan(long).count("Exchange hash") <= 1


def test_paid_media_is_distinct_across_and_within(make):
    google = ("App", "ios", "m", "t", "IL", DAY, 1.0, 2, 3)
    facebook = ("App", "ios", "m", "t", "IL", DAY, 1.0, 2, 3)
    other = ("Other", *google[1:])
    t = make(
        google_campaign_performance=[google, google, other],
        facebook_campaign_performance=[facebook, other, (*facebook[:6], 9.0, 2, 3)],
    )
    found = funnel.paid_media(
        t["google_campaign_performance"], t["facebook_campaign_performance"], "App"
    )
    assert found.columns == [
        "app_name_std", "os", "media", "campaign_type", "country_code", "date", "cost",
        "impressions", "clicks",
    ]
    assert rows(found, "cost") == [(1.0,), (9.0,)]


WIDE = (
    "date date, app_id bigint, app_name string, country_code string, os string, media string, "
    "campaign_type string, mrs_spend decimal(20,2), impressions decimal(20,2), "
    "clicks decimal(20,2), installs decimal(20,2), event_1 decimal(20,2), "
    "event_2 decimal(20,2), event_3 decimal(20,2), event_4 decimal(20,2), "
    "event_5 decimal(20,2), event_6 decimal(20,2), conversions decimal(20,2), "
    "total_revenue decimal(20,2)"
)
COST = (
    "app_name_std string, os string, media string, campaign_type string, "
    "country_code string, date date, cost double, impressions bigint, clicks bigint"
)


def wide_row(media="media buy", app=69, spend=1, measure=1, country="IL"):
    return (
        DAY, app, "app", country, "ios", media, "performance",
        None if spend is None else Decimal(spend), *[Decimal(measure)] * 11,
    )


def cost_row(media="media buy", app="App", cost=10.0, country="IL", n=100):
    return (app, "ios", media, "performance", country, DAY, cost, n, n)


def full(spark, wide, cost, **options):
    return funnel.funnel_full(
        spark.createDataFrame(wide, WIDE),
        spark.createDataFrame(cost, COST),
        (69, 70),
        "App",
        **options,
    )


def test_full_sums_over_all_pairs_and_blends_by_media(spark):
    found = full(
        spark,
        [wide_row(), wide_row(app=70), wide_row(media="facebook"), wide_row(media="organic")],
        [cost_row(), cost_row(cost=20.0), cost_row(cost=30.0), cost_row(media="facebook")],
    )
    assert rows(
        found, "media", "date", "mrs_cost", "gac_fb_cost", "total_installs",
        "total_impressions", "total_clicks", "total_cost",
    ) == [
        ("facebook", "2024-04-01", 1.0, 10.0, 1.0, 100.0, 100.0, 10.0),
        ("media buy", "2024-04-01", 6.0, 120.0, 6.0, 6.0, 6.0, 6.0),
        ("organic", "2024-04-01", 1.0, None, 1.0, None, None, None),
    ]


def test_full_counts_each_side_once_when_pre_aggregated(spark):
    found = full(
        spark,
        [wide_row(), wide_row(app=70), wide_row(media="facebook"), wide_row(media="organic")],
        [cost_row(), cost_row(cost=20.0), cost_row(cost=30.0), cost_row(media="facebook"),
         cost_row(media="twitter", cost=7.0), cost_row(media=None, cost=5.0)],
        pre_aggregate=True,
    )
    assert rows(
        found, "media", "mrs_cost", "gac_fb_cost", "total_installs", "total_impressions",
        "total_clicks", "total_cost",
    ) == [
        ("facebook", 1.0, 10.0, 1.0, 100.0, 100.0, 10.0),
        ("media buy", 2.0, 60.0, 2.0, 2.0, 2.0, 2.0),
        ("organic", 1.0, None, 1.0, None, None, None),
        (None, None, 12.0, None, 200.0, 200.0, 12.0),
    ]


def test_full_folds_unmatched_cost_and_unknown_apps(spark):
    found = full(
        spark,
        [wide_row(app=1), wide_row(spend=None)],
        [cost_row(media="a"), cost_row(media="b", cost=5.0), cost_row(media=None, cost=2.0)],
    )
    assert rows(
        found, "app_name_std", "media", "mrs_cost", "gac_fb_cost", "total_cost"
    ) == [
        ("App", "media buy", None, None, None),
        (None, "media buy", 1.0, None, 1.0),
        (None, None, None, 17.0, 17.0),
    ]


def test_full_equals_the_join_of_all_pairs(spark):
    rng = random.Random(5)
    media = [None, "media buy", "facebook", "google", "twitter"]
    wide = [
        wide_row(rng.choice(media), rng.choice([1, 69, 70]), rng.choice([None, 1, 2, 3]),
                 rng.randrange(9), rng.choice(["IL", "US", None]))
        for _ in range(40)
    ]
    cost = [
        cost_row(rng.choice(media), rng.choice(["App", None]), float(rng.randrange(50)),
                 rng.choice(["IL", "US", "FR"]), rng.randrange(99))
        for _ in range(40)
    ]
    expected = defaultdict(lambda: [None, None, None, None])

    def add(key, *values):
        sums = expected[key]
        for i, value in enumerate(values):
            if value is not None:
                sums[i] = value + (sums[i] or 0)

    hit = set()
    for w in wide:
        name = "App" if w[1] in (69, 70) else None
        key = (name, w[3], w[5])
        spend = None if w[7] is None else float(w[7])
        pairs = [
            (i, c) for i, c in enumerate(cost)
            if None not in (name, w[3], w[5]) and (c[0], c[4], c[2]) == key
        ]
        hit |= {i for i, _ in pairs}
        for _, c in pairs:
            add(key + (str(DAY),), spend, float(w[8]), c[6], c[7])
        if not pairs:
            add(key + (str(DAY),), spend, float(w[8]), None, None)
    for i, c in enumerate(cost):
        if i not in hit:
            add((None, None, None, None), None, None, c[6], c[7])
    found = full(spark, wide, cost)
    assert rows(
        found, "app_name_std", "country_code", "media", "date", "mrs_cost", "mrs_impressions",
        "gac_fb_cost", "gac_fb_impressions",
    ) == sorted(((*k, *v) for k, v in expected.items()), key=str)


def test_published_specs():
    assert marketplace_funnel(AS_OF).event_columns["signup (Unique users)"] == "event_1"
    spec = fitness_funnel(AS_OF)
    assert spec.by_network and spec.event_columns["created account (Unique users)"] == "event_1"
    assert len(spec.event_columns) == 11


def test_each_filter_of_the_narrowed_funnel_drops_rows(spark):
    from dataclasses import replace

    from adlytics.plans import funnel as plans
    from fixtures.queries import BY_MEDIA, NARROWED
    from fixtures.spark_tables import FixtureTables

    tables = FixtureTables(spark, "/root/testdata/sf0.001")
    narrow = rows(plans.funnel(tables, replace(BY_MEDIA, **NARROWED)))
    for name in NARROWED:
        rest = {k: v for k, v in NARROWED.items() if k != name}
        assert rows(plans.funnel(tables, replace(BY_MEDIA, **rest))) != narrow, name


def test_the_last_day_of_spend_is_sought_among_the_rows_used(spark, tmp_path):
    from adlytics.sources import read_tables, write_fact
    from adlytics.sources.schemas import SCHEMAS

    names = ("bime_export_installs", "apps_flyer_network_names", "apps_flyer_networks", "mark_ups")
    other_app = (1, 1, "net", "pub", "sub", "US", 7, date(2030, 1, 1), 1, *[None] * 7)
    for name in names:
        if name == "bime_export_installs":
            export = spark.createDataFrame([other_app], SCHEMAS[name])
            write_fact(export, f"{tmp_path}/{name}", "install_date")
        else:
            spark.createDataFrame([], SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}")
    tables = read_tables(
        spark, str(tmp_path), names, layouts={"bime_export_installs": "day"}
    )
    spend = funnel.markup_spend(tables, marketplace_funnel(AS_OF))
    assert rows(spend) == []
    scans = [s for s in plan(spend).split("FileScan")[1:] if "install_date#" in s.split("]")[0]]
    assert scans
    for scan in scans:
        assert "day_partition#" in scan.split("PartitionFilters")[1].split("]")[0]
        assert "In(app_id" in scan
