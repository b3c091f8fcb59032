"""Attribution tables derived from the generated test tables, as lazy DataFrames.

``fixtures.duckdb_tables`` states the same derivation as SQL for the oracle. Every table
uses all rows of what it is derived from, apart from the choice of event types that makes
a row an install, an in-app event or a cost row.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.functions import classify
from adlytics.sources.schemas import SCHEMAS

AS_OF = date(2024, 1, 31)
FIRST_DAY = date(2024, 1, 1)
LAST_DAY = date(2024, 1, 30)
STANDARD_APP = "Standard App"
STANDARD_APP_IDS = (1, 2)

_SOURCE_SCHEMAS = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "region": "r_regionkey int, r_name string",
}

_CAMPAIGNS = (
    "Burst", "burst", "Re-eng", "Retail", "x_gagement", "targeting_1", "Instagram_1",
    "fb/alg_1", "perf",
)
_SOURCES = (
    "googleadwords_int", "Organic", "twitter", "Facebook Ads", "net_a", "net_b"
)
_EXPORT_SUBS = ("sub0", "Re-sub", "sub_gagement", "Burst_sub", "targeting", "Rest")


def _pick(values: tuple[str, ...], index: str) -> str:
    names = ", ".join(f"'{value}'" for value in values)
    return f"element_at(array({names}), cast({index} + 1 as int))"


def _network_from(key: str) -> str:
    """Spreads any key over the 6 x 3 x 5 possible networks."""
    return f"(({key} % 6 + 1) * 1000 + ({key} div 6 % 3 + 1) * 100 + {key} div 18 % 5)"


_EV = (
    "event_id",
    "ts",
    "cast(ts as date) AS d",
    "event_type",
    "value",
    "k",
    "user_id % 3 + 1 AS app_id",
    "concat('app', user_id % 3 + 1) AS app_name",
    "user_id div 3 % 6 + 1 AS name_id",
    f"{_pick(_SOURCES, 'user_id div 3 % 6')} AS media_source",
    "user_id % 5 AS country_id",
    "concat('REGION_', user_id % 5) AS country_code",
    "if(event_id % 2 = 0, 'ios', 'android') AS os",
    f"{_pick(_CAMPAIGNS, 'event_id % 9')} AS campaign",
    "if(event_id % 11 != 0, event_id % 2, null) AS pub",
    "if(event_id % 13 != 0, event_id div 2 % 2, null) AS sub",
    "concat('pub', pub) AS network_publisher",
    "concat('sub', sub) AS network_sub_publisher",
    "cast(if(event_id % 29 != 0, event_id % 5, null) as int) AS source_provider_id",
    "concat_ws('.', '10', user_id, k % 5) AS ip",
    """CASE WHEN event_id % 19 = 0 THEN -k * 1000000
            WHEN event_id % 23 = 0 THEN k * 2000000 + 400000
            WHEN event_id % 2 = 0 THEN k * 2000000
            ELSE k * 3600000000 END AS delay""",
    """if(event_id % 17 != 0,
          concat('{"Click Time": "', timestampadd(MICROSECOND, -delay, ts), '"}'),
          '{}') AS raw_data""",
    "name_id * 1000 + app_id * 100 + country_id AS network_id",
)


class FixtureTables(Mapping[str, DataFrame]):
    """The 17 attribution tables; each is built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark = spark
        self._dir = sf_dir
        self._built: dict[str, DataFrame] = {}
        self._ev: DataFrame | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = getattr(self, f"_{name}")()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)

    def source(self, name: str) -> DataFrame:
        """One of the generated tables."""
        path = f"{self._dir}/{name}.parquet"
        return self._spark.read.schema(_SOURCE_SCHEMAS[name]).parquet(path)

    def ev(self) -> DataFrame:
        """Events with the attribution columns every fact is taken from."""
        if self._ev is None:
            k = "cast(get_json_object(props, '$.k') as bigint) AS k"
            self._ev = self.source("events").selectExpr("*", k).selectExpr(*_EV)
        return self._ev

    def _apps_flyer_data(self) -> DataFrame:
        return self.ev().selectExpr(
            "app_id", "campaign", "media_source AS network_name", "network_publisher",
            "network_sub_publisher", "country_code", "ts AS install_time",
            "source_provider_id", "ip", "raw_data",
        )

    def _apps_flyer_events(self) -> DataFrame:
        return (
            self.ev()
            .where("event_type = 'purchase'")
            .selectExpr(
                "app_id", "country_code", "media_source AS network_name",
                "network_publisher", "network_sub_publisher", "ts AS install_time",
            )
        )

    def _bime_export_aggregated_events(self) -> DataFrame:
        event_name = """
            CASE WHEN event_type = 'view' THEN 'impressions'
                 WHEN event_type = 'click' THEN 'clicks'
                 WHEN event_type = 'signup' THEN 'installs'
                 WHEN event_type = 'error' THEN if(event_id % 2 = 0, 'uninstall', null)
                 WHEN app_id = 3 AND k < 15 THEN 'created account (Unique users)'
                 WHEN app_id = 3 AND k < 30 THEN '14 day trial started (Unique users)'
                 WHEN app_id = 3 AND k < 45 THEN '1 week pass started (Unique users)'
                 WHEN app_id = 3 AND k < 55 THEN 'subscription started (Unique users)'
                 WHEN app_id = 3 AND k < 65 THEN 'started workout (Event counter)'
                 WHEN app_id = 3 AND k < 80 THEN 'finished workout (Event counter)'
                 WHEN k < 15 THEN 'signup (Unique users)'
                 WHEN k < 30 THEN 'category_choose (Event counter)'
                 WHEN k < 45 THEN 'order_location (Event counter)'
                 WHEN k < 55 THEN 'dummyevent1'
                 WHEN k < 65 THEN 'dummyevent2'
                 WHEN k < 80 THEN 'dummyevent3'
                 WHEN k < 90 THEN 'conversions'
                 ELSE 'total_revenue' END AS event_name"""
        total = """
            cast(sum(cast(CASE event_name WHEN 'total_revenue' THEN value
                                          WHEN 'dummyevent3' THEN 0 ELSE 1 END
                     as decimal(18,2))) as decimal(18,2)) AS count"""
        return (
            self.ev()
            .selectExpr("*", event_name)
            .groupBy(
                F.col("d").alias("date"), "app_id", "app_name", "country_code", "os",
                "media_source", "campaign", "event_name",
            )
            .agg(F.expr(total))
        )

    def _bime_export_installs(self) -> DataFrame:
        return (
            self.ev()
            .where("event_type = 'signup'")
            .selectExpr(
                "event_id AS id", "app_id", "media_source AS network_name",
                "if(event_id % 7 = 0, 'burst_pub', network_publisher) AS network_publisher",
                f"if(event_id % 13 != 0, {_pick(_EXPORT_SUBS, 'event_id % 6')}, null)"
                " AS network_sub_publisher",
                "country_code", "country_id", "d AS install_date",
                "cast(1 as bigint) AS installs",
                "if(event_id % 31 = 0, 'renamed', app_name) AS app_name", "os",
                "if(event_id % 5 = 0, 'Incent', 'Non') AS network_type",
                "cast(null as double) AS cpi",
                "if(event_id % 37 != 0, value, null) AS spend",
                "ts AS created_at", "ts AS updated_at",
            )
        )

    def _unconverting_sources(self) -> DataFrame:
        return (
            self.ev()
            .where("event_type = 'error'")
            .selectExpr("app_id", "country_id", "d AS date", "value AS spend")
        )

    def _cost_rows(self, event_type: str, *media: str) -> DataFrame:
        label = classify.media_label(F.col("media_source"), F.col("campaign"))
        return (
            self.ev()
            .where(F.col("event_type") == event_type)
            .select("*", label.alias("media"))
            .where(F.col("media").isin(*media))
            .select("*", classify.campaign_type(F.col("campaign")).alias("campaign_type"))
            .selectExpr(
                "*",
                f"if(app_id IN {STANDARD_APP_IDS}, '{STANDARD_APP}', 'Other') AS app_std",
                "k div 10 AS clicks",
            )
        )

    def _google_campaign_performance(self) -> DataFrame:
        return self._cost_rows("view", "googleadwords", classify.MEDIA_BUY).selectExpr(
            "app_std AS gac_app_name_std", "os AS gac_os", "media AS gac_main_source",
            "campaign_type AS gac_type", "country_code AS gac_country", "d AS date",
            "value AS costusd2", "k AS impressions", "clicks",
        )

    def _facebook_campaign_performance(self) -> DataFrame:
        return self._cost_rows("click", "facebook", "instagram").selectExpr(
            "app_std AS fb_app_name_std", "os", "media AS main_source", "campaign_type",
            "country_code AS fb_country_ext", "d AS date", "value AS spend",
            "k AS impressions", "clicks",
        )

    def _apps(self) -> DataFrame:
        return (
            self.source("events")
            .selectExpr("user_id % 3 + 1 AS id")
            .distinct()
            .selectExpr(
                "id", "concat('app', id) AS name", "if(id % 2 = 1, 'ios', 'android') AS os"
            )
        )

    def _countries(self) -> DataFrame:
        return self.source("region").selectExpr(
            "cast(r_regionkey as bigint) AS id", "concat('REGION_', r_regionkey) AS code"
        )

    def _apps_flyer_network_names(self) -> DataFrame:
        return self.ev().selectExpr("name_id AS id", "media_source AS name").distinct()

    def _apps_flyer_networks(self) -> DataFrame:
        return (
            self.ev()
            .selectExpr(
                "network_id AS id", "app_id", "name_id AS apps_flyer_network_name_id",
                "country_id",
            )
            .distinct()
        )

    def _apps_flyer_network_publishers(self) -> DataFrame:
        return (
            self.ev()
            .where("event_type = 'signup' AND pub IS NOT NULL")
            .selectExpr(
                "network_id * 10 + pub AS id", "network_id AS apps_flyer_network_id",
                "network_publisher AS name",
            )
            .distinct()
        )

    def _apps_flyer_network_sub_publishers(self) -> DataFrame:
        return (
            self.ev()
            .where("event_type = 'purchase' AND pub IS NOT NULL AND sub IS NOT NULL")
            .selectExpr(
                "(network_id * 10 + pub) * 10 + sub AS id",
                "network_id * 10 + pub AS apps_flyer_network_publisher_id",
                "network_sub_publisher AS name",
            )
            .distinct()
        )

    def _apps_flyer_network_attributes(self) -> DataFrame:
        return (
            self.source("customer")
            .selectExpr(
                f"{_network_from('c_custkey')} AS apps_flyer_network_id",
                "date_add(date'2024-01-04', cast(c_custkey div 90 % 9 * 3 as int))"
                " AS effective_date",
                "if(c_acctbal > 9000, 2, 1) AS network_type",
                "c_custkey % 40 AS price",
            )
            .groupBy("apps_flyer_network_id", "effective_date", "network_type")
            .agg(F.expr("max(price) / 10 + 0.5 AS cpi"))
        )

    def _apps_flyer_network_publisher_attributes(self) -> DataFrame:
        return (
            self.source("part")
            .selectExpr(
                f"{_network_from('p_partkey')} * 10 + p_partkey div 90 % 2"
                " AS apps_flyer_network_publisher_id",
                "date_add(date'2024-01-06', cast(p_partkey div 180 % 5 * 5 as int))"
                " AS effective_date",
                "p_size",
            )
            .groupBy("apps_flyer_network_publisher_id", "effective_date")
            .agg(F.expr("max(p_size) / 10 AS publisher_cpi"))
        )

    def _apps_flyer_network_sub_publisher_attributes(self) -> DataFrame:
        return (
            self.source("lineitem")
            .selectExpr(
                f"({_network_from('l_partkey')} * 10 + l_partkey div 90 % 2) * 10"
                " + l_partkey div 180 % 2 AS apps_flyer_network_sub_publisher_id",
                "date_add(date'2024-01-10', l_linenumber * 2) AS effective_date",
                "l_quantity",
            )
            .groupBy("apps_flyer_network_sub_publisher_id", "effective_date")
            .agg(F.expr("max(l_quantity) / 20 AS sub_publisher_cpi"))
        )

    def _mark_ups(self) -> DataFrame:
        """Custom mark-ups from the orders, defaults from the suppliers.

        Large orders and rich suppliers give a second row for a date, so ties do occur.
        """
        keys = ("apps_flyer_network_id", "user_id", "effective_date", "second")
        percent = F.expr("cast(max(percent) as decimal(9,4)) AS markup_percent")
        custom = (
            self.source("orders")
            .selectExpr(
                f"{_network_from('o_custkey')} AS apps_flyer_network_id",
                "cast(CASE o_orderstatus WHEN 'F' THEN 11 WHEN 'O' THEN 36 ELSE 40 END"
                " as bigint) AS user_id",
                "date_add(date'2024-01-05', cast(o_orderkey % 14 * 2 as int))"
                " AS effective_date",
                "o_totalprice > 490000 AS second",
                "o_custkey % 50 AS percent",
            )
            .groupBy(*keys)
            .agg(percent)
        )
        default = (
            self.source("supplier")
            .selectExpr(
                "cast(null as bigint) AS apps_flyer_network_id",
                "cast(CASE s_nationkey % 3 WHEN 0 THEN 11 WHEN 1 THEN 36 ELSE 40 END"
                " as bigint) AS user_id",
                "date_add(date'2024-01-02', cast(s_suppkey % 9 * 3 as int))"
                " AS effective_date",
                "s_acctbal > 9000 AS second",
                "s_suppkey % 30 AS percent",
            )
            .groupBy(*keys)
            .agg(percent)
        )
        return custom.union(default).drop("second")
