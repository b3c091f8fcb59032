"""The derivation of ``fixtures.spark_tables`` as DuckDB SQL, one CTE per table."""

from __future__ import annotations

_CAMPAIGNS = (
    "['Burst', 'burst', 'Re-eng', 'Retail', 'x_gagement', 'targeting_1', 'Instagram_1', "
    "'fb/alg_1', 'perf']"
)
_SOURCES = "['googleadwords_int', 'Organic', 'twitter', 'Facebook Ads', 'net_a', 'net_b']"
_EXPORT_SUBS = "['sub0', 'Re-sub', 'sub_gagement', 'Burst_sub', 'targeting', 'Rest']"


def _network_from(key: str) -> str:
    return f"(({key} % 6 + 1) * 1000 + ({key} // 6 % 3 + 1) * 100 + {key} // 18 % 5)"


_COST_ROWS = """
    SELECT CASE WHEN app_id IN (1, 2) THEN 'Standard App' ELSE 'Other' END AS app_std,
           os, country_code, d AS date, value, k AS impressions, k // 10 AS clicks, event_type,
           CASE WHEN contains(media_source, 'google') THEN 'googleadwords'
                WHEN contains(media_source, 'Organic') THEN 'organic'
                WHEN contains(media_source, 'twitter') THEN 'twitter'
                WHEN regexp_matches(campaign, 'Instagram|/.l[gG]') THEN 'instagram'
                WHEN contains(media_source, 'Face') THEN 'facebook'
                ELSE 'media buy' END AS media,
           CASE WHEN lower(campaign) = 'burst' THEN 'burst'
                WHEN regexp_matches(campaign, 'Re.|gagement|targeting') THEN 'retargeting'
                ELSE 'performance' END AS campaign_type
    FROM ev
"""

_CTES: dict[str, str] = {
    "ev": f"""
        SELECT event_id, ts, CAST(ts AS DATE) AS d, event_type, value, k,
               user_id % 3 + 1 AS app_id, 'app' || (user_id % 3 + 1) AS app_name,
               user_id // 3 % 6 + 1 AS name_id,
               ({_SOURCES})[user_id // 3 % 6 + 1] AS media_source,
               user_id % 5 AS country_id, 'REGION_' || (user_id % 5) AS country_code,
               CASE WHEN event_id % 2 = 0 THEN 'ios' ELSE 'android' END AS os,
               ({_CAMPAIGNS})[event_id % 9 + 1] AS campaign,
               CASE WHEN event_id % 11 <> 0 THEN event_id % 2 END AS pub,
               CASE WHEN event_id % 13 <> 0 THEN event_id // 2 % 2 END AS sub,
               'pub' || pub AS network_publisher, 'sub' || sub AS network_sub_publisher,
               CASE WHEN event_id % 29 <> 0 THEN event_id % 5 END AS source_provider_id,
               '10.' || user_id || '.' || (k % 5) AS ip,
               CASE WHEN event_id % 17 <> 0 THEN ts - to_microseconds(
                   CASE WHEN event_id % 19 = 0 THEN -k * 1000000
                        WHEN event_id % 23 = 0 THEN k * 2000000 + 400000
                        WHEN event_id % 2 = 0 THEN k * 2000000
                        ELSE k * 3600000000 END) END AS click_ts,
               CASE WHEN click_ts IS NULL THEN '{{}}'
                    ELSE '{{"Click Time": "' || click_ts || '"}}' END AS raw_data,
               name_id * 1000 + app_id * 100 + country_id AS network_id
        FROM (SELECT *, CAST(props ->> 'k' AS BIGINT) AS k FROM events)
    """,
    "apps_flyer_data": """
        SELECT app_id, campaign, media_source AS network_name, network_publisher,
               network_sub_publisher, country_code, ts AS install_time, source_provider_id,
               ip, raw_data
        FROM ev
    """,
    "apps_flyer_events": """
        SELECT app_id, country_code, media_source AS network_name, network_publisher,
               network_sub_publisher, ts AS install_time
        FROM ev WHERE event_type = 'purchase'
    """,
    "bime_export_aggregated_events": """
        SELECT d AS date, app_id, app_name, country_code, os, media_source, campaign,
               event_name,
               sum(CAST(CASE event_name WHEN 'total_revenue' THEN value
                                        WHEN 'dummyevent3' THEN 0 ELSE 1 END
                        AS DECIMAL(18, 2))) AS count
        FROM (
            SELECT *, CASE
                WHEN event_type = 'view' THEN 'impressions'
                WHEN event_type = 'click' THEN 'clicks'
                WHEN event_type = 'signup' THEN 'installs'
                WHEN event_type = 'error' THEN
                    CASE WHEN event_id % 2 = 0 THEN 'uninstall' END
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
                ELSE 'total_revenue' END AS event_name
            FROM ev)
        GROUP BY ALL
    """,
    "bime_export_installs": f"""
        SELECT event_id AS id, app_id, media_source AS network_name,
               CASE WHEN event_id % 7 = 0 THEN 'burst_pub' ELSE network_publisher END
                   AS network_publisher,
               CASE WHEN event_id % 13 <> 0 THEN ({_EXPORT_SUBS})[event_id % 6 + 1] END
                   AS network_sub_publisher,
               country_code, country_id, d AS install_date, 1 AS installs,
               CASE WHEN event_id % 31 = 0 THEN 'renamed' ELSE app_name END AS app_name, os,
               CASE WHEN event_id % 5 = 0 THEN 'Incent' ELSE 'Non' END AS network_type,
               CASE WHEN event_id % 37 <> 0 THEN value END AS spend
        FROM ev WHERE event_type = 'signup'
    """,
    "unconverting_sources": """
        SELECT app_id, country_id, d AS date, value AS spend FROM ev WHERE event_type = 'error'
    """,
    "google_campaign_performance": f"""
        SELECT app_std AS gac_app_name_std, os AS gac_os, media AS gac_main_source,
               campaign_type AS gac_type, country_code AS gac_country, date,
               value AS costusd2, impressions, clicks
        FROM ({_COST_ROWS})
        WHERE event_type = 'view' AND media IN ('googleadwords', 'media buy')
    """,
    "facebook_campaign_performance": f"""
        SELECT app_std AS fb_app_name_std, os, media AS main_source, campaign_type,
               country_code AS fb_country_ext, date, value AS spend, impressions, clicks
        FROM ({_COST_ROWS})
        WHERE event_type = 'click' AND media IN ('facebook', 'instagram')
    """,
    "apps": """
        SELECT DISTINCT user_id % 3 + 1 AS id, 'app' || (user_id % 3 + 1) AS name,
               CASE WHEN (user_id % 3 + 1) % 2 = 1 THEN 'ios' ELSE 'android' END AS os
        FROM events
    """,
    "countries": """
        SELECT CAST(r_regionkey AS BIGINT) AS id, 'REGION_' || r_regionkey AS code FROM region
    """,
    "apps_flyer_network_names": """
        SELECT DISTINCT name_id AS id, media_source AS name FROM ev
    """,
    "apps_flyer_networks": """
        SELECT DISTINCT network_id AS id, app_id, name_id AS apps_flyer_network_name_id,
               country_id
        FROM ev
    """,
    "apps_flyer_network_publishers": """
        SELECT DISTINCT network_id * 10 + pub AS id, network_id AS apps_flyer_network_id,
               network_publisher AS name
        FROM ev WHERE event_type = 'signup' AND pub IS NOT NULL
    """,
    "apps_flyer_network_sub_publishers": """
        SELECT DISTINCT (network_id * 10 + pub) * 10 + sub AS id,
               network_id * 10 + pub AS apps_flyer_network_publisher_id,
               network_sub_publisher AS name
        FROM ev WHERE event_type = 'purchase' AND pub IS NOT NULL AND sub IS NOT NULL
    """,
    "apps_flyer_network_attributes": f"""
        SELECT {_network_from('c_custkey')} AS apps_flyer_network_id,
               DATE '2024-01-04' + CAST(c_custkey // 90 % 9 * 3 AS INTEGER) AS effective_date,
               max(c_custkey % 40) / 10 + 0.5 AS cpi, if(c_acctbal > 9000, 2, 1) AS network_type
        FROM customer GROUP BY ALL
    """,
    "apps_flyer_network_publisher_attributes": f"""
        SELECT {_network_from('p_partkey')} * 10 + p_partkey // 90 % 2
                   AS apps_flyer_network_publisher_id,
               DATE '2024-01-06' + CAST(p_partkey // 180 % 5 * 5 AS INTEGER) AS effective_date,
               max(p_size) / 10 AS publisher_cpi
        FROM part GROUP BY ALL
    """,
    "apps_flyer_network_sub_publisher_attributes": f"""
        SELECT ({_network_from('l_partkey')} * 10 + l_partkey // 90 % 2) * 10
                   + l_partkey // 180 % 2 AS apps_flyer_network_sub_publisher_id,
               DATE '2024-01-10' + CAST(l_linenumber * 2 AS INTEGER) AS effective_date,
               max(l_quantity) / 20 AS sub_publisher_cpi
        FROM lineitem GROUP BY ALL
    """,
    "mark_ups": f"""
        SELECT apps_flyer_network_id, user_id, effective_date,
               CAST(percent AS DECIMAL(9, 4)) AS markup_percent
        FROM (
            SELECT {_network_from('o_custkey')} AS apps_flyer_network_id,
                   CASE o_orderstatus WHEN 'F' THEN 11 WHEN 'O' THEN 36 ELSE 40 END AS user_id,
                   DATE '2024-01-05' + CAST(o_orderkey % 14 * 2 AS INTEGER) AS effective_date,
                   o_totalprice > 490000 AS second, max(o_custkey % 50) AS percent
            FROM orders GROUP BY ALL
            UNION ALL
            SELECT NULL, CASE s_nationkey % 3 WHEN 0 THEN 11 WHEN 1 THEN 36 ELSE 40 END,
                   DATE '2024-01-02' + CAST(s_suppkey % 9 * 3 AS INTEGER),
                   s_acctbal > 9000, max(s_suppkey % 30)
            FROM supplier GROUP BY ALL)
    """,
}

_OWN_SOURCE = {
    "apps",
    "countries",
    "apps_flyer_network_attributes",
    "apps_flyer_network_publisher_attributes",
    "apps_flyer_network_sub_publisher_attributes",
    "mark_ups",
}


def with_tables(query: str, *names: str, **stages: str) -> str:
    """``query`` preceded by the named tables and by further ``stages``, as one WITH."""
    wanted = dict.fromkeys(names)
    if any(name not in _OWN_SOURCE for name in wanted):
        wanted = {"ev": None, **wanted}
    ctes = [f"{name} AS ({_CTES[name]})" for name in wanted]
    ctes += [f"{name} AS ({sql})" for name, sql in stages.items()]
    return f"WITH {', '.join(ctes)} {query}"


TABLES = tuple(name for name in _CTES if name != "ev")
