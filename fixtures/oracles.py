"""DuckDB SQL with the results ``fixtures.queries`` must give.

Where the library rewrites a definition (as-of lookup, conditional pivot, full join without
pairs, counting before joining) the SQL keeps the plain form: a correlated maximum, one
correlated sum per column, the join of all pairs. Patterns are tested by other means than
LIKE chains.
"""

from __future__ import annotations

from fixtures.duckdb_tables import with_tables

_B, _D, _V, _DATE = "BIGINT", "DOUBLE", "VARCHAR", "DATE"


def _comparable(query: str, **columns: str) -> str:
    """``query`` with every column cast to its type and fractions rounded."""
    casts = []
    for column, kind in columns.items():
        value = f'CAST("{column}" AS {kind})'
        casts.append(f'{f"round({value}, 6)" if kind == _D else value} AS "{column}"')
    return f"SELECT {', '.join(casts)} FROM ({query})"


_SOURCE4 = {
    "app_id": _B, "network_name": _V, "network_publisher": _V, "network_sub_publisher": _V,
}
_SOURCE5 = {**_SOURCE4, "country_code": _V}
_DAILY = {
    "app_id": _B, "campaign": _V, "network_name": _V, "network_publisher": _V,
    "network_sub_publisher": _V, "country_code": _V, "install_date": _DATE,
    "source_provider_id": _B,
}

# ---------------------------------------------------------------- finance

_DAILY_SQL = """
    SELECT app_id, campaign, network_name, network_publisher, network_sub_publisher,
           country_code, countries.id AS country_id,
           CAST(install_time AS DATE) AS install_date, source_provider_id,
           count(install_time) AS installs
    FROM apps_flyer_data
    JOIN apps_flyer_network_names names ON names.name = network_name
    JOIN countries ON countries.code = country_code
    WHERE install_time BETWEEN TIMESTAMP '2024-01-01 00:00:00'
                           AND TIMESTAMP '2024-01-30 23:59:59'
    GROUP BY ALL
"""
_PLACED_SQL = """
    SELECT daily.*, networks.id AS network_id
    FROM daily
    JOIN apps_flyer_network_names names ON names.name = daily.network_name
    JOIN apps_flyer_networks networks
      ON networks.app_id = daily.app_id AND networks.country_id = daily.country_id
     AND networks.apps_flyer_network_name_id = names.id
"""


def _asof(alias: str, table: str, key: str, owner: str, day: str, user: int | None = None) -> str:
    """A left join on the latest effective date, as a correlated maximum."""
    own = f" AND {{0}}.user_id = {user}" if user is not None else ""
    return f"""
        LEFT JOIN {table} {alias}
          ON {alias}.{key} = {owner}{own.format(alias)}
         AND {alias}.effective_date = (
             SELECT max(h.effective_date) FROM {table} h
             WHERE h.{key} = {owner} AND h.effective_date <= {day}{own.format('h')})
    """


def _default_markup(alias: str, day: str, user: int) -> str:
    return f"""
        LEFT JOIN mark_ups {alias}
          ON {alias}.apps_flyer_network_id IS NULL AND {alias}.user_id = {user}
         AND {alias}.effective_date = (
             SELECT max(h.effective_date) FROM mark_ups h
             WHERE h.apps_flyer_network_id IS NULL AND h.user_id = {user}
               AND h.effective_date <= {day})
    """


_ENRICHED_SQL = f"""
    SELECT p.*, apps.name AS app_name, apps.os, na.network_type, na.cpi AS network_cpi,
           pub.id AS publisher_id, pa.publisher_cpi,
           sub.id AS sub_publisher_id, sa.sub_publisher_cpi
    FROM placed p
    JOIN apps ON apps.id = p.app_id
    {_asof('na', 'apps_flyer_network_attributes', 'apps_flyer_network_id', 'p.network_id',
           'p.install_date')}
    LEFT JOIN apps_flyer_network_publishers pub
      ON pub.apps_flyer_network_id = p.network_id AND pub.name = p.network_publisher
    {_asof('pa', 'apps_flyer_network_publisher_attributes',
           'apps_flyer_network_publisher_id', 'pub.id', 'p.install_date')}
    LEFT JOIN apps_flyer_network_sub_publishers sub
      ON sub.apps_flyer_network_publisher_id = pub.id AND sub.name = p.network_sub_publisher
    {_asof('sa', 'apps_flyer_network_sub_publisher_attributes',
           'apps_flyer_network_sub_publisher_id', 'sub.id', 'p.install_date')}
"""
_MARKED_UP_SQL = f"""
    SELECT e.*, CASE WHEN cm.markup_percent IS NOT NULL THEN cm.markup_percent
                     ELSE dm.markup_percent END AS markup_percent
    FROM {{facts}} e
    {_asof('cm', 'mark_ups', 'apps_flyer_network_id', 'e.network_id', 'e.install_date', 11)}
    {_default_markup('dm', 'e.install_date', 11)}
"""
_CPI_SQL = """
    CASE WHEN sub_publisher_cpi IS NOT NULL THEN sub_publisher_cpi
         WHEN publisher_cpi IS NOT NULL THEN publisher_cpi ELSE network_cpi END
"""
_UNCONVERTING_SQL = f"""
    SELECT u.app_id, 'unconverting_source' AS campaign, 'unconverting_source' AS network_name,
           'unconverting_source' AS network_publisher,
           'unconverting_source' AS network_sub_publisher, countries.code AS country_code,
           u.country_id, u.date AS install_date, 4 AS source_provider_id,
           NULL AS installs, apps.name AS app_name, apps.os, 2 AS network_type, NULL AS cpi,
           u.spend, dm.markup_percent
    FROM unconverting_sources u
    JOIN apps ON apps.id = u.app_id
    JOIN countries ON countries.id = u.country_id
    {_default_markup('dm', 'u.date', 11)}
    WHERE u.date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
"""
_REPORT = {
    **_DAILY, "country_id": _B, "installs": _B, "app_name": _V, "os": _V,
    "network_type": _B, "cpi": _D, "spend": _D, "markup_percent": _D,
}
_DAILY_TABLES = ("apps_flyer_data", "apps_flyer_network_names", "countries")
_PLACED_TABLES = (*_DAILY_TABLES, "apps_flyer_networks")
_HIERARCHY_TABLES = (
    *_PLACED_TABLES, "apps", "apps_flyer_network_attributes",
    "apps_flyer_network_publishers", "apps_flyer_network_publisher_attributes",
    "apps_flyer_network_sub_publishers", "apps_flyer_network_sub_publisher_attributes",
)
_PLACED_STAGES = {"daily": _DAILY_SQL, "placed": _PLACED_SQL}
_HIERARCHY_STAGES = {**_PLACED_STAGES, "enriched": _ENRICHED_SQL}

# ---------------------------------------------------------------- fraud

_COHORTS_SQL = """
    SELECT app_id, network_name, network_publisher, network_sub_publisher,
           CASE WHEN micros <= 30000000 THEN '<30' WHEN micros <= 120000000 THEN '<120'
                ELSE '>120' END AS classification,
           count(app_id) AS total_installs
    FROM (SELECT *, epoch_us(install_time)
                    - epoch_us(CAST(raw_data ->> 'Click Time' AS TIMESTAMP)) AS micros
          FROM apps_flyer_data)
    WHERE app_id IN (1, 2, 3) AND install_time >= DATE '2024-01-31' - INTERVAL {days} DAY
    GROUP BY ALL
"""


def _cohort_sum(label: str) -> str:
    same = " AND ".join(f"c.{column} = o.{column}" for column in _SOURCE4)
    return f"""(SELECT sum(c.total_installs) FROM cohorts c
                WHERE c.classification = '{label}' AND {same}) AS "{label}" """


_PIVOT_SQL = f"""
    SELECT *, {_cohort_sum('>120')}, {_cohort_sum('<120')}, {_cohort_sum('<30')}
    FROM (SELECT {', '.join(_SOURCE4)}, sum(total_installs) AS total_installs
          FROM cohorts GROUP BY ALL) o
"""
_PIVOT = {**_SOURCE4, "total_installs": _B, ">120": _B, "<120": _B, "<30": _B}


def _cohorts(days: int) -> str:
    return with_tables(
        _comparable(
            "SELECT * FROM cohorts", **_SOURCE4, classification=_V, total_installs=_B
        ),
        "apps_flyer_data",
        cohorts=_COHORTS_SQL.format(days=days),
    )


def _pivot(days: int) -> str:
    return with_tables(
        _comparable(_PIVOT_SQL, **_PIVOT),
        "apps_flyer_data",
        cohorts=_COHORTS_SQL.format(days=days),
    )


def _fast_share(days: int) -> str:
    return with_tables(
        _comparable(
            """SELECT p.*, CAST("<30" AS DOUBLE) / total_installs AS "<30_volume", apps.name
               FROM pivoted p JOIN apps ON apps.id = p.app_id""",
            **_PIVOT,
            **{"<30_volume": _D, "name": _V},
        ),
        "apps_flyer_data",
        "apps",
        cohorts=_COHORTS_SQL.format(days=days),
        pivoted=_PIVOT_SQL,
    )


def _distribution(days: int) -> str:
    return with_tables(
        _comparable(
            f"""
            SELECT apps.name, {', '.join(_SOURCE5)},
                   CASE WHEN hours <= 1 THEN 'first_hour' WHEN hours <= 24 THEN 'first_day'
                        WHEN hours <= 48 THEN 'second_day' WHEN hours <= 72 THEN 'third_day'
                        ELSE 'more_than_3_days' END AS classification,
                   count(*) AS total_count
            FROM (SELECT *, (epoch_us(install_time) - epoch_us(clicked)) / 3600e6 AS hours
                  FROM (SELECT *, CAST(raw_data ->> 'Click Time' AS TIMESTAMP) AS clicked
                        FROM apps_flyer_data)) i
            JOIN apps ON apps.id = i.app_id
            WHERE clicked >= DATE '2024-01-31' - INTERVAL {days} DAY
              AND source_provider_id NOT IN (3)
            GROUP BY ALL""",
            name=_V,
            **_SOURCE5,
            classification=_V,
            total_count=_B,
        ),
        "apps_flyer_data",
        "apps",
    )


def _duplicate_ips(days: int, least: int) -> str:
    return with_tables(
        _comparable(
            f"""
            SELECT apps.name, s.*, distinct_ips / total_ips AS ratio
            FROM (SELECT {', '.join(_SOURCE5)}, count(ip) AS total_ips,
                         count(DISTINCT ip) AS distinct_ips
                  FROM apps_flyer_data
                  WHERE install_time >= DATE '2024-01-31' - INTERVAL {days} DAY
                    AND source_provider_id NOT IN (3)
                  GROUP BY ALL) s
            JOIN apps ON apps.id = s.app_id
            WHERE total_ips >= {least} AND distinct_ips * 10 <= total_ips * 9""",
            name=_V,
            **_SOURCE5,
            total_ips=_B,
            distinct_ips=_B,
            ratio=_D,
        ),
        "apps_flyer_data",
        "apps",
    )


def _without_events(days: int, least: int) -> str:
    def counted(table: str, measure: str) -> str:
        return f"""
            SELECT {', '.join(_SOURCE5)}, count(install_time) AS {measure} FROM {table}
            WHERE install_time > DATE '2024-01-31' - INTERVAL {days} DAY GROUP BY ALL"""

    same = " AND ".join(f"i.{column} = e.{column}" for column in _SOURCE5)
    return with_tables(
        _comparable(
            f"""
            SELECT i.*, e.events FROM ({counted('apps_flyer_data', 'installs')}) i
            LEFT JOIN ({counted('apps_flyer_events', 'events')}) e ON {same}
            WHERE i.installs >= {least} AND e.events IS NULL""",
            **_SOURCE4,
            installs=_B,
            events=_B,
        ),
        "apps_flyer_data",
        "apps_flyer_events",
    )


def _aggregated_no_events(days: int, least: int) -> str:
    keys = "app_id, app_name, country_code, media_source, campaign"
    return with_tables(
        _comparable(
            f"""
            SELECT * FROM (
                SELECT {keys}, max(CASE WHEN kind = 'installs' THEN total END) AS installs,
                       max(CASE WHEN kind = 'events' THEN total END) AS events
                FROM (SELECT {keys}, CASE WHEN event_name = 'installs' THEN 'installs'
                                          ELSE 'events' END AS kind, sum(count) AS total
                      FROM bime_export_aggregated_events
                      WHERE event_name NOT IN
                              ('impressions', 'clicks', 'conversions', 'total_revenue')
                        AND media_source NOT IN ('googleadwords_int', 'Facebook Ads')
                        AND date >= DATE '2024-01-31' - INTERVAL {days} DAY
                      GROUP BY ALL)
                GROUP BY ALL)
            WHERE installs >= {least} AND events = 0
               OR installs >= {least} AND events IS NULL AND media_source <> 'Organic'""",
            app_id=_B,
            app_name=_V,
            country_code=_V,
            media_source=_V,
            campaign=_V,
            installs=_D,
            events=_D,
        ),
        "bime_export_aggregated_events",
    )


# ---------------------------------------------------------------- funnels

_MEDIA_SQL = """
    CASE WHEN contains(media_source, 'google') THEN 'googleadwords'
         WHEN contains(media_source, 'Organic') THEN 'organic'
         WHEN contains(media_source, 'twitter') THEN 'twitter'
         WHEN regexp_matches(campaign, 'Instagram|/.l[gG]') THEN 'instagram'
         WHEN contains(media_source, 'Face') THEN 'facebook' ELSE 'media buy' END
"""
_TYPE_SQL = """
    CASE WHEN campaign IN ('Burst', 'burst') THEN 'burst'
         WHEN regexp_matches(campaign, 'Re.|gagement|targeting') THEN 'retargeting'
         ELSE 'performance' END
"""
_NETWORK_TYPE_SQL = """
    CASE WHEN network_type = 'Incent' OR regexp_matches(network_publisher, '[bB]urst')
           OR regexp_matches(network_sub_publisher, '[bB]urst') THEN 'burst'
         WHEN regexp_matches(network_sub_publisher, 'Re.|gagement|targeting')
           THEN 'retargeting'
         ELSE 'performance' END
"""
_EVENT_COLUMNS = {
    "impressions": "impressions",
    "clicks": "clicks",
    "installs": "installs",
    "signup (Unique users)": "event_1",
    "category_choose (Event counter)": "event_2",
    "order_location (Event counter)": "event_3",
    "dummyevent1": "event_4",
    "dummyevent2": "event_5",
    "dummyevent3": "event_6",
    "conversions": "conversions",
    "total_revenue": "total_revenue",
}
# The network funnel is another client's.
_NETWORK_EVENT_COLUMNS = {
    "impressions": "impressions",
    "clicks": "clicks",
    "installs": "installs",
    "created account (Unique users)": "event_1",
    "14 day trial started (Unique users)": "event_2",
    "1 week pass started (Unique users)": "event_3",
    "subscription started (Unique users)": "event_4",
    "started workout (Event counter)": "event_5",
    "finished workout (Event counter)": "event_6",
    "conversions": "conversions",
    "total_revenue": "total_revenue",
}
_SPEND_TABLES = (
    "bime_export_installs", "apps_flyer_network_names", "apps_flyer_networks", "mark_ups",
)


_WIDE_SCOPE = {
    "apps": "1, 2, 3",
    "days": "93",
    "countries": "country_code LIKE 'REGION__'",
    "since": "2024-01-01",
}
# Each of these filters drops rows of the fixtures.
_NARROW_SCOPE = {
    "apps": "1, 2",
    "days": "20",
    "countries": "country_code IN ('REGION_0', 'REGION_2', 'REGION_3')",
    "since": "2024-01-16",
}


_NARROW_NETWORK_SCOPE = {**_NARROW_SCOPE, "apps": "2, 3"}


def _rollup_sql(by_network: bool, scope: dict[str, str] = _WIDE_SCOPE) -> str:
    columns = _NETWORK_EVENT_COLUMNS if by_network else _EVENT_COLUMNS
    names = ", ".join(f"'{name}'" for name in columns)
    return f"""
        SELECT date, app_id, app_name, {'media_source,' if by_network else ''} country_code,
               os, {_MEDIA_SQL} AS media, {_TYPE_SQL} AS campaign_type, event_name,
               sum(count) AS totals
        FROM bime_export_aggregated_events
        WHERE app_id IN ({scope['apps']})
          AND date >= DATE '2024-01-31' - INTERVAL {scope['days']} DAY
          AND event_name IN ({names}) AND {scope['countries']}
        GROUP BY ALL
    """


def _spend_sql(by_network: bool, user: int, scope: dict[str, str] = _WIDE_SCOPE) -> str:
    return f"""
        SELECT i.app_id, i.app_name, {'i.network_name,' if by_network else ''}
               i.country_code, i.install_date, i.os, {_NETWORK_TYPE_SQL} AS campaign_type,
               'media buy' AS media, sum(i.installs) AS installs,
               round(CAST(printf('%.14e', sum(i.spend * (1 + CAST(
                              CASE WHEN cm.markup_percent IS NOT NULL THEN cm.markup_percent
                                   ELSE dm.markup_percent END AS DOUBLE) / 100)))
                          AS DECIMAL(38, 12)), 2) AS spend
        FROM bime_export_installs i
        JOIN apps_flyer_network_names names ON names.name = i.network_name
        JOIN apps_flyer_networks n ON n.app_id = i.app_id AND n.country_id = i.country_id
                                  AND n.apps_flyer_network_name_id = names.id
        {_asof('cm', 'mark_ups', 'apps_flyer_network_id', 'n.id', 'i.install_date', user)}
        {_default_markup('dm', 'i.install_date', user)}
        WHERE i.install_date >= DATE '{scope['since']}' AND i.app_id IN ({scope['apps']})
        GROUP BY ALL
    """


def _funnel_sql(by_network: bool) -> str:
    network = "AND e.media_source = s.network_name" if by_network else ""
    return f"""
        SELECT e.* EXCLUDE (totals), sum(e.totals) AS totals, s.installs AS fin_installs,
               s.spend
        FROM rollup_rows e
        LEFT JOIN spend_rows s
          ON e.media = s.media AND e.country_code = s.country_code AND e.os = s.os
         AND e.app_id = s.app_id AND e.date = s.install_date
         AND e.campaign_type = s.campaign_type {network}
        GROUP BY ALL
    """


def _wide_sql(by_network: bool) -> str:
    columns = ", ".join(
        f"max(totals) FILTER (event_name = '{name}') AS {column}"
        for name, column in (
            _NETWORK_EVENT_COLUMNS if by_network else _EVENT_COLUMNS
        ).items()
    )
    return f"""
        SELECT * EXCLUDE (fin_installs) FROM (
            SELECT date, app_id, app_name,
                   {'media_source AS network_name,' if by_network else ''}
                   country_code, os, media, campaign_type, spend AS mrs_spend,
                   fin_installs, {columns}
            FROM long_rows GROUP BY ALL)
    """


def _funnel_stages(by_network: bool, scope: dict[str, str] = _WIDE_SCOPE) -> dict[str, str]:
    return {
        "rollup_rows": _rollup_sql(by_network, scope),
        "spend_rows": _spend_sql(by_network, 40 if by_network else 36, scope),
        "long_rows": _funnel_sql(by_network),
        "wide_rows": _wide_sql(by_network),
    }


_FUNNEL_KEYS = {
    "date": _DATE, "app_id": _B, "app_name": _V, "country_code": _V, "os": _V, "media": _V,
    "campaign_type": _V,
}
_SPEND_COLUMNS = {
    "app_id": _B, "app_name": _V, "country_code": _V, "install_date": _DATE, "os": _V,
    "campaign_type": _V, "media": _V, "installs": _B, "spend": _D,
}


def _rollup(by_network: bool) -> str:
    extra = {"media_source": _V} if by_network else {}
    return with_tables(
        _comparable(
            _rollup_sql(by_network), **_FUNNEL_KEYS, **extra, event_name=_V, totals=_D
        ),
        "bime_export_aggregated_events",
    )


def _spend(by_network: bool) -> str:
    extra = {"network_name": _V} if by_network else {}
    return with_tables(
        _comparable(
            _spend_sql(by_network, 40 if by_network else 36), **_SPEND_COLUMNS, **extra
        ),
        *_SPEND_TABLES,
    )


def _long(by_network: bool, scope: dict[str, str] = _WIDE_SCOPE) -> str:
    extra = {"media_source": _V} if by_network else {}
    return with_tables(
        _comparable(
            "SELECT * FROM long_rows",
            **_FUNNEL_KEYS,
            **extra,
            event_name=_V,
            totals=_D,
            fin_installs=_B,
            spend=_D,
        ),
        "bime_export_aggregated_events",
        *_SPEND_TABLES,
        **_funnel_stages(by_network, scope),
    )


def _wide(by_network: bool) -> str:
    extra = {"network_name": _V} if by_network else {}
    return with_tables(
        _comparable(
            "SELECT * FROM wide_rows",
            **_FUNNEL_KEYS,
            **extra,
            mrs_spend=_D,
            **dict.fromkeys(_EVENT_COLUMNS.values(), _D),
        ),
        "bime_export_aggregated_events",
        *_SPEND_TABLES,
        **_funnel_stages(by_network),
    )


_PAID_SQL = """
    SELECT gac_app_name_std AS app_name_std, gac_os AS os, gac_main_source AS media,
           gac_type AS campaign_type, gac_country AS country_code, date, costusd2 AS cost,
           impressions, clicks
    FROM google_campaign_performance WHERE gac_app_name_std = 'Standard App'
    UNION
    SELECT fb_app_name_std, os, main_source, campaign_type, fb_country_ext, date, spend,
           impressions, clicks
    FROM facebook_campaign_performance WHERE fb_app_name_std = 'Standard App'
"""
_FULL_SQL = """
    SELECT f.app_name_std, CAST(f.date AS VARCHAR) AS date, f.country_code, f.os, f.media,
           f.campaign_type, sum(f.mrs_spend) AS mrs_cost, sum(c.cost) AS gac_fb_cost,
           sum(f.impressions) AS mrs_impressions, sum(c.impressions) AS gac_fb_impressions,
           sum(f.clicks) AS mrs_clicks, sum(c.clicks) AS gac_fb_clicks,
           sum(f.installs) AS total_installs, sum(f.event_1) AS event_1,
           sum(f.event_2) AS event_2, sum(f.event_3) AS event_3, sum(f.event_4) AS event_4,
           sum(f.event_5) AS event_5, sum(f.event_6) AS event_6,
           sum(f.conversions) AS total_conversions, sum(f.total_revenue) AS total_revenue,
           if(f.media = 'media buy', CAST(sum(f.impressions) AS DOUBLE), sum(c.impressions))
               AS total_impressions,
           if(f.media = 'media buy', CAST(sum(f.clicks) AS DOUBLE), sum(c.clicks))
               AS total_clicks,
           if(f.media = 'media buy', CAST(sum(f.mrs_spend) AS DOUBLE), sum(c.cost))
               AS total_cost
    FROM (SELECT CASE WHEN app_id IN (1, 2) THEN 'Standard App' END AS app_name_std, *
          FROM wide_rows) f
    FULL JOIN paid_rows c
      ON f.date = c.date AND f.os = c.os AND f.app_name_std = c.app_name_std
     AND f.country_code = c.country_code AND f.media = c.media
     AND f.campaign_type = c.campaign_type
    GROUP BY f.app_name_std, f.date, f.country_code, f.os, f.media, f.campaign_type
"""


_KEYS = ("app_name_std", "date", "country_code", "os", "media", "campaign_type")
# Each side is summed before they meet, so that nothing is counted twice.
_FULL_ONCE_SQL = f"""
    WITH own AS (
        SELECT app_name_std, date, country_code, os, media, campaign_type,
               sum(mrs_spend) AS mrs_spend, sum(impressions) AS impressions,
               sum(clicks) AS clicks, sum(installs) AS installs, sum(event_1) AS event_1,
               sum(event_2) AS event_2, sum(event_3) AS event_3, sum(event_4) AS event_4,
               sum(event_5) AS event_5, sum(event_6) AS event_6,
               sum(conversions) AS conversions, sum(total_revenue) AS total_revenue
        FROM (SELECT CASE WHEN app_id IN (1, 2) THEN 'Standard App' END AS app_name_std, *
              FROM wide_rows)
        GROUP BY ALL),
    bought AS (
        SELECT app_name_std, date, country_code, os, media, campaign_type,
               sum(cost) AS cost, sum(impressions) AS impressions, sum(clicks) AS clicks
        FROM paid_rows GROUP BY ALL)
    SELECT f.app_name_std, CAST(f.date AS VARCHAR) AS date, f.country_code, f.os, f.media,
           f.campaign_type, sum(f.mrs_spend) AS mrs_cost, sum(c.cost) AS gac_fb_cost,
           sum(f.impressions) AS mrs_impressions, sum(c.impressions) AS gac_fb_impressions,
           sum(f.clicks) AS mrs_clicks, sum(c.clicks) AS gac_fb_clicks,
           sum(f.installs) AS total_installs,
           {", ".join(f"sum(f.event_{i}) AS event_{i}" for i in range(1, 7))},
           sum(f.conversions) AS total_conversions, sum(f.total_revenue) AS total_revenue,
           if(f.media = 'media buy', CAST(sum(f.impressions) AS DOUBLE), sum(c.impressions))
               AS total_impressions,
           if(f.media = 'media buy', CAST(sum(f.clicks) AS DOUBLE), sum(c.clicks))
               AS total_clicks,
           if(f.media = 'media buy', CAST(sum(f.mrs_spend) AS DOUBLE), sum(c.cost))
               AS total_cost
    FROM own f FULL JOIN bought c ON {" AND ".join(f"f.{k} = c.{k}" for k in _KEYS)}
    GROUP BY f.app_name_std, f.date, f.country_code, f.os, f.media, f.campaign_type
"""


def _full(sql: str) -> str:
    return with_tables(
        _comparable(
            sql,
            app_name_std=_V, date=_V, country_code=_V, os=_V, media=_V, campaign_type=_V,
            mrs_cost=_D, gac_fb_cost=_D, mrs_impressions=_D, gac_fb_impressions=_B,
            mrs_clicks=_D, gac_fb_clicks=_B, total_installs=_D, event_1=_D, event_2=_D,
            event_3=_D, event_4=_D, event_5=_D, event_6=_D, total_conversions=_D,
            total_revenue=_D, total_impressions=_D, total_clicks=_D, total_cost=_D,
        ),
        "bime_export_aggregated_events", *_SPEND_TABLES, "google_campaign_performance",
        "facebook_campaign_performance", **_funnel_stages(False), paid_rows=_PAID_SQL,
    )


_ORDERS = _comparable(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
              h.o_orderkey AS price_order, h.o_totalprice AS price
       FROM lineitem
       LEFT JOIN orders h
         ON h.o_custkey = l_partkey
        AND CAST(h.o_orderdate AS DATE) = (
            SELECT max(CAST(o.o_orderdate AS DATE)) FROM orders o
            WHERE o.o_custkey = l_partkey
              AND CAST(o.o_orderdate AS DATE) <= CAST(l_shipdate AS DATE))""",
    l_orderkey=_B, l_linenumber=_B, l_partkey=_B, l_shipdate=_DATE, price_order=_B,
    price=_D,
)


ORACLES: dict[str, str] = {
    "u01_daily_installs": with_tables(
        _comparable(_DAILY_SQL, **_DAILY, country_id=_B, installs=_B), *_DAILY_TABLES
    ),
    "u02_asof_keyed": with_tables(
        _comparable(
            f"""SELECT p.*, m.markup_percent FROM placed p
                {_asof('m', 'mark_ups', 'apps_flyer_network_id', 'p.network_id',
                       'p.install_date', 11)}""",
            **_DAILY, network_id=_B, installs=_B, markup_percent=_D,
        ),
        *_PLACED_TABLES, "mark_ups", **_PLACED_STAGES,
    ),
    "u02_asof_unkeyed": with_tables(
        _comparable(
            f"""SELECT u.*, dm.markup_percent FROM unconverting_sources u
                {_default_markup('dm', 'u.date', 11)}""",
            app_id=_B, country_id=_B, date=_DATE, spend=_D, markup_percent=_D,
        ),
        "unconverting_sources", "mark_ups",
    ),
    "u02_asof_orders": _ORDERS,
    "u02_asof_orders_bucketed": _ORDERS,
    "u03_cpi_override": with_tables(
        _comparable(f"SELECT *, {_CPI_SQL} AS cpi FROM enriched", **_DAILY, cpi=_D),
        *_HIERARCHY_TABLES, **_HIERARCHY_STAGES,
    ),
    "u04_markup_override": with_tables(
        _comparable(
            _MARKED_UP_SQL.format(facts="placed"), **_DAILY, network_id=_B, markup_percent=_D
        ),
        *_PLACED_TABLES, "mark_ups", **_PLACED_STAGES,
    ),
    "u05_source_enrichment": with_tables(
        _comparable(
            "SELECT * FROM enriched",
            **_DAILY, country_id=_B, installs=_B, app_name=_V, os=_V, network_id=_B,
            network_type=_B, network_cpi=_D, publisher_id=_B, publisher_cpi=_D,
            sub_publisher_id=_B, sub_publisher_cpi=_D,
        ),
        *_HIERARCHY_TABLES, **_HIERARCHY_STAGES,
    ),
    "u06_install_spend": with_tables(
        _comparable(
            f"SELECT *, coalesce(installs * ({_CPI_SQL}), 0) AS spend FROM enriched",
            **_DAILY, installs=_B, spend=_D,
        ),
        *_HIERARCHY_TABLES, **_HIERARCHY_STAGES,
    ),
    "u07_unconverting_rows": with_tables(
        _comparable(_UNCONVERTING_SQL, **_REPORT),
        "unconverting_sources", "apps", "countries", "mark_ups",
    ),
    "u08_finance_report": with_tables(
        _comparable(
            f"""
            {_UNCONVERTING_SQL}
            UNION
            SELECT app_id, campaign, network_name, network_publisher, network_sub_publisher,
                   country_code, country_id, install_date, source_provider_id, installs,
                   app_name, os, network_type, {_CPI_SQL} AS cpi,
                   coalesce(installs * ({_CPI_SQL}), 0) AS spend, markup_percent
            FROM marked_up""",
            **_REPORT,
        ),
        *_HIERARCHY_TABLES, "unconverting_sources", "mark_ups",
        **_HIERARCHY_STAGES, marked_up=_MARKED_UP_SQL.format(facts="enriched"),
    ),
    "u09_install_cohorts": _cohorts(7),
    "u09_install_cohorts_month": _cohorts(31),
    "u10_cohort_pivot": _pivot(7),
    "u10_cohort_pivot_month": _pivot(31),
    "u11_fast_install_share": _fast_share(7),
    "u11_fast_install_share_month": _fast_share(31),
    "u12_click_to_install": _distribution(7),
    "u12_click_to_install_month": _distribution(36),
    "u13_duplicate_ip": _duplicate_ips(2, 3),
    "u13_duplicate_ip_month": _duplicate_ips(31, 20),
    "u14_installs_without_events": _without_events(7, 3),
    "u14_installs_without_events_month": _without_events(31, 10),
    "u15_aggregated_no_events": _aggregated_no_events(5, 1),
    "u15_aggregated_no_events_month": _aggregated_no_events(31, 2),
    "u16_media_label": with_tables(
        _comparable(
            f"""SELECT media_source, campaign, {_MEDIA_SQL} AS media, count(*) AS rows
                FROM ev GROUP BY ALL""",
            media_source=_V, campaign=_V, media=_V, rows=_B,
        ),
        "ev",
    ),
    "u17_campaign_type": with_tables(
        _comparable(
            f"""SELECT campaign, {_TYPE_SQL} AS campaign_type, count(*) AS rows
                FROM ev GROUP BY ALL""",
            campaign=_V, campaign_type=_V, rows=_B,
        ),
        "ev",
    ),
    "u18_network_campaign_type": with_tables(
        _comparable(
            f"""SELECT network_type, network_publisher, network_sub_publisher,
                       {_NETWORK_TYPE_SQL} AS campaign_type, count(*) AS rows
                FROM bime_export_installs GROUP BY ALL""",
            network_type=_V, network_publisher=_V, network_sub_publisher=_V,
            campaign_type=_V, rows=_B,
        ),
        "bime_export_installs",
    ),
    "u19_event_rollup": _rollup(False),
    "u19_event_rollup_by_network": _rollup(True),
    "u20_markup_spend": _spend(False),
    "u20_markup_spend_by_network": _spend(True),
    "u21_funnel": _long(False),
    "u21_funnel_narrowed": _long(False, _NARROW_SCOPE),
    "u22_funnel_by_network_narrowed": _long(True, _NARROW_NETWORK_SCOPE),
    "u22_funnel_by_network": _long(True),
    "u23_funnel_wide": _wide(False),
    "u24_funnel_wide_by_network": _wide(True),
    "u25_paid_media": with_tables(
        _comparable(
            _PAID_SQL,
            app_name_std=_V, os=_V, media=_V, campaign_type=_V, country_code=_V, date=_DATE,
            cost=_D, impressions=_B, clicks=_B,
        ),
        "google_campaign_performance", "facebook_campaign_performance",
    ),
    "u26_funnel_full": _full(_FULL_SQL),
    "u26_funnel_full_pre_aggregated": _full(_FULL_ONCE_SQL),
}
