"""Schemas of the input tables, as Spark DDL.

Reading with a declared schema needs no inference pass and lets the scan prune columns.
"""

from __future__ import annotations

# Names and columns of the input tables.
SCHEMAS: dict[str, str] = {
    # facts
    "apps_flyer_data": (
        "app_id bigint, campaign string, network_name string, network_publisher string, "
        "network_sub_publisher string, country_code string, install_time timestamp_ntz, "
        "source_provider_id int, ip string, raw_data string"
    ),
    "apps_flyer_events": (
        "app_id bigint, country_code string, network_name string, network_publisher string, "
        "network_sub_publisher string, install_time timestamp_ntz"
    ),
    "bime_export_aggregated_events": (
        "date date, app_id bigint, app_name string, country_code string, os string, "
        "media_source string, campaign string, event_name string, count decimal(18,2)"
    ),
    "bime_export_installs": (
        "id bigint, app_id bigint, network_name string, network_publisher string, "
        "network_sub_publisher string, country_code string, country_id bigint, "
        "install_date date, installs bigint, app_name string, os string, "
        "network_type string, cpi double, spend double, created_at timestamp_ntz, "
        "updated_at timestamp_ntz"
    ),
    "unconverting_sources": "app_id bigint, country_id bigint, date date, spend double",
    "google_campaign_performance": (
        "gac_app_name_std string, gac_os string, gac_main_source string, gac_type string, "
        "gac_country string, date date, costusd2 double, impressions bigint, clicks bigint"
    ),
    "facebook_campaign_performance": (
        "fb_app_name_std string, os string, main_source string, campaign_type string, "
        "fb_country_ext string, date date, spend double, impressions bigint, clicks bigint"
    ),
    # dimensions
    "apps": "id bigint, name string, os string",
    "countries": "id bigint, code string",
    "apps_flyer_network_names": "id bigint, name string",
    "apps_flyer_networks": (
        "id bigint, app_id bigint, apps_flyer_network_name_id bigint, country_id bigint"
    ),
    "apps_flyer_network_publishers": "id bigint, apps_flyer_network_id bigint, name string",
    "apps_flyer_network_sub_publishers": (
        "id bigint, apps_flyer_network_publisher_id bigint, name string"
    ),
    # effective-dated attributes
    "apps_flyer_network_attributes": (
        "apps_flyer_network_id bigint, effective_date date, cpi double, network_type int"
    ),
    "apps_flyer_network_publisher_attributes": (
        "apps_flyer_network_publisher_id bigint, effective_date date, publisher_cpi double"
    ),
    "apps_flyer_network_sub_publisher_attributes": (
        "apps_flyer_network_sub_publisher_id bigint, effective_date date, "
        "sub_publisher_cpi double"
    ),
    "mark_ups": (
        "apps_flyer_network_id bigint, user_id bigint, effective_date date, "
        "markup_percent decimal(9,4)"
    ),
}
