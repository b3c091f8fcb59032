"""Marketing funnels: events by medium and campaign type against marked-up spend."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlytics.functions import classify, period, prices
from adlytics.operators.pivot import conditional_max
from adlytics.plans.finance import Tables, network_ids, with_markup
from adlytics.plans.spec import FunnelSpec

PAID_MEDIA_KEYS = ("date", "os", "app_name_std", "country_code", "media", "campaign_type")


def event_rollup(daily_events: DataFrame, spec: FunnelSpec) -> DataFrame:
    """Event totals per day, app, country, system, medium and campaign type."""
    network = ["media_source"] if spec.by_network else []
    first_day = period.days_before(spec.as_of, spec.lookback_days)
    return (
        period.since_day(daily_events, "date", first_day)
        .where(
            F.col("app_id").isin(*spec.app_ids)
            & F.col("event_name").isin(*spec.event_columns)
            & F.col("country_code").isin(*spec.country_codes)
        )
        .withColumn("media", classify.media_label(F.col("media_source"), F.col("campaign")))
        .withColumn("campaign_type", classify.campaign_type(F.col("campaign")))
        .groupBy(
            "date",
            "app_id",
            "app_name",
            *network,
            "country_code",
            "os",
            "media",
            "campaign_type",
            "event_name",
        )
        .agg(F.sum("count").alias("totals"))
    )


def markup_spend(tables: Tables, spec: FunnelSpec) -> DataFrame:
    """Installs and marked-up spend of bought media per day and campaign type.

    The mark-up depends on network and day only, so the export is summed up to that grain
    first and every later join works on the sums. Spend without any mark-up is lost, its
    installs still count.
    """
    network = ["network_name"] if spec.by_network else []
    grain = ("app_id", "app_name", "country_code", "install_date", "os", "campaign_type")
    label = classify.network_campaign_type(
        F.col("network_type"), F.col("network_publisher"), F.col("network_sub_publisher")
    )
    bought = period.since_day(
        tables["bime_export_installs"], "install_date", spec.installs_since
    ).where(F.col("app_id").isin(*spec.app_ids))
    last_day = bought.agg(F.max("install_date")).scalar()
    sums = (
        bought.withColumn("campaign_type", label)
        .groupBy(*grain, "network_name", "country_id")
        .agg(F.sum("installs").alias("__installs"), F.sum("spend").alias("__spend"))
    )
    placed = network_ids(
        sums, tables["apps_flyer_network_names"], tables["apps_flyer_networks"]
    )
    priced = with_markup(
        placed,
        tables["mark_ups"],
        spec.markup_user_id,
        "install_date",
        spec.installs_since,
        last_day,
    )
    marked_up = prices.marked_up(F.col("__spend"), F.col("markup_percent"))
    return (
        priced.groupBy(*grain, *network)
        .agg(
            F.sum("__installs").alias("installs"),
            prices.money(F.sum(marked_up)).alias("spend"),
        )
        .withColumn("media", F.lit(classify.MEDIA_BUY))
    )


def funnel_rows(events: DataFrame, spend: DataFrame, by_network: bool = False) -> DataFrame:
    """Event roll-up beside the spend of the same day, app, country and campaign type.

    The spend repeats on every event row of its key. The app name is not part of the join
    but of the spend's grain, so two spend rows can meet one event row; those with equal
    installs and spend are added up again.
    """
    network = ["media_source"] if by_network else []
    right = spend.select(
        F.col("media").alias("__media"),
        F.col("country_code").alias("__country"),
        F.col("os").alias("__os"),
        F.col("app_id").alias("__app"),
        F.col("install_date").alias("__date"),
        F.col("campaign_type").alias("__type"),
        F.col("installs").alias("fin_installs"),
        "spend",
        *([F.col("network_name").alias("__network")] if by_network else []),
    )
    matches: list[Column] = [
        F.col("media") == F.col("__media"),
        F.col("country_code") == F.col("__country"),
        F.col("os") == F.col("__os"),
        F.col("app_id") == F.col("__app"),
        F.col("date") == F.col("__date"),
        F.col("campaign_type") == F.col("__type"),
    ]
    if by_network:
        matches.append(F.col("media_source") == F.col("__network"))
    keys = [
        "date",
        "app_id",
        "app_name",
        *network,
        "country_code",
        "os",
        "media",
        "campaign_type",
        "event_name",
    ]
    return (
        events.join(right, matches, "left")
        .groupBy(*keys, "fin_installs", "spend")
        .agg(F.sum("totals").alias("totals"))
        .select(*keys, "totals", "fin_installs", "spend")
    )


def funnel(tables: Tables, spec: FunnelSpec) -> DataFrame:
    """Funnel in long form, one row per event name; unordered, to build on."""
    return funnel_rows(
        event_rollup(tables["bime_export_aggregated_events"], spec),
        markup_spend(tables, spec),
        spec.by_network,
    )


def funnel_report(tables: Tables, spec: FunnelSpec) -> DataFrame:
    """Funnel in long form, in report order."""
    network = ["media_source"] if spec.by_network else []
    order = (
        "date",
        "app_id",
        "app_name",
        *network,
        "country_code",
        "os",
        "event_name",
        "media",
        "campaign_type",
    )
    return funnel(tables, spec).orderBy(*(F.asc_nulls_last(c) for c in order))


def funnel_wide(
    long: DataFrame, event_columns: Mapping[str, str], by_network: bool = False
) -> DataFrame:
    """Event names as columns. Grouping by the spend folds its repetition.

    The finance installs are a grouping key without being shown, so keys can repeat.
    """
    network = ["network_name"] if by_network else []
    named = long.withColumnRenamed("media_source", "network_name") if by_network else long
    keys = (
        "date",
        "app_id",
        "app_name",
        *network,
        "country_code",
        "os",
        "media",
        "campaign_type",
    )
    return (
        named.withColumnRenamed("spend", "mrs_spend")
        .groupBy(*keys, "fin_installs", "mrs_spend")
        .agg(*conditional_max(F.col("event_name"), event_columns, F.col("totals")))
        .select(*keys, "mrs_spend", *event_columns.values())
    )


def funnel_wide_report(tables: Tables, spec: FunnelSpec) -> DataFrame:
    """Funnel in wide form, in report order."""
    wide = funnel_wide(funnel(tables, spec), spec.event_columns, spec.by_network)
    network = ["network_name"] if spec.by_network else []
    order = (
        "date", "app_id", *network, "country_code", "os", "media", "campaign_type", "mrs_spend"
    )
    return wide.orderBy(*(F.asc_nulls_last(c) for c in order))


def paid_media(google: DataFrame, facebook: DataFrame, app_name: str) -> DataFrame:
    """Cost rows of both ad networks for one app, without duplicates."""
    measures = ("impressions", "clicks")
    from_google = google.where(F.col("gac_app_name_std") == app_name).select(
        F.col("gac_app_name_std").alias("app_name_std"),
        F.col("gac_os").alias("os"),
        F.col("gac_main_source").alias("media"),
        F.col("gac_type").alias("campaign_type"),
        F.col("gac_country").alias("country_code"),
        "date",
        F.col("costusd2").alias("cost"),
        *measures,
    )
    from_facebook = facebook.where(F.col("fb_app_name_std") == app_name).select(
        F.col("fb_app_name_std").alias("app_name_std"),
        "os",
        F.col("main_source").alias("media"),
        "campaign_type",
        F.col("fb_country_ext").alias("country_code"),
        "date",
        F.col("spend").alias("cost"),
        *measures,
    )
    return from_google.union(from_facebook).distinct()


def funnel_full(
    wide: DataFrame,
    cost: DataFrame,
    app_ids: Sequence[int],
    app_name: str,
    pre_aggregate: bool = False,
) -> DataFrame:
    """Wide funnel full-joined to ad-network cost, with blended totals; unordered.

    The join keys are no key of either side, and every sum is over all pairs of rows that
    meet. The pairs are never formed: each side is summed per key with its row count, and
    a side's sum over the pairs is its own sum times the rows of the other side. The join
    then meets at most one row per key on each side, however many rows a key has.

    The published report adds a row's spend once per row it meets on the other side. With
    ``pre_aggregate`` each side counts once, whatever it meets; the two differ where a key
    has several rows on a side that meets the other.

    Cost without a funnel row ends up in one all-NULL row, as the result is grouped by the
    funnel's columns only.
    """
    left_sums = {
        "mrs_cost": "mrs_spend",
        "mrs_impressions": "impressions",
        "mrs_clicks": "clicks",
        "total_installs": "installs",
        **{f"event_{i}": f"event_{i}" for i in range(1, 7)},
        "total_conversions": "conversions",
        "total_revenue": "total_revenue",
    }
    right_sums = {
        "gac_fb_cost": "cost",
        "gac_fb_impressions": "impressions",
        "gac_fb_clicks": "clicks",
    }
    left_rows, right_rows = F.col("__left_rows"), F.col("__right_rows")

    def times(measure: str, met: Column) -> Column:
        once = F.col(measure)
        return once if pre_aggregate else (once * F.coalesce(met, F.lit(1))).alias(measure)

    standard_name = F.when(F.col("app_id").isin(*app_ids), F.lit(app_name))
    left = (
        wide.withColumn("app_name_std", standard_name)
        .groupBy(*PAID_MEDIA_KEYS)
        .agg(
            *(F.sum(column).alias(name) for name, column in left_sums.items()),
            F.count(F.lit(1)).alias("__left_rows"),
        )
    )
    right = cost.groupBy(*(F.col(k).alias(f"__{k}") for k in PAID_MEDIA_KEYS)).agg(
        *(F.sum(column).alias(name) for name, column in right_sums.items()),
        F.count(F.lit(1)).alias("__right_rows"),
    )
    matches = [F.col(k) == F.col(f"__{k}") for k in PAID_MEDIA_KEYS]
    paired = left.join(right, matches, "full").select(
        *PAID_MEDIA_KEYS,
        *(times(n, right_rows) for n in left_sums),
        *(times(n, left_rows) for n in right_sums),
    )
    totals = paired.groupBy(*PAID_MEDIA_KEYS).agg(
        *(F.sum(name).alias(name) for name in (*left_sums, *right_sums))
    )
    bought = F.col("media") == classify.MEDIA_BUY

    def blended(own: str, external: str) -> Column:
        return F.when(bought, F.col(own)).otherwise(F.col(external))

    return totals.select(
        "app_name_std",
        F.col("date").cast("string").alias("date"),
        "country_code",
        "os",
        "media",
        "campaign_type",
        "mrs_cost",
        "gac_fb_cost",
        "mrs_impressions",
        "gac_fb_impressions",
        "mrs_clicks",
        "gac_fb_clicks",
        "total_installs",
        *(f"event_{i}" for i in range(1, 7)),
        "total_conversions",
        "total_revenue",
        blended("mrs_impressions", "gac_fb_impressions").alias("total_impressions"),
        blended("mrs_clicks", "gac_fb_clicks").alias("total_clicks"),
        F.when(bought, F.col("mrs_cost").cast("double"))
        .otherwise(F.col("gac_fb_cost"))
        .alias("total_cost"),
    )


def funnel_full_report(
    tables: Tables, spec: FunnelSpec, app_name: str, pre_aggregate: bool = False
) -> DataFrame:
    """Wide funnel against ad-network cost, by date.

    Only the date order is promised; the further columns spread the sort within a date.
    """
    wide = funnel_wide(funnel(tables, spec), spec.event_columns, by_network=False)
    cost = paid_media(
        tables["google_campaign_performance"],
        tables["facebook_campaign_performance"],
        app_name,
    )
    order = ("date", "app_name_std", "country_code", "os", "media", "campaign_type")
    return funnel_full(wide, cost, spec.app_ids, app_name, pre_aggregate).orderBy(
        *(F.asc_nulls_last(c) for c in order)
    )
