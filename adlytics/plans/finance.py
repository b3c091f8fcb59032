"""Daily finance report: installs, effective cost per install, spend and mark-up.

``tables`` arguments are mappings from table name (see ``adlytics.sources.schemas``) to
DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlytics.functions import period, prices
from adlytics.operators.asof import asof_join, asof_join_unkeyed

Tables = Mapping[str, DataFrame]

REPORT_COLUMNS = (
    "app_id",
    "campaign",
    "network_name",
    "network_publisher",
    "network_sub_publisher",
    "country_code",
    "country_id",
    "install_date",
    "source_provider_id",
    "installs",
    "app_name",
    "os",
    "network_type",
    "cpi",
    "spend",
    "markup_percent",
)

# Labels of spend that brought no installs.
UNCONVERTING = "unconverting_source"
UNCONVERTING_PROVIDER = 4
UNCONVERTING_NETWORK_TYPE = 2

_DAILY_KEYS = (
    "app_id",
    "campaign",
    "network_name",
    "network_publisher",
    "network_sub_publisher",
    "country_code",
    "install_date",
    "source_provider_id",
)


def daily_installs(
    installs: DataFrame, names: DataFrame, countries: DataFrame, start: date, end: date
) -> DataFrame:
    """Installs per day and source, for known networks and countries only.

    The installs are counted before the two dimensions are joined, so the joins see daily
    totals. Joining after counting must not change the count: a network name or country
    listed more than once multiplies it, hence the ``copies`` factors.
    """
    counted = (
        period.between_days(installs, "install_time", start, end)
        .withColumn("install_date", F.to_date("install_time"))
        .groupBy(*_DAILY_KEYS)
        .agg(F.count("install_time").alias("__rows"))
    )
    known_names = names.groupBy(F.col("name").alias("__name")).agg(
        F.count(F.lit(1)).alias("__name_copies")
    )
    known_countries = countries.groupBy(
        F.col("code").alias("__code"), F.col("id").alias("country_id")
    ).agg(F.count(F.lit(1)).alias("__country_copies"))
    return (
        counted.join(known_names, F.col("network_name") == F.col("__name"), "inner")
        .join(known_countries, F.col("country_code") == F.col("__code"), "inner")
        .select(
            "app_id",
            "campaign",
            "network_name",
            "network_publisher",
            "network_sub_publisher",
            "country_code",
            "country_id",
            "install_date",
            "source_provider_id",
            (F.col("__rows") * F.col("__name_copies") * F.col("__country_copies")).alias(
                "installs"
            ),
        )
    )


def network_ids(
    facts: DataFrame, names: DataFrame, networks: DataFrame, apps: DataFrame | None = None
) -> DataFrame:
    """Adds ``network_id``, the network of the fact's app, network name and country.

    With ``apps`` it adds the app's columns, too. The dimensions are joined to each other
    first, so that the facts are joined once.
    """
    known = names.select(F.col("id").alias("__name_id"), F.col("name").alias("__name")).join(
        networks.select(
            F.col("id").alias("network_id"),
            F.col("app_id").alias("__app"),
            F.col("apps_flyer_network_name_id").alias("__network_name_id"),
            F.col("country_id").alias("__country"),
        ),
        F.col("__name_id") == F.col("__network_name_id"),
        "inner",
    )
    if apps is not None:
        known = known.join(apps, F.col("__app") == F.col("__app_id"), "inner").drop("__app_id")
    return facts.join(
        known,
        (F.col("app_id") == F.col("__app"))
        & (F.col("network_name") == F.col("__name"))
        & (F.col("country_id") == F.col("__country")),
        "inner",
    ).drop("__name", "__name_id", "__app", "__network_name_id", "__country")


def enrich_sources(
    daily: DataFrame, tables: Tables, since: date | None = None, until: date | None = None
) -> DataFrame:
    """Adds app, network and the attributes of all three levels of the source hierarchy.

    Publishers are found by network and name, sub-publishers by publisher and name; both
    may be missing. Attributes are those in force on the install date.
    """
    apps = tables["apps"].select(
        F.col("id").alias("__app_id"), F.col("name").alias("app_name"), "os"
    )
    publishers = tables["apps_flyer_network_publishers"].select(
        F.col("id").alias("publisher_id"),
        F.col("apps_flyer_network_id").alias("__network"),
        F.col("name").alias("__publisher"),
    )
    sub_publishers = tables["apps_flyer_network_sub_publishers"].select(
        F.col("id").alias("sub_publisher_id"),
        F.col("apps_flyer_network_publisher_id").alias("__parent"),
        F.col("name").alias("__sub_publisher"),
    )
    placed = network_ids(
        daily, tables["apps_flyer_network_names"], tables["apps_flyer_networks"], apps
    )
    with_network = asof_join(
        placed,
        tables["apps_flyer_network_attributes"],
        {"network_id": "apps_flyer_network_id"},
        "install_date",
        "effective_date",
        {"network_type": "network_type", "network_cpi": "cpi"},
        since,
        until,
    )
    with_publisher = asof_join(
        with_network.join(
            publishers,
            (F.col("network_id") == F.col("__network"))
            & (F.col("network_publisher") == F.col("__publisher")),
            "left",
        ).drop("__network", "__publisher"),
        tables["apps_flyer_network_publisher_attributes"],
        {"publisher_id": "apps_flyer_network_publisher_id"},
        "install_date",
        "effective_date",
        {"publisher_cpi": "publisher_cpi"},
        since,
        until,
    )
    return asof_join(
        with_publisher.join(
            sub_publishers,
            (F.col("publisher_id") == F.col("__parent"))
            & (F.col("network_sub_publisher") == F.col("__sub_publisher")),
            "left",
        ).drop("__parent", "__sub_publisher"),
        tables["apps_flyer_network_sub_publisher_attributes"],
        {"sub_publisher_id": "apps_flyer_network_sub_publisher_id"},
        "install_date",
        "effective_date",
        {"sub_publisher_cpi": "sub_publisher_cpi"},
        since,
        until,
    )


def with_markup(
    facts: DataFrame,
    mark_ups: DataFrame,
    user_id: int,
    fact_date: str,
    since: date | None = None,
    until: date | Column | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Adds ``markup_percent`` in force on the fact's date for its ``network_id``.

    A mark-up of the network itself wins over the user's default (rows with no network).
    Every pair of tied rows of both gives a row. A caller that drops duplicate rows anyway
    says ``distinct``: equal rows of the history then count once, and the default is only
    looked up where the network has no mark-up.
    """
    own = mark_ups.where(F.col("user_id") == user_id).where(
        F.col("apps_flyer_network_id").isNotNull()
    )
    columns = ("apps_flyer_network_id", "effective_date", "markup_percent")
    custom = asof_join(
        facts,
        own.select(*columns).distinct() if distinct else own,
        {"network_id": "apps_flyer_network_id"},
        fact_date,
        "effective_date",
        {"__custom": "markup_percent"},
        since,
        until,
    )
    asked = F.col(fact_date)
    if distinct:
        asked = F.when(F.col("__custom").isNull(), asked)
    both = with_default_markup(
        custom.withColumn("__asked", asked),
        mark_ups,
        user_id,
        "__asked",
        "__default",
        since,
        until,
        distinct,
    )
    markup = prices.effective_markup(F.col("__custom"), F.col("__default"))
    return both.withColumn("markup_percent", markup).drop("__custom", "__default", "__asked")


def with_default_markup(
    facts: DataFrame,
    mark_ups: DataFrame,
    user_id: int,
    fact_date: str,
    output: str,
    since: date | None = None,
    until: date | Column | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Adds the user's default mark-up in force on the fact's date."""
    default = mark_ups.where(
        (F.col("user_id") == user_id) & F.col("apps_flyer_network_id").isNull()
    ).select("effective_date", "markup_percent")
    return asof_join_unkeyed(
        facts,
        default.distinct() if distinct else default,
        fact_date,
        "effective_date",
        {output: "markup_percent"},
        since,
        until,
    )


def unconverting_rows(
    tables: Tables, start: date, end: date, user_id: int, distinct: bool = False
) -> DataFrame:
    """Spend that brought no installs, in report columns with constant labels."""
    apps = tables["apps"].select(
        F.col("id").alias("__app_id"), F.col("name").alias("app_name"), "os"
    )
    countries = tables["countries"].select(
        F.col("id").alias("__country"), F.col("code").alias("country_code")
    )
    spend = (
        period.between_dates(tables["unconverting_sources"], "date", start, end)
        .join(apps, F.col("app_id") == F.col("__app_id"), "inner")
        .join(countries, F.col("country_id") == F.col("__country"), "inner")
    )
    priced = with_default_markup(
        spend, tables["mark_ups"], user_id, "date", "markup_percent", start, end, distinct
    )
    label = F.lit(UNCONVERTING)
    return priced.select(
        "app_id",
        label.alias("campaign"),
        label.alias("network_name"),
        label.alias("network_publisher"),
        label.alias("network_sub_publisher"),
        "country_code",
        "country_id",
        F.col("date").alias("install_date"),
        F.lit(UNCONVERTING_PROVIDER).alias("source_provider_id"),
        F.lit(None).cast("long").alias("installs"),
        "app_name",
        "os",
        F.lit(UNCONVERTING_NETWORK_TYPE).alias("network_type"),
        F.lit(None).cast("double").alias("cpi"),
        F.col("spend").cast("double").alias("spend"),
        "markup_percent",
    )


def converting_rows(
    tables: Tables, start: date, end: date, user_id: int, distinct: bool = False
) -> DataFrame:
    """Daily installs with price and mark-up, in report columns."""
    daily = daily_installs(
        tables["apps_flyer_data"],
        tables["apps_flyer_network_names"],
        tables["countries"],
        start,
        end,
    )
    enriched = enrich_sources(daily, tables, start, end)
    priced = with_markup(
        enriched, tables["mark_ups"], user_id, "install_date", start, end, distinct
    )
    cpi = prices.effective_cpi(
        F.col("sub_publisher_cpi"), F.col("publisher_cpi"), F.col("network_cpi")
    )
    return (
        priced.withColumn("cpi", cpi)
        .withColumn("spend", prices.install_spend(F.col("installs"), F.col("cpi")))
        .select(*REPORT_COLUMNS)
    )


def finance_report(tables: Tables, start: date, end: date, user_id: int = 11) -> DataFrame:
    """Both kinds of rows without duplicates, newest first.

    Only the date order is promised. The further sort columns let the range partitioning
    of the sort cut within a day; a report has few dates and would else use few tasks.
    """
    rows = unconverting_rows(tables, start, end, user_id, distinct=True).union(
        converting_rows(tables, start, end, user_id, distinct=True)
    )
    return rows.distinct().orderBy(
        F.desc_nulls_first("install_date"), "app_id", "network_name", "country_code", "campaign"
    )
