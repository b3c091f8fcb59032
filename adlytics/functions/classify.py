"""Text classifiers for traffic sources and campaigns.

Each is one flat ``CASE`` evaluated inside whole-stage codegen; the first rule that
matches wins. The patterns are SQL ``LIKE`` patterns, so ``_`` stands for any single
character and matching is case-sensitive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and patterns the reports are defined by.
MEDIA_BUY = "media buy"
GOOGLE_SOURCES = ("%google%",)
ORGANIC_SOURCES = ("%Organic%",)
TWITTER_SOURCES = ("%twitter%",)
INSTAGRAM_CAMPAIGNS = ("%Instagram%", "%/_lg%", "%/_lG%")
FACEBOOK_SOURCES = ("%Face%",)
RETARGETING_NAMES = ("%Re-%", "%Re_%", "%gagement%", "%targeting%")
BURST_CAMPAIGNS = ("Burst", "burst")
BURST_NAMES = ("%burst%", "%Burst%")
INCENT_NETWORK = "Incent"

MEDIA_LABELS = ("googleadwords", "organic", "twitter", "instagram", "facebook", MEDIA_BUY)
CAMPAIGN_TYPES = ("burst", "retargeting", "performance")


def like_any(text: Column, patterns: tuple[str, ...]) -> Column:
    """True when ``text`` matches at least one LIKE pattern; NULL text never matches."""
    return reduce(lambda left, right: left | right, (text.like(p) for p in patterns))


def media_label(media_source: Column, campaign: Column) -> Column:
    """Medium an event belongs to; anything unknown, NULL included, is bought media."""
    return (
        F.when(like_any(media_source, GOOGLE_SOURCES), "googleadwords")
        .when(like_any(media_source, ORGANIC_SOURCES), "organic")
        .when(like_any(media_source, TWITTER_SOURCES), "twitter")
        .when(like_any(campaign, INSTAGRAM_CAMPAIGNS), "instagram")
        .when(like_any(media_source, FACEBOOK_SOURCES), "facebook")
        .otherwise(MEDIA_BUY)
    )


def campaign_type(campaign: Column) -> Column:
    """Campaign type on the event side, read off the campaign name."""
    return (
        F.when(campaign.isin(*BURST_CAMPAIGNS), "burst")
        .when(like_any(campaign, RETARGETING_NAMES), "retargeting")
        .otherwise("performance")
    )


def network_campaign_type(
    network_type: Column, publisher: Column, sub_publisher: Column
) -> Column:
    """Campaign type on the finance side, where only the source is known."""
    burst = (
        (network_type == INCENT_NETWORK)
        | like_any(publisher, BURST_NAMES)
        | like_any(sub_publisher, BURST_NAMES)
    )
    return (
        F.when(burst, "burst")
        .when(like_any(sub_publisher, RETARGETING_NAMES), "retargeting")
        .otherwise("performance")
    )
