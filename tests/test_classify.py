from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from adlytics.functions import classify

MEDIA = [
    ("googleadwords_int", "x", "googleadwords"),
    ("google", "Instagram", "googleadwords"),
    ("Google", "x", "media buy"),
    ("Organic", "Instagram", "organic"),
    ("twitter", "Instagram", "twitter"),
    ("Facebook Ads", "Instagram_1", "instagram"),
    ("Facebook Ads", "camp/alg_1", "instagram"),
    ("Facebook Ads", "camp/alG_1", "instagram"),
    ("Facebook Ads", "camp/lg", "facebook"),
    ("Facebook Ads", "_lg", "facebook"),
    ("Facebook Ads", "x", "facebook"),
    ("facebook", "x", "media buy"),
    ("net_a", "x/_lg", "instagram"),
    (None, "x", "media buy"),
    (None, "Instagram", "instagram"),
    ("net_a", None, "media buy"),
    (None, None, "media buy"),
]
CAMPAIGN = [
    ("Burst", "burst"),
    ("burst", "burst"),
    ("Burst 2", "performance"),
    ("BURST", "performance"),
    ("Re-engage", "retargeting"),
    ("Re_x", "retargeting"),
    ("Reach", "retargeting"),
    ("Re", "performance"),
    ("re-engage", "performance"),
    ("x_engagement", "retargeting"),
    ("retargeting", "retargeting"),
    ("perf", "performance"),
    (None, "performance"),
]
NETWORK = [
    ("Incent", "p", "s", "burst"),
    ("Non", "a_burst", "s", "burst"),
    ("Non", "Burst_a", "s", "burst"),
    ("Non", "p", "a_burst", "burst"),
    ("Non", "p", "Burst Re-", "burst"),
    ("Non", "p", "Re-x", "retargeting"),
    ("Non", "Re-x", "s", "performance"),
    ("Non", "p", "Rest", "retargeting"),
    ("Non", "p", "engagement", "retargeting"),
    ("Non", "p", "targeting", "retargeting"),
    (None, None, None, "performance"),
    (None, None, "Re-x", "retargeting"),
    (None, "burst", None, "burst"),
    ("Incent", None, None, "burst"),
]


@pytest.mark.parametrize(
    "table, build",
    [
        (MEDIA, classify.media_label),
        (CAMPAIGN, classify.campaign_type),
        (NETWORK, classify.network_campaign_type),
    ],
)
def test_truth_table(spark, table, build):
    inputs = [f"c{i}" for i in range(len(table[0]) - 1)]
    schema = ", ".join(f"{c} string" for c in [*inputs, "expected"])
    df = spark.createDataFrame(table, schema).withColumn(
        "label", build(*(F.col(c) for c in inputs))
    )
    assert rows(df.where(~F.col("label").eqNullSafe(F.col("expected")))) == []


def test_labels_are_the_declared_ones():
    assert {row[-1] for row in MEDIA} == set(classify.MEDIA_LABELS)
    assert {row[-1] for row in CAMPAIGN} == set(classify.CAMPAIGN_TYPES)
