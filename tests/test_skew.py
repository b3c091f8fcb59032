"""Hot keys: results stay whole, and no single task is left with the hot group."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adlytics.operators import asof_join
from adlytics.plans import fraud
from adlytics.sources import SCHEMAS

AS_OF = date(2024, 1, 31)


@pytest.fixture
def small_skew_thresholds(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.mark.parametrize("hot", [7, None])
def test_hot_key_of_an_asof_join_is_split(spark, sort_merge, small_skew_thresholds, hot):
    key = F.when(F.col("id") % 3 != 0, F.col("id") % 1000).otherwise(F.lit(hot).cast("bigint"))
    facts = spark.range(0, 300_000, 1, 8).select(
        "id",
        key.alias("network_id"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 31).cast("int")).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    history = spark.range(1000).select(
        F.col("id").alias("owner"), F.lit(date(2024, 1, 10)).alias("eff"), "id"
    )
    joined = asof_join(
        facts, history, {"network_id": "owner"}, "day", "eff", {"value": "id"}
    )
    found = joined.groupBy().agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("payload").alias("payloads"),
        F.sum(F.when(F.col("value").isNotNull(), 1)).alias("matched"),
    )
    row = found.collect()[0]
    assert (row["rows"], row["payloads"]) == (300_000, 300_000)
    dated = F.col("day") >= F.lit(date(2024, 1, 10))
    assert row["matched"] == facts.where(dated & F.col("network_id").isNotNull()).count()
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "skew=true" in final


def test_hot_source_is_counted_whole(spark):
    """One source holds more than a third of all installs and reuses few addresses."""
    hot = F.col("id") % 3 == 0
    when = F.lit(datetime(2024, 1, 30, 12)).cast("timestamp_ntz")
    columns = {
        "app_id": F.lit(1).cast("bigint"),
        "campaign": F.lit("c"),
        "network_name": F.when(hot, F.lit("hot")).otherwise(
            F.concat(F.lit("n"), F.col("id") % 500)
        ),
        "network_publisher": F.lit("p"),
        "network_sub_publisher": F.lit("s"),
        "country_code": F.lit("US"),
        "install_time": when,
        "source_provider_id": F.lit(1),
        "ip": F.when(hot, F.col("id") % 700).otherwise(F.col("id")).cast("string"),
        "raw_data": F.lit(None).cast("string"),
    }
    installs = spark.range(0, 90_000, 1, 8).select(
        *(column.alias(name) for name, column in columns.items())
    )
    apps = spark.createDataFrame([(1, "one", "ios")], SCHEMAS["apps"])
    found = fraud.duplicate_ip_sources(installs, apps, AS_OF, max_ratio=Decimal("0.5")).collect()
    assert [(r.network_name, r.total_ips, r.distinct_ips) for r in found] == [
        ("hot", 30_000, 700)
    ]
