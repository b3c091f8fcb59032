"""One local session for all tests."""

from __future__ import annotations

from collections.abc import Iterator

import pytest
from pyspark.sql import SparkSession

from adlytics.session import SETTINGS


@pytest.fixture(scope="session")
def spark() -> Iterator[SparkSession]:
    builder = SparkSession.builder.master("local[4]").appName("adlytics-tests")
    local = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
    }
    for key, value in {**SETTINGS, **local}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sort_merge(spark: SparkSession) -> Iterator[None]:
    """Takes automatic broadcasts away, as large tables would."""
    names = (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    )
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
