"""The fixture tables written out once, to be read back the way a user reads theirs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlytics.sources import SCHEMAS, read_tables, write_fact
from fixtures.spark_tables import FixtureTables

_PARTITIONED = {
    "apps_flyer_data": "install_time",
    "apps_flyer_events": "install_time",
    "bime_export_aggregated_events": "date",
    "bime_export_installs": "install_date",
    "unconverting_sources": "date",
}


class StoredTables(FixtureTables):
    """Fixture tables read from ``root``, where ``store`` has put them."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str) -> None:
        super().__init__(spark, sf_dir)
        self._stored = read_tables(spark, root, partitioned=_PARTITIONED)

    def __getitem__(self, name: str) -> DataFrame:
        return self._stored[name]


def store(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Writes all fixture tables below ``root``, the facts partitioned by day."""
    tables = FixtureTables(spark, sf_dir)
    for name, schema in SCHEMAS.items():
        path = f"{root}/{name}"
        if name in _PARTITIONED:
            write_fact(tables[name], path, _PARTITIONED[name])
        else:
            spark.createDataFrame([], schema).unionByName(tables[name]).write.parquet(path)
