"""Checks of the input tables in the pass of the report itself.

Reports follow their inputs to the letter: an app listed twice multiplies its rows, a name
with two ids joins both. ``counted`` says how often that was so without a second job: the
counts are gathered while the report runs and are there when it has been written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

#: What a dimension should hold once; a repeated key multiplies the rows that join it.
KEYS: dict[str, tuple[str, ...]] = {
    "apps": ("id",),
    "countries": ("code",),
    "apps_flyer_network_names": ("name",),
    "apps_flyer_networks": ("app_id", "apps_flyer_network_name_id", "country_id"),
    "apps_flyer_network_publishers": ("apps_flyer_network_id", "name"),
    "apps_flyer_network_sub_publishers": ("apps_flyer_network_publisher_id", "name"),
}


def count_repeats(table: DataFrame, keys: Sequence[str], seen: Observation) -> DataFrame:
    """The same rows; ``seen`` gets their number, that of rows with a repeated key and that
    of rows with a NULL in the key, which join nothing."""
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return (
        table.withColumn("__copies", copies)
        .observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count(F.when((F.col("__copies") > 1) & ~missing, 1)).alias("repeated"),
            F.count(F.when(missing, 1)).alias("without_key"),
        )
        .drop("__copies")
    )


def counted(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None
) -> tuple[dict[str, DataFrame], dict[str, Observation]]:
    """Tables to build a report from, and what will have been seen of its dimensions.

    Only tables that the report reads are observed; ``get`` of another one waits for good. A
    table that the planner knows to be empty is planned away and has nothing to get.
    """
    keys = KEYS if keys is None else keys
    seen = {name: Observation(name) for name in tables if name in keys}
    watched = {name: count_repeats(tables[name], keys[name], seen[name]) for name in seen}
    return {**tables, **watched}, seen
