"""Session settings the reports are planned for.

The library never sets them itself; pass them to ``SparkSession.builder`` or
``spark-submit --conf``. Sizes are Spark's own checks: a join side is broadcast only
below ``autoBroadcastJoinThreshold``, and AQE re-checks it on the bytes really shuffled.
"""

SETTINGS = {
    # Click times and install times are zone-less; day boundaries are UTC.
    "spark.sql.session.timeZone": "UTC",
    # Re-planning at run time: partition sizes, join strategy, hot keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot keys even where the aggregate above then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
}

# For a cluster, in addition: start wide and let AQE merge what turns out small.
CLUSTER_SETTINGS = {
    **SETTINGS,
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.shuffle.partitions": "8000",
}
