"""Times every operator query at $BENCH_SF_DIR on local[$BENCH_CPUS].

The fixture tables are derived and stored first (reported as ``setup``); the queries then
read the stored tables, as they would in use. Each query is built and run into a ``noop``
sink: one warm-up, then the median of $BENCH_RUNS runs. Prints one JSON line. With
$BENCH_DETAIL set to a file name, a table with input rows, exchanges and shuffled bytes of
each query is written there.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adlytics.session import SETTINGS  # noqa: E402
from fixtures.queries import BUILDERS  # noqa: E402
from fixtures.stored import StoredTables, store  # noqa: E402


def timed(build, tables) -> float:
    start = time.perf_counter()
    result: DataFrame = build(tables)
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stages(spark: SparkSession) -> dict[int, tuple[int, int]]:
    """Input rows and shuffled bytes of every stage run so far."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    found = spark.sparkContext._jsc.sc().statusStore().stageList(
        jvm.java.util.ArrayList(),
        False,
        False,
        gateway.new_array(jvm.double, 0),
        jvm.java.util.ArrayList(),
    )
    every = (found.apply(i) for i in range(found.size()))
    return {s.stageId(): (s.inputRecords(), s.shuffleWriteBytes()) for s in every}


def exchanges(result: DataFrame) -> int:
    text = result._jdf.queryExecution().executedPlan().toString()
    initial = text.split("== Initial Plan ==")[-1]
    return initial.count(" Exchange ")


def detail(spark: SparkSession, build, tables) -> tuple[int, int, int]:
    """Input rows, exchanges and shuffled bytes of one run."""
    before = stages(spark)
    timed(build, tables)
    new = [numbers for stage, numbers in stages(spark).items() if stage not in before]
    return sum(n[0] for n in new), exchanges(build(tables)), sum(n[1] for n in new)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    detail_file = os.environ.get("BENCH_DETAIL")
    only = sys.argv[1:]
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("adlytics-bench")
    local = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": cpus,
        # The stored tables are small: keep partitions for all cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**SETTINGS, **local}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    # On a cluster, a folder all executors see.
    with tempfile.TemporaryDirectory(prefix="bench-", dir=os.environ.get("BENCH_ROOT")) as root:
        start = time.perf_counter()
        store(spark, sf_dir, root)
        setup = time.perf_counter() - start
        tables = StoredTables(spark, sf_dir, root)
        seconds: dict[str, float] = {}
        details = []
        for name, build in BUILDERS.items():
            if only and name not in only:
                continue
            timed(build, tables)
            seconds[name] = round(statistics.median(timed(build, tables) for _ in range(runs)), 3)
            if detail_file:
                details.append((name, seconds[name], *detail(spark, build, tables)))
        spark.stop()
    if detail_file:
        with open(detail_file, "w") as out:
            out.write("| query | seconds | input rows | exchanges | shuffled KB |\n")
            out.write("|---|---|---|---|---|\n")
            for name, took, read, shuffles, size in details:
                out.write(f"| {name} | {took:.2f} | {read:,} | {shuffles} | {size // 1024:,} |\n")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "setup": round(setup, 3),
            }
        )
    )


if __name__ == "__main__":
    main()
