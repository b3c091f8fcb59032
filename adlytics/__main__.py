"""Runs one report: ``python -m adlytics REPORT --tables ROOT --output PATH --as-of DAY``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from adlytics.reports import REPORTS
from adlytics.session import CLUSTER_SETTINGS, SETTINGS
from adlytics.sources import LAYOUTS, read_tables, write_report


def table_layout(text: str) -> tuple[str, str]:
    """TABLE=LAYOUT of the command line."""
    name, _, layout = text.partition("=")
    if layout not in LAYOUTS:
        raise argparse.ArgumentTypeError(f"{text!r}: give TABLE={{{','.join(LAYOUTS)}}}")
    return name, layout


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="adlytics", description=__doc__)
    parser.add_argument("report", choices=sorted(REPORTS))
    parser.add_argument("--tables", required=True, help="folder holding one folder per table")
    parser.add_argument("--output", required=True, help="where to write the report")
    parser.add_argument("--as-of", required=True, type=date.fromisoformat)
    parser.add_argument("--format", default="parquet", help="format of the tables")
    parser.add_argument(
        "--partitioned", nargs="*", default=(), help="tables partitioned by write_fact"
    )
    parser.add_argument(
        "--layout",
        nargs="*",
        default=(),
        type=table_layout,
        metavar="TABLE=LAYOUT",
        help=f"how a table was stored: {', '.join(LAYOUTS)}",
    )
    parser.add_argument(
        "--daily",
        action="store_true",
        help="keep one report per day below the output; a repeated run replaces its own day",
    )
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"adlytics {options.report}").getOrCreate()
    given = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local")
    for key, value in (SETTINGS if local else CLUSTER_SETTINGS).items():
        if not given.contains(key):
            spark.conf.set(key, value)
    report = REPORTS[options.report]
    tables = read_tables(
        spark,
        options.tables,
        report.tables,
        options.format,
        options.partitioned,
        dict(options.layout),
    )
    result = report.build(tables, options.as_of)
    write_report(result, options.output, as_of=options.as_of if options.daily else None)


if __name__ == "__main__":
    main()
