"""Helpers shared by the operators: text columns, cut lineage, distributed numbering."""

from __future__ import annotations

import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Words between ASCII white space; none for NULL or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, SPACE_RUN))


def rolling_hashes(word_array: str, width: int) -> Column:
    """64-bit hash of each window of ``width`` consecutive words, in order.

    ``word_array`` names a column, so that a window reads it and never builds it again.
    """
    w = F.col(word_array)
    none = F.array().cast("array<bigint>")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - width),
        lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(width))),
    )
    return F.when(F.size(w) >= width, windows).otherwise(none)


def finite_vector(vector: Column) -> Column:
    """Whether no component is NULL, NaN or infinite."""
    return F.forall(
        vector,
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))),
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's, or a local one where all is one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows written once to the shared folder; partitions and their order stay as they are."""
    folder = shared_folder(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Rows written once to the shared folder as a Parquet table, for wide or large rows."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``: places 0, 1, 2, ... in the given order, without gaps.

    Rows are range-partitioned by the whole order, so equal leading keys spread over
    partitions, sorted inside them and checkpointed. A row's place is the number of rows
    in the partitions before its own plus its place there; only those counts (one row per
    partition) meet in one task. Rows equal in ``order`` are placed in any order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = checkpointed(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    part = F.shiftright("__at", 33)
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n")).collect()
    starts, total = [], 0
    for part_id, n in sorted((row["__part"], row["__n"]) for row in counts):
        starts.append((part_id, total))
        total += n
    spark = df.sparkSession
    offsets = spark.createDataFrame(starts, "__part bigint, __start bigint")
    inside = F.col("__at").bitwiseAND((1 << 33) - 1)
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__start") + inside)
        .drop("__part", "__start", "__at")
    )
