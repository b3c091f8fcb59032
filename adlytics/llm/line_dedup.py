"""Line dedup across documents: first occurrences found by a range-partitioned stream.

Text is read once to take a 128-bit key of each line that counts. The keys, not the lines,
are range-partitioned and sorted by document and position inside a partition; the first
document of a key streams past the rows behind it. What comes back per document is a keep
bitmap, compressed as run lengths, which ``apply_bitmaps`` lays over the text.

Hot keys: a key holding more than ``HOT_SHARE`` of all lines is looked up in a broadcast
table (at most 1 / HOT_SHARE keys by definition) and stays out of the ranges, so no range
holds more than that share of the lines. Nothing is dropped or capped.

Defined results: NULL and empty text are one empty line. Rows with one document id count
as one document, also where their texts differ; a NULL id is one document after all others.
An empty table gives no rows. Further input columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlytics.llm.common import SPACES, checkpointed, lower_ascii

HOT_SHARE = 1 / 512
MIN_CHARS = 10
#: Sorts a NULL document id after all others.
_LAST = (1 << 63) - 1


def line_keys(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """One row (doc, row, pos, key) for each line of at least ``min_chars`` characters.

    ``row`` tells apart the texts that share a document id.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.select(
            F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST)).alias("doc"),
            F.xxhash64(content).alias("row"),
            F.posexplode(F.split(lower_ascii(content), "\n")).alias("pos", "line"),
        )
        .withColumn("line", F.btrim("line", F.lit(SPACES)))
        .where(F.char_length("line") >= min_chars)
        .select("doc", "row", "pos", F.unhex(F.md5("line")).alias("key"))
    )


def dropped_lines(keys: DataFrame) -> DataFrame:
    """(doc, row, pos) of lines whose key is also held by a smaller document."""
    total = keys.count()
    counts = keys.groupBy("key").agg(
        F.count("*").alias("n"), F.min("doc").alias("first_doc")
    )
    hot = checkpointed(
        counts.where(F.col("n") > max(1.0, HOT_SHARE * total)).select("key", "first_doc")
    )
    from_hot = keys.join(F.broadcast(hot), "key")
    by_key = (
        Window.partitionBy("key")
        .orderBy("doc", "pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranges = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    from_ranges = (
        keys.join(F.broadcast(hot), "key", "left_anti")
        .repartitionByRange(ranges, "key")
        .withColumn("first_doc", F.first("doc").over(by_key))
    )
    columns = ["doc", "row", "pos", "first_doc"]
    both = from_ranges.select(columns).union(from_hot.select(columns))
    return both.where(F.col("doc") > F.col("first_doc")).drop("first_doc")


def keep_bitmaps(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """(doc, row, dropped) of each document that loses lines.

    ``dropped`` is the bitmap as run lengths: kept lines, dropped lines, kept lines, and so
    on from the first line; lines behind the last run are kept.
    """
    keys = checkpointed(line_keys(docs, doc_id, text, min_chars))
    positions = (
        dropped_lines(keys)
        .distinct()
        .groupBy("doc", "row")
        .agg(F.sort_array(F.collect_list("pos")).alias("at"))
    )
    at = F.col("at")
    starts = F.filter(at, lambda p, i: (i == 0) | (F.get(at, i - 1) != p - 1))
    ends = F.filter(at, lambda p, i: F.coalesce(F.get(at, i + 1) != p + 1, F.lit(True)))
    edges = positions.select("doc", "row", starts.alias("starts"), ends.alias("ends"))
    runs = F.flatten(
        F.transform(
            "starts",
            lambda p, i: F.array(
                p - F.coalesce(F.get(F.col("ends"), i - 1), F.lit(-1)) - 1,
                F.get(F.col("ends"), i) - p + 1,
            ),
        )
    )
    return edges.select("doc", "row", runs.alias("runs"))


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Adds ``n_lines``, ``n_dropped`` and ``kept_text`` to (document struct ``__doc``)."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("__doc"),
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST)).alias("doc"),
        F.xxhash64(content).alias("row"),
        content.alias("content"),
    )
    lines, runs = F.split("content", "\n"), F.col("runs")
    # Pairs (start, length) of kept lines; the last one reaches to the end.
    kept = (
        rows.join(bitmaps, ["doc", "row"], "left")
        .withColumn("lines", lines)
        .withColumn(
            "stops",
            F.aggregate(
                runs,
                F.array(F.lit(0)),
                lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)),
            ),
        )
    )
    stops, all_lines = F.col("stops"), F.col("lines")
    pieces = F.filter(
        F.transform(
            stops,
            lambda s, i: F.when(
                i % 2 == 0,
                F.slice(
                    all_lines,
                    s + 1,
                    F.coalesce(F.get(stops, i + 1), F.size(all_lines)) - s,
                ),
            ),
        ),
        lambda piece: piece.isNotNull(),
    )
    n_dropped = F.aggregate(
        F.filter(runs, lambda _, i: i % 2 == 1), F.lit(0), lambda acc, n: acc + n
    )
    return kept.select(
        "__doc",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(n_dropped, F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("runs").isNull(), F.col("content"))
        .otherwise(F.array_join(F.flatten(pieces), "\n"))
        .alias("kept_text"),
    )


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """``apply_bitmaps`` of the table's own bitmaps."""
    return apply_bitmaps(docs, keep_bitmaps(docs, doc_id, text, min_chars), doc_id, text)
