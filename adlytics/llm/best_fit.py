"""Best-fit packing of documents into fixed-length token sequences, in bulk rounds.

Pieces of equal length are interchangeable, and so are sequences with equal gaps. A round
therefore treats a length (longest first) as one class: all its pieces are matched with the
smallest gap class that holds them, the next larger one takes what is left over, and so on
(the successor sweep); which piece gets which sequence is decided by rank; the gaps are
updated and the next round begins. This is exactly best-fit decreasing, done class by class.

The state of the rounds is the count of each length and runs of sequences with equal gaps:
its size depends on the capacity, never on the data. The pieces themselves are
range-sorted and ranked by Spark, and each looks up the run that holds its rank.

Defined results: NULL text is empty and becomes the end token alone; equal rows are packed
each on their own; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import numbered, stored
from adlytics.llm.tokens import encode_column, tokenizer

#: Ranks are joined with runs by ranges of ``2 ** RANGE_BITS``.
RANGE_BITS = 14

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; of a longer document only the first is shorter.

    ``with_ids`` adds the tokens themselves as ``ids``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_path)
        for batch in batches:
            keys = batch.column(0).cast(pa.int64())
            for first, end, ids, ends in encode_column(encoder, batch.column(1)):
                # All documents' ids one after the other, each with the end token.
                ids = np.insert(ids, ends, end_id).astype("<u4", copy=False)
                ends = ends + np.arange(1, len(ends) + 1)
                sizes = np.diff(ends, prepend=0)
                count = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                short = sizes - (count - 1) * capacity
                start = np.where(piece > 0, short[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, short[row])
                begin = (ends - sizes)[row] + start
                raw = memoryview(ids).cast("B")
                crc = [
                    zlib.crc32(raw[a:b])
                    for a, b in zip((4 * begin).tolist(), (4 * (begin + length)).tolist())
                ]
                columns = [
                    keys.slice(first, end - first).take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    # Pieces follow one another without gaps.
                    offsets = pa.array(np.append(begin, len(ids)), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = PIECES + (", ids array<bigint>" if with_ids else "")
    return docs.select(F.col(doc_id).cast("bigint").alias("k"), F.col(text).alias("t")).mapInArrow(
        cut, schema
    )


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rounds of best fit over length classes.

    Returns runs (length, first rank, pieces, first sequence, offset): the pieces of that
    length with these ranks go, one each, into consecutive sequences at that offset.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []  # The gaps in use, ascending.
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def free(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            # The successor of the length among the gaps.
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                # No gap is large enough: open sequences for all that is left.
                gap = capacity
                first, n = sequences, -(-left // (capacity // length))
                sequences += n
            fits = gap // length
            used = min(n, left // fits)
            for k in range(fits if used else 0):
                runs.append((length, rank + k * used, used, first, capacity - gap + k * length))
            rank, left = rank + used * fits, left - used * fits
            free(gap - fits * length, first, used)
            if used < n and left < fits and left:
                # The last sequence of this length is filled in part.
                for k in range(left):
                    offset = capacity - gap + k * length
                    runs.append((length, rank + k, 1, first + used, offset))
                free(gap - left * length, first + used, 1)
                rank, left, used = rank + left, 0, used + 1
            if used < n:
                free(gap, first + used, n - used)
    return runs


def pack(pieces: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces no longer than ``capacity``."""
    spark = pieces.sparkSession
    # Stored first: finding the ranges below would make the pieces once more.
    pieces = stored(pieces)
    others = [c for c in ("doc_id", "piece", "start") if c in pieces.columns and c != length]
    ranked = numbered(pieces, [F.col(length), *map(F.col, others)], "__rank")
    found = ranked.groupBy(length).agg(F.count("*").alias("n")).collect()
    counts = {int(row[length]): row["n"] for row in found}
    if any(n < 1 or n > capacity for n in counts):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    before, total = {}, 0
    for size in sorted(counts):
        before[size], total = total, total + counts[size]
    found = np.array(best_fit_runs(counts, capacity), np.int64).reshape(-1, 5)
    start = np.array([before[size] for size in found[:, 0].tolist()], np.int64) + found[:, 1]
    columns = (start, start + found[:, 2], found[:, 3], found[:, 4])
    names = ("__from", "__to", "__first", "__offset")
    runs = spark.createDataFrame(pa.table(dict(zip(names, columns))))
    # By equality on a range of ranks: Spark chooses how to join, by the size of the runs.
    first, last = F.shiftright("__from", RANGE_BITS), F.shiftright(F.col("__to") - 1, RANGE_BITS)
    runs = runs.withColumn("__range", F.explode(F.sequence(first, last)))
    in_run = (
        (F.shiftright("__rank", RANGE_BITS) == F.col("__range"))
        & (F.col("__rank") >= F.col("__from"))
        & (F.col("__rank") < F.col("__to"))
    )
    return (
        ranked.join(runs, in_run)
        .withColumn("sequence_id", F.col("__first") + F.col("__rank") - F.col("__from"))
        .withColumn("offset", F.col("__offset"))
        .drop("__rank", "__from", "__to", "__first", "__offset", "__range")
    )
