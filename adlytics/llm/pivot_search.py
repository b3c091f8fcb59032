"""Exact search for the largest inner products, by a pivot-distance index.

The vectors get one more coordinate, so that all have the norm M of the longest one; a query
gets a zero there. Then |q - x|² = |q|² + M² - 2 qx: the largest products are the smallest
distances, and the triangle inequality holds.

Index: every vector is keyed by its nearest pivot and its distance from it; the distances of
a pivot are cut into annuli. The directory holds the smallest and largest distance and the
number of rows of each annulus. A vector in an annulus with distances a to b of a pivot at
distance d from the query is at least max(d - b, a - d) away from the query.

Search: a query sorts the annuli by that bound and visits them in rounds, each round with
more rows than the one before. A round's visits and the vectors of the visited annuli are
cogrouped in blocks; scores are exact integers. A query stops when the next bound is beyond
its worst answer so far (beyond the rounding of doubles too), so that no vector is missed.

Bounds: pivots and annuli are fitted on at most ``SAMPLE_ROWS`` vectors, every vector is
indexed, and any pivots give the same answers. There are about ``CELL_ROWS`` vectors to an
annulus and at most ``MAX_CELLS`` annuli, so the directory is bounded; larger annuli are
dealt into blocks of about ``BLOCK_ROWS``, and a block meets ``QUERY_ROWS`` queries at a
time. Of equal vectors only the k + 1 rows with the smallest ids are indexed, as no other
can be among any k answers; equal queries are searched once, and every row is answered.

Defined results: a vector that is NULL or holds a NULL, NaN or infinite component takes no
part, nor does a row without id. A query's own row is no candidate, but any other row is,
one with the same id or the same vector too; rows with equal ids are queries each. Vectors
of different lengths never meet. Ties go to the smaller id. Vectors whose products cannot
be held by a long raise an error. An empty table gives no rows. Only two columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlytics.llm.common import checkpointed, finite_vector, numbered, stored

SAMPLE_ROWS = 8_192
CELL_ROWS, MAX_CELLS = 512, 1 << 16
BLOCK_ROWS, QUERY_ROWS = 1_024, 2_048
#: Rows that the annuli of the first rounds hold together; the last round has no bound.
ROUND_ROWS = (1_024, 16_384)
#: Portions in which copies of one vector are first counted.
PORTIONS = 32
#: Doubles are exact up to here; larger products are computed in whole numbers.
EXACT = 1 << 53
#: Share of the norms by which a bound may be off through rounding.
SLACK = 1e-6

INDEXED = "row bigint, vec_id bigint, x array<bigint>, dim int, cell int, distance double"
VISITS = "qid bigint, dim int, cell int, block int, chunk bigint, x array<bigint>, worst bigint"
FOUND = "qid bigint, vec_id bigint, row bigint, score bigint"


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not width:
        return np.zeros((len(column), 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more coordinate, all of the same norm."""
    x = x.astype(np.float64)
    rest = np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points * points).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)
    return np.sqrt(np.maximum(square - 2.0 * points @ pivots.T, 0.0))


class Layout:
    """Pivots of one vector length, the edges of their annuli, and later their directory."""

    def __init__(self, sample: np.ndarray, longest: float, cells: int) -> None:
        self.longest = longest
        count = max(1, min(len(sample), math.isqrt(cells - 1) + 1))
        self.rings = max(1, -(-cells // count))
        points = lifted(sample, longest)
        self.pivots = points[np.linspace(0, len(points) - 1, count).astype(int)]
        for _ in range(8):
            nearest = distances(points, self.pivots).argmin(axis=1)
            members = np.bincount(nearest, minlength=count)
            sums = np.zeros_like(self.pivots)
            np.add.at(sums, nearest, points)
            some = members > 0
            self.pivots[some] = sums[some] / members[some, None]
        apart = distances(points, self.pivots)
        nearest, own = apart.argmin(axis=1), apart.min(axis=1)
        self.edges = np.zeros((count, self.rings - 1))
        for pivot in range(count):
            if (nearest == pivot).any():
                shares = np.arange(1, self.rings) / self.rings
                self.edges[pivot] = np.quantile(own[nearest == pivot], shares)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The annulus of each vector and its distance from the pivot."""
        apart = distances(lifted(x, self.longest), self.pivots)
        pivot, own = apart.argmin(axis=1), apart.min(axis=1)
        ring = (own[:, None] > self.edges[pivot]).sum(axis=1)
        return pivot * self.rings + ring, own

    def describe(self, cells: list[tuple[int, int, float, float]]) -> None:
        """The directory: (cell, rows, smallest and largest distance) of the annuli in use."""
        found = np.array(sorted(cells), np.float64).reshape(-1, 4)
        self.cells, self.rows = found[:, 0].astype(np.int64), found[:, 1].astype(np.int64)
        self.low, self.high = found[:, 2], found[:, 3]

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """The least distance between each query and the vectors of each annulus."""
        points = np.concatenate([x.astype(np.float64), np.zeros((len(x), 1))], axis=1)
        apart = distances(points, self.pivots)[:, self.cells // self.rings]
        slack = SLACK * (np.sqrt((points * points).sum(axis=1)) + math.sqrt(self.longest))
        return np.maximum(apart - self.high, self.low - apart) - slack[:, None]

    def reach(self, x: np.ndarray, worst: np.ndarray) -> np.ndarray:
        """The distance of a vector with the product ``worst``."""
        square = (x.astype(np.float64) ** 2).sum(axis=1) + self.longest - 2.0 * worst
        return np.sqrt(np.maximum(square, 0.0))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    largest = max(int(np.abs(queries).max(initial=0)), 1) * max(int(np.abs(vectors).max(initial=0)), 1)
    if largest * queries.shape[1] < EXACT:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return queries @ vectors.T


def _scaled(rows: DataFrame, scale: int, id_column: str, vector: str) -> DataFrame:
    """(row, vec_id, x, dim) of the rows that take part."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    return stored(
        rows.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & finite_vector(F.col(vector)))
        .select(F.col(id_column).cast("bigint").alias("vec_id"), x.alias("x"))
        .select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "x", F.size("x").alias("dim")
        )
    )


def _first_copies(rows: DataFrame, keep: int) -> DataFrame:
    """Of equal vectors the rows with the smallest ids."""
    portion = F.pmod(F.xxhash64("row"), F.lit(PORTIONS))
    order = [F.col("vec_id"), F.col("row")]
    some = rows.withColumn("portion", portion).withColumn(
        "rank", F.row_number().over(Window.partitionBy("x", "portion").orderBy(*order))
    )
    every = Window.partitionBy("x").orderBy(*order)
    return (
        some.where(F.col("rank") <= keep)
        .withColumn("rank", F.row_number().over(every))
        .where(F.col("rank") <= keep)
        .drop("rank", "portion")
    )


def _layouts(rows: DataFrame, cell_rows: int) -> dict[int, Layout]:
    """A layout for each length of vectors, from a bounded sample."""
    square = F.aggregate("x", F.lit(0.0), lambda acc, c: acc + c.cast("double") * c.cast("double"))
    largest = F.aggregate("x", F.lit(0.0), lambda acc, c: F.greatest(acc, F.abs(c.cast("double"))))
    sizes = rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.max(square).alias("longest"), F.max(largest).alias("largest")
    )
    sample = rows.select("dim", "x").orderBy(F.xxhash64("x"), "x").limit(SAMPLE_ROWS).collect()
    out = {}
    for dim, n, longest, most in sizes.collect():
        if dim * most * most >= 2.0**63:
            raise ValueError("products of these vectors do not fit in a long")
        own = [r["x"] for r in sample if r["dim"] == dim] or [[0] * dim]
        own = np.array(own, np.int64).reshape(len(own), dim)
        # The sums of squares of doubles may be off by their rounding.
        out[dim] = Layout(own, longest * (1 + 1e-12), min(MAX_CELLS, max(1, n // cell_rows)))
    return out


def _placed(layouts: dict[int, Layout]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                cell, distance = layouts[int(dim)].place(_matrix(own.column(2), int(dim)))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(cell, pa.int32()), pa.array(distance)],
                    names=["row", "vec_id", "x", "dim", "cell", "distance"],
                )

    return place


def _visits(layouts: dict[int, Layout], blocks: int, queries_at_once: int, seen: int, until: float):
    """Visits of one round: the annuli whose rows, in the order of the bounds, are past the
    first ``seen`` but not past the first ``until``, as far as a query's worst answer reaches."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                layout, x = layouts[int(dim)], _matrix(own.column(2), int(dim))
                known = own.column(3).is_valid().to_numpy(zero_copy_only=False)
                worst = own.column(3).fill_null(0).to_numpy()
                far = np.where(known, layout.reach(x, worst), np.inf)
                step = max(1, (1 << 22) // max(1, len(layout.cells)))
                for at in range(0, len(x), step):
                    part = slice(at, at + step)
                    bound = layout.bounds(x[part])
                    order = np.argsort(bound, axis=1, kind="stable")
                    before = np.cumsum(layout.rows[order], axis=1) - layout.rows[order]
                    near = np.take_along_axis(bound, order, axis=1) <= far[part][:, None]
                    query, place = np.nonzero(near & (before >= seen) & (before < until))
                    cell = order[query, place]
                    # Large annuli are several blocks.
                    many = -(-layout.rows[cell] // blocks)
                    query, cell = np.repeat(query, many), np.repeat(cell, many)
                    block = np.arange(len(query)) - np.repeat(np.cumsum(many) - many, many)
                    for first in range(0, len(query), 8192):
                        some = slice(first, first + 8192)
                        taken = own.slice(at).take(pa.array(query[some]))
                        qid = taken.column(0).to_numpy()
                        yield pa.RecordBatch.from_arrays(
                            [
                                taken.column(0),
                                taken.column(1),
                                pa.array(layout.cells[cell[some]], pa.int32()),
                                pa.array(block[some], pa.int32()),
                                pa.array(qid // queries_at_once),
                                taken.column(2),
                                taken.column(3),
                            ],
                            names=["qid", "dim", "cell", "block", "chunk", "x", "worst"],
                        )

    return visit


def _compared(keep: int):
    def compare(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[np.empty(0, np.int64)] for _ in range(4)]
        if vectors.num_rows and queries.num_rows:
            dim = queries.column("dim")[0].as_py()
            ids, rows = vectors.column("vec_id").to_numpy(), vectors.column("row").to_numpy()
            # Among equal scores the columns then come in the order of ties.
            order = np.lexsort((rows, ids))
            ids, rows = ids[order], rows[order]
            x = _matrix(vectors.column("x"), dim)[order]
            q = _matrix(queries.column("x"), dim)
            qid = queries.column("qid").to_numpy()
            known = queries.column("worst").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
            worst = np.where(
                known, queries.column("worst").fill_null(0).to_numpy(), np.iinfo(np.int64).min
            )
            for at in range(0, len(q), 256):
                score = products(q[at : at + 256], x)
                least = worst[at : at + 256]
                if len(x) > keep:
                    least = np.maximum(least, np.partition(score, len(x) - keep, axis=1)[:, -keep])
                i, j = np.nonzero(score >= least[:, None])
                s = score[i, j]
                best = np.lexsort((j, -s, i))
                i, j, s = i[best], j[best], s[best]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                i, j, s = i[place < keep], j[place < keep], s[place < keep]
                for part, values in zip(out, (qid[at + i], ids[j], rows[j], s)):
                    part.append(values)
        names = ["qid", "vec_id", "row", "score"]
        return pa.table({n: np.concatenate(part) for n, part in zip(names, out)})

    return compare


def top_products(
    vectors: DataFrame,
    every: int,
    k: int,
    scale: int = 256,
    id_column: str = "vec_id",
    vector: str = "embedding",
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    round_rows: tuple[int, ...] = ROUND_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest products with each
    row whose id is divisible by ``every``. Components are floor(scale * component)."""
    keep = k + 1
    rows = _scaled(vectors, scale, id_column, vector)
    kept = stored(_first_copies(rows, keep))
    layouts = _layouts(kept, cell_rows)
    indexed = stored(kept.mapInArrow(_placed(layouts), INDEXED))
    directory = indexed.groupBy("dim", "cell").agg(
        F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")
    )
    found: dict[int, list] = {dim: [] for dim in layouts}
    for r in directory.collect():
        found[r["dim"]].append((r["cell"], r["n"], r["low"], r["high"]))
    for dim, layout in layouts.items():
        layout.describe(found[dim])
    sizes = vectors.sparkSession.createDataFrame(
        [(dim, cell, -(-n // block_rows)) for dim, own in found.items() for cell, n, _, _ in own],
        "dim int, cell int, blocks int",
    )
    dealt = (
        indexed.join(F.broadcast(sizes), ["dim", "cell"])
        .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
        .select("dim", "cell", "block", "vec_id", "row", "x")
    )
    asking = rows.where(F.col("vec_id") % every == 0)
    # Queries of one annulus are numbered together, so that their visits share blocks.
    distinct = (
        asking.select("dim", "x")
        .distinct()
        .select(F.lit(0).cast("bigint").alias("row"), F.lit(0).cast("bigint").alias("vec_id"), "x", "dim")
        .mapInArrow(_placed(layouts), INDEXED)
        .select("dim", "x", "cell")
    )
    queries = stored(
        numbered(checkpointed(distinct), [F.col("dim"), F.col("cell"), F.xxhash64("x")], "qid")
    )
    best, seen = None, 0
    order = [F.desc("score"), F.asc("vec_id"), F.asc("row")]
    for until in (*round_rows, math.inf):
        worst = F.lit(None).cast("bigint").alias("worst")
        waiting = queries.select("qid", "dim", "x", worst)
        if best is not None:
            # With fewer answers than asked for, any vector may be one.
            reached = best.groupBy("qid").agg(
                F.when(F.count("*") >= keep, F.min("score")).alias("worst")
            )
            waiting = queries.join(reached, "qid", "left").select("qid", "dim", "x", "worst")
        visits = checkpointed(
            waiting.mapInArrow(_visits(layouts, block_rows, query_rows, seen, until), VISITS)
        )
        key = ["dim", "cell", "block"]
        asked = visits.select(*key, F.col("chunk").alias("part")).distinct()
        new = (
            dealt.join(asked, key)
            .groupBy(*key, "part")
            .cogroup(visits.groupBy(*key, "chunk"))
            .applyInArrow(_compared(keep), FOUND)
        )
        merged = new if best is None else best.unionByName(new)
        rank = F.row_number().over(Window.partitionBy("qid").orderBy(*order))
        best = checkpointed(
            merged.withColumn("rank", rank).where(F.col("rank") <= keep).drop("rank")
        )
        seen = until
    answer = F.struct((-F.col("score")).alias("minus"), "vec_id", "row", "score")
    answers = (
        best.groupBy("qid")
        .agg(F.sort_array(F.collect_list(answer)).alias("answers"))
        .join(queries.select("qid", F.col("x").alias("query")), "qid")
        .select("query", "answers")
    )
    others = F.slice(F.filter("answers", lambda a: a["row"] != F.col("own")), 1, k)
    return (
        asking.select(F.col("vec_id").alias("query_id"), F.col("row").alias("own"), "x")
        .join(answers, F.col("x") == F.col("query"))
        .select("query_id", F.posexplode(others).alias("at", "answer"))
        .select(
            "query_id",
            (F.col("at") + 1).alias("rank"),
            F.col("answer.vec_id").alias("vec_id"),
            F.col("answer.score").alias("score"),
        )
    )
