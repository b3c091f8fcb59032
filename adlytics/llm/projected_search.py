"""Approximate nearest neighbours: stable projections, kd-trees and a chi-square stop.

A vector is projected by ``PROJECTIONS`` Gaussian directions, which are 2-stable: the squared
projected distance of two vectors is their squared distance times a chi-square variable. A
query meets the others in ascending projected distance and compares them exactly; it stops
at the projected distance r where a vector nearer than the worst neighbour so far (at
distance d) would, with probability ``CONFIDENCE``, have been met: chi-square(r² / d²) >
``CONFIDENCE``. What lies exactly at r is still met.

Spread over the cluster: the projected space is cut into at most ``MAX_CELLS`` cells by a
kd-tree fitted on a bounded sample (about ``SAMPLE_ROWS`` rows; every vector is indexed). So
the splits and the cells' boxes, which all tasks hold, are bounded whatever the number of
vectors. A cell's vectors form blocks of at most about ``BLOCK_ROWS``; beyond that, and where
a cell cannot be cut, they are dealt into blocks by vector. Each block has a kd-tree of its
own. A query first searches its own cell;
its worst distance so far then names, by the same test, the blocks it still has to visit.
Queries of one block are dealt into groups too.

Copies: every row is a query, but of equal vectors only the k + 1 smallest ids are searched,
as no query can have another one among its k. Equal vectors have equal projections, so they
share cell and block and are met together.

Defined results: a vector that is NULL, zero, or holds a NULL, NaN or infinite component
takes no part, nor does a row without id. Vectors of different lengths never meet. Equal
rows count once; of several vectors with one id the smallest is the query, and none of them
is its neighbour. Ties go to the smaller id. Only the two columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import checkpointed, stored

PROJECTIONS = 8
CONFIDENCE = 0.98
SAMPLE_ROWS, MAX_CELLS = 131_072, 1 << 14
BLOCK_ROWS = 16_384
LEAF_ROWS = 64
QUERY_ROWS = 4_096
SEED = 11
#: Copies of one vector are first ranked in so many portions.
PORTIONS = 64

ROWS = "vec_id bigint, dim int, embedding array<double>, projected array<double>, cell int"
FOUND = "query_id bigint, vec_id bigint, score double"


def chi_square(x: float, degrees: int = PROJECTIONS) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for j in range(1, degrees // 2):
        term *= x / 2 / j
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi_square_point(p: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid) < p else (low, mid)
    return high


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, PROJECTIONS))


def project_rows(vectors: np.ndarray) -> np.ndarray:
    """The same bits for equal vectors in any batch, which a matrix product does not promise."""
    points = np.zeros((len(vectors), PROJECTIONS))
    for values, direction in zip(vectors.T, directions(vectors.shape[1])):
        points += values[:, None] * direction
    return points


def kd_splits(points: np.ndarray, cells: int) -> list[tuple[int, float]]:
    """A complete kd-tree of ``cells`` (a power of two) cells as splits in heap order."""
    splits: list[tuple[int, float]] = []
    level = [points]
    while len(level) < cells:
        below = []
        for own in level:
            if len(own):
                axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                at = float(np.median(own[:, axis]))
            else:
                axis, at = 0, 0.0
            splits.append((axis, at))
            right = own[:, axis] > at
            below += [own[~right], own[right]]
        level = below
    return splits


def cell_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    if splits:
        axis = np.array([a for a, _ in splits])
        at = np.array([b for _, b in splits])
        while (node < len(splits)).any():
            own = points[np.arange(len(points)), axis[node]]
            node = 2 * node + 1 + (own > at[node])
    return node - len(splits)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class BlockTree:
    """kd-tree over the projected vectors of a block."""

    def __init__(self, projected: np.ndarray) -> None:
        leaves, stack = [], [np.arange(len(projected))]
        while stack:
            rows = stack.pop()
            own = projected[rows]
            spread = own.max(axis=0) - own.min(axis=0)
            if len(rows) <= LEAF_ROWS or not spread.max() > 0:
                leaves.append(rows)
                continue
            order = np.argsort(own[:, int(np.argmax(spread))], kind="stable")
            half = len(rows) // 2
            stack += [rows[order[:half]], rows[order[half:]]]
        self.leaves = leaves
        self.projected = projected
        self.low = np.array([projected[rows].min(axis=0) for rows in leaves])
        self.high = np.array([projected[rows].max(axis=0) for rows in leaves])

    def nearest_first(self, point: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(squared projected distance from which on rows are unseen, rows met before it)."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0.0)
        reach = (gap * gap).sum(axis=1)
        order = np.argsort(reach, kind="stable")
        rows, far = np.empty(0, np.int64), np.empty(0)
        for k, leaf in enumerate(order):
            own = self.leaves[leaf]
            away = ((self.projected[own] - point) ** 2).sum(axis=1)
            rows, far = np.concatenate([rows, own]), np.concatenate([far, away])
            limit = float(reach[order[k + 1]]) if k + 1 < len(order) else math.inf
            # Rows at the limit wait for the others there: copies are met together.
            met = far < limit if limit < math.inf else np.ones(len(far), bool)
            yield limit, rows[met]
            rows, far = rows[~met], far[~met]


def search_block(
    ids: np.ndarray,
    vectors: np.ndarray,
    projected: np.ndarray,
    queries: list[tuple[int, np.ndarray, np.ndarray, float]],
    k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, ids, distances) of up to ``k`` neighbours of each query in the block.

    A query is (id, vector, projection, worst distance known so far).
    """
    tree = BlockTree(projected)
    stop = chi_square_point(CONFIDENCE)
    for query_id, vector, point, known in queries:
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        bound, before = known, 0.0
        for limit, rows in tree.nearest_first(point):
            # Everything still unseen is at least ``before`` away in the projection.
            if before > stop * bound * bound and bound < math.inf:
                break
            rows = rows[ids[rows] != query_id]
            if len(rows):
                away = np.sqrt(((vectors[rows] - vector) ** 2).sum(axis=1))
                all_ids, far = np.concatenate([best_ids, ids[rows]]), np.concatenate([best, away])
                order = np.lexsort((all_ids, far))[:k]
                best_ids, best = all_ids[order], far[order]
                if len(best) == k:
                    bound = min(known, float(best[-1]))
            before = limit
        yield query_id, best_ids, best


def _projected(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    value = F.col("embedding")
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        rows.select(
            F.col(vec_id).cast("bigint").alias("vec_id"),
            F.size(embedding).alias("dim"),
            F.col(embedding).cast("array<double>").alias("embedding"),
        )
        .where(F.col("vec_id").isNotNull() & value.isNotNull() & fine)
        .where(F.exists(value, lambda x: x != 0))
        .distinct()
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                points = project_rows(_matrix(own.column(2), int(dim)))
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0),
                        own.column(1),
                        own.column(2),
                        pa.array(list(points), pa.list_(pa.float64())),
                    ],
                    names=["vec_id", "dim", "embedding", "projected"],
                )

    return usable.mapInArrow(
        project, "vec_id bigint, dim int, embedding array<double>, projected array<double>"
    )


def _first_copies(points: DataFrame, k: int) -> DataFrame:
    """Of equal vectors the rows with the ``k`` + 1 smallest ids."""
    from pyspark.sql import Window

    same = ["same", "also"]
    marked = points.withColumns(
        {"same": F.xxhash64("embedding"), "also": F.xxhash64(F.lit(1), "embedding")}
    )
    ids = marked.select(*same, "vec_id")

    def least(ids: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy("vec_id")
        return ids.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)

    many = stored(ids.groupBy(same).agg(F.count("*").alias("n")).where(F.col("n") > k + 1))
    if many.isEmpty():
        return points
    dealt = ids.join(many, same, "left_semi").withColumn(
        "portion", F.pmod(F.xxhash64("vec_id"), F.lit(PORTIONS))
    )
    last = stored(
        least(least(dealt, *same, "portion"), *same)
        .where(F.col("place") == k + 1)
        .select(*same, F.col("vec_id").alias("last"))
    )
    first = F.col("last").isNull() | (F.col("vec_id") <= F.col("last"))
    return stored(marked.join(last, same, "left").where(first).select(points.columns))


def _cells(points: DataFrame) -> dict[int, list[tuple[int, float]]]:
    """Splits of the kd-tree of each vector length, from a bounded sample."""
    counts = {r["dim"]: r["n"] for r in points.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    keep = max(1, -(-sum(counts.values()) // SAMPLE_ROWS))
    sample = points.where(F.pmod(F.xxhash64("vec_id"), F.lit(keep)) == 0)
    found: dict[int, list] = {dim: [] for dim in counts}
    for row in sample.select("dim", "projected").collect():
        found[row["dim"]].append(row["projected"])
    splits = {}
    for dim, n in counts.items():
        cells = min(MAX_CELLS, 1 << max(0, math.ceil(math.log2(n / BLOCK_ROWS))))
        splits[dim] = kd_splits(np.array(found[dim]).reshape(-1, PROJECTIONS), cells)
    return splits


def _in_cells(points: DataFrame, splits: dict[int, list[tuple[int, float]]]) -> DataFrame:
    held = points.sparkSession.sparkContext.broadcast(splits)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            own = _matrix(batch.column(3), PROJECTIONS)
            cells = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                cells[dims == dim] = cell_of(own[dims == dim], held.value[int(dim)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells)],
                names=["vec_id", "dim", "embedding", "projected", "cell"],
            )

    return points.mapInArrow(place, ROWS)


def _search(blocks: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """Searches every (dim, cell, part) a query visits; queries of a block come in groups."""
    keys = ["dim", "cell", "part"]
    groups = F.ceil(F.count("*") / QUERY_ROWS).cast("int")
    sizes = checkpointed(visits.groupBy(keys).agg(groups.alias("groups")))
    asked = visits.join(sizes, keys).withColumn(
        "group", F.pmod(F.xxhash64("vec_id"), F.col("groups")).cast("int")
    )
    offered = blocks.join(sizes, keys).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    )

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            parts = {}
            for side, rows in (("left", left), ("right", right)):
                parts[side] = (
                    rows.column("vec_id").to_numpy(),
                    _matrix(rows.column("embedding").combine_chunks(), dim),
                    _matrix(rows.column("projected").combine_chunks(), PROJECTIONS),
                )
            known = right.column("known").to_numpy()
            queries = list(zip(parts["right"][0].tolist(), *parts["right"][1:], known.tolist()))
            out = list(search_block(*parts["left"], queries, k))
        return pa.table(
            {
                "query_id": pa.array(
                    [q for q, ids, _ in out for _ in range(len(ids))], pa.int64()
                ),
                "vec_id": pa.array([i for _, ids, _ in out for i in ids.tolist()], pa.int64()),
                "score": pa.array([x for _, _, far in out for x in far.tolist()], pa.float64()),
            }
        )

    keys = [*keys, "group"]
    left = offered.select(*keys, "vec_id", "embedding", "projected").groupBy(*keys)
    right = asked.select(*keys, "vec_id", "embedding", "projected", "known").groupBy(*keys)
    return left.cogroup(right).applyInArrow(search, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query; a query has at most ``k`` from each block it visited."""
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def nearest(
    rows: DataFrame,
    every: int,
    k: int,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): ``k`` neighbours of each row with id divisible by ``every``."""
    spark = rows.sparkSession
    points = stored(_projected(rows, vec_id, embedding))
    searched = _first_copies(points, k)
    splits = _cells(searched)
    placed = _in_cells(searched, splits)
    keys = ["dim", "cell"]
    parts = F.ceil(F.count("*") / BLOCK_ROWS).cast("int")
    axis = range(PROJECTIONS)
    # One row per cell: at most MAX_CELLS for each length of vectors.
    cells = checkpointed(
        placed.groupBy(keys).agg(
            parts.alias("parts"),
            *(F.min(F.col("projected")[i]).alias(f"low{i}") for i in axis),
            *(F.max(F.col("projected")[i]).alias(f"high{i}") for i in axis),
        )
    )
    blocks = stored(
        placed.join(F.broadcast(cells.select(*keys, "parts")), keys)
        .withColumn("part", F.pmod(F.xxhash64("embedding"), F.col("parts")).cast("int"))
        .drop("parts")
    )
    boxes = cells.collect()
    held = spark.sparkContext.broadcast(
        (
            np.array([[r["dim"], r["cell"], r["parts"]] for r in boxes], np.int32).reshape(-1, 3),
            np.array([[r[f"low{i}"] for i in axis] for r in boxes]).reshape(-1, PROJECTIONS),
            np.array([[r[f"high{i}"] for i in axis] for r in boxes]).reshape(-1, PROJECTIONS),
        )
    )
    queries = checkpointed(
        _in_cells(points.where(F.col("vec_id") % every == 0), splits)
        .groupBy("vec_id")
        .agg(F.min(F.struct("embedding", "dim", "projected", "cell")).alias("q"))
        .select("vec_id", "q.*")
    )

    def visits(own_cell: bool):
        stop = chi_square_point(CONFIDENCE)

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known_cells, low, high = held.value
            for batch in batches:
                dims, cells = batch.column(1).to_numpy(), batch.column(4).to_numpy()
                points, known = _matrix(batch.column(3), PROJECTIONS), batch.column(5).to_numpy()
                row, cell = [], []
                for i in range(len(dims)):
                    home = (known_cells[:, 0] == dims[i]) & (known_cells[:, 1] == cells[i])
                    if own_cell:
                        go = home
                    else:
                        gap = np.maximum(np.maximum(low - points[i], points[i] - high), 0.0)
                        near = (gap * gap).sum(axis=1) <= stop * known[i] * known[i]
                        go = (known_cells[:, 0] == dims[i]) & ~home & near
                    found = np.flatnonzero(go)
                    row += [i] * len(found)
                    cell += found.tolist()
                chosen = known_cells[np.array(cell, np.int64)].reshape(-1, 3)
                parts = chosen[:, 2]
                # All blocks of a cell, some rows at a time.
                row, chosen = np.repeat(np.array(row, np.int64), parts), np.repeat(chosen, parts, axis=0)
                part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                for at in range(0, len(row), 8192):
                    some = slice(at, at + 8192)
                    own = batch.take(pa.array(row[some]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(own.column(c) for c in (0, 2, 3, 5)),
                            pa.array(chosen[some, 0]),
                            pa.array(chosen[some, 1]),
                            pa.array(part[some].astype(np.int32)),
                        ],
                        names=["vec_id", "embedding", "projected", "known", "dim", "cell", "part"],
                    )

        return choose

    schema = (
        "vec_id bigint, embedding array<double>, projected array<double>, known double,"
        " dim int, cell int, part int"
    )
    columns = ["vec_id", "dim", "embedding", "projected", "cell", "known"]
    first = queries.withColumn("known", F.lit(float("inf"))).select(columns)
    home = checkpointed(_best(_search(blocks, first.mapInArrow(visits(True), schema), k), k))
    worst = home.where(F.col("rank") == k).select("query_id", F.col("score").alias("found"))
    second = queries.join(worst, F.col("vec_id") == F.col("query_id"), "left").withColumn(
        "known", F.coalesce("found", F.lit(float("inf")))
    )
    away = _search(blocks, second.select(columns).mapInArrow(visits(False), schema), k)
    best = _best(home.select("query_id", "vec_id", "score").union(away), k)
    return best.select("query_id", "rank", "vec_id", "score")
