"""Whitening of embeddings by QDWH spectral divide-and-conquer.

Fit: the covariance of the distinct vectors is summed up by Spark, one partial matrix per
task, from vectors centred before they are multiplied. Its eigenvectors are found by
dividing the spectrum: the polar factor U of V - sI, computed by the QR-based dynamically
weighted Halley iteration, has the eigenvectors of V and eigenvalues 1 above s and -1 below,
so (U + I) / 2 projects on the subspace above s and (I - U) / 2 on the one below. Both are
split again, down to single directions. That happens on one matrix of the vectors' length,
whatever number of rows there is; the components are then sent to all tasks, which centre,
project and scale the rows.

All sums that are whole numbers are exact: n, the sums S, n x - S and the deviations.
``identity_error`` is measured: the covariance of the whitened vectors of the fit is summed
up in one more pass.

Defined results: a vector that is NULL or holds a NULL, NaN or infinite component is left
out. Equal vectors are one vector of the fit, however many rows hold them (a hot one is
combined before the shuffle); every row is returned, repeated ones and rows without id too.
Vectors of different lengths are fitted apart. Directions without variance (an eigenvalue
that is zero but for rounding) have no component, so a single vector gives no rows, and
neither does an empty table or an empty vector. A deviation too large for a long is NULL.
Only the two columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import finite_vector, stored

EPS = float(np.finfo(np.float64).eps)
#: A subspace is split off when what is left between the two is below so many roundings.
LEFT_OVER = 64
TRIES = 80
WHITE = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double,"
    " explained double, identity_error double"
)


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH."""
    n = len(a)
    x = a / np.abs(a).sum(axis=0).max()
    low = EPS  # Below the smallest singular value; a loose bound costs a round at most.
    eye = np.eye(n)
    for _ in range(30):
        square = low * low
        d = np.cbrt(4.0 * (1.0 - square) / (square * square))
        root = np.sqrt(1.0 + d)
        p = root + 0.5 * np.sqrt(8.0 - 4.0 * d + 8.0 * (2.0 - square) / (square * root))
        q = (p - 1.0) ** 2 / 4.0
        r = p + q - 1.0
        low = min(1.0, low * (p + q * square) / (1.0 + r * square))
        if r > 100.0:
            stacked = np.linalg.qr(np.concatenate([np.sqrt(r) * x, eye]))[0]
            moved = (p - q / r) / np.sqrt(r) * (stacked[:n] @ stacked[n:].T)
        else:
            moved = (p - q / r) * np.linalg.solve(eye + r * (x.T @ x), x.T).T
        after = (q / r) * x + moved
        after = (after + after.T) / 2.0
        change = np.abs(after - x).max()
        x = after
        if abs(1.0 - low) < 10 * EPS and change < 1e-8:
            break
    return x


def _split(a: np.ndarray, size: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces of ``a``, or None where all eigenvalues are one."""
    n = len(a)
    diagonal = np.diag(a)
    radius = np.abs(a).sum(axis=0) - np.abs(diagonal)
    low, high = (diagonal - radius).min(), (diagonal + radius).max()
    shift, best = float(np.median(diagonal)), None
    for _ in range(TRIES):
        if high - low <= n * EPS * size:
            break
        u = polar_factor(a - shift * np.eye(n)) if np.any(a != shift * np.eye(n)) else np.zeros((n, n))
        rank = int(round((n + np.trace(u)) / 2.0))
        if 0 < rank < n:
            projector = (u + np.eye(n)) / 2.0
            basis = np.linalg.qr(projector @ rng.standard_normal((n, rank)))[0]
            basis = np.linalg.qr(projector @ basis, mode="complete")[0]
            above, below = basis[:, :rank], basis[:, rank:]
            left = float(np.abs(below.T @ a @ above).max())
            if best is None or left < best[0]:
                best = left, above, below
            if left <= LEFT_OVER * EPS * size:
                break
            # Too near an eigenvalue: another place between the bounds.
            shift = low + (high - low) * (0.2 + 0.6 * rng.random())
            continue
        low, high = (low, shift) if rank == 0 else (shift, high)
        shift = (low + high) / 2.0
    return best and best[1:]


def spectrum(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of a symmetric matrix and their eigenvectors as columns."""
    size = float(np.linalg.norm(v))
    rng = np.random.default_rng(len(v))
    done: list[tuple[float, np.ndarray]] = []
    waiting = [(v, np.eye(len(v)))] if len(v) else []
    while waiting:
        a, basis = waiting.pop()
        halves = _split(a, size, rng) if len(a) > 1 and size > 0 else None
        if halves is None:
            done += [(float(a[i, i]), basis[:, i]) for i in range(len(a))]
            continue
        for own in halves:
            part = own.T @ a @ own
            waiting.append(((part + part.T) / 2.0, basis @ own))
    done.sort(key=lambda pair: -pair[0])
    values = np.array([value for value, _ in done])
    vectors = np.array([vector for _, vector in done]).reshape(len(v), len(v)).T
    return values, vectors


@dataclass
class Fit:
    """Components of the vectors of one length."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.directions / np.sqrt(self.values)


def whole(n: int, sums: np.ndarray, x: np.ndarray) -> np.ndarray:
    """n x - S, exactly: in longs, or in unbounded numbers where these could overflow."""
    if n * max(int(np.abs(x).max(initial=0)), 1) >= 1 << 62 or max(map(abs, sums.tolist()), default=0) >= 1 << 62:
        return n * x.astype(object) - np.array(sums.tolist(), object)
    return n * x - sums


def centred(n: int, sums: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (whole(n, sums, x) / n).astype(np.float64)


def deviations(offset: np.ndarray) -> pa.Array:
    """Sums of squares of whole numbers; NULL beyond a long."""
    most = max(int(np.abs(offset).max(initial=0)), 1)
    if most * most * max(offset.shape[1], 1) < 1 << 63:
        return pa.array((offset.astype(np.int64) ** 2).sum(axis=1), pa.int64())
    exact = (offset.astype(object) ** 2).sum(axis=1).tolist()
    return pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Rows of a batch by the length of their vectors, with the vectors as a matrix."""
    lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths).tolist():
        own = batch.filter(pa.array(lengths == dim))
        flat = own.column(column).flatten().to_numpy(zero_copy_only=False)
        yield dim, own, flat.reshape(own.num_rows, dim)


def _sums(vectors: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Number of vectors of each length and their sum by dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for dim, own, x in _parts(batch, "x"):
                n, sums = held.get(dim, (0, np.zeros(dim, np.int64)))
                held[dim] = n + own.num_rows, sums + x.sum(axis=0)
        for dim, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
                 pa.array([n] * dim, pa.int64()), pa.array(sums, pa.int64())],
                names=["dim", "i", "n", "s"],
            )

    rows = (
        vectors.mapInArrow(add, "dim int, i int, n bigint, s bigint")
        .groupBy("dim", "i")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        .collect()
    )
    out: dict[int, tuple[int, np.ndarray]] = {}
    for row in rows:
        out.setdefault(row["dim"], (row["n"], np.zeros(row["dim"], np.int64)))[1][row["i"]] = row["s"]
    return out


def _second_moments(vectors: DataFrame, made) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Sums and sums of products of ``made(dim, x)``, by the vectors' length.

    One partial matrix leaves each task; equal places are added up after the shuffle.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for dim, _, x in _parts(batch, "x"):
                own = made(dim, x)
                if own is None:
                    continue
                total = held.setdefault(dim, [0.0, 0.0])
                total[0] = total[0] + own.sum(axis=0)
                total[1] = total[1] + own.T @ own
        for dim, (sums, products) in held.items():
            i, j = np.triu_indices(len(sums))
            first = np.arange(len(sums))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(first) + len(i), dim), pa.int32()),
                    pa.array(np.concatenate([np.full(len(first), -1), i]), pa.int32()),
                    pa.array(np.concatenate([first, j]), pa.int32()),
                    pa.array(np.concatenate([sums, products[i, j]]), pa.float64()),
                ],
                names=["dim", "i", "j", "s"],
            )

    rows = (
        vectors.mapInArrow(add, "dim int, i int, j int, s double")
        .groupBy("dim", "i", "j")
        .agg(F.sum("s").alias("s"))
        .collect()
    )
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    width: dict[int, int] = {}
    for row in rows:
        width[row["dim"]] = max(width.get(row["dim"], 0), row["j"] + 1)
    for row in rows:
        n = width[row["dim"]]
        sums, products = out.setdefault(row["dim"], (np.zeros(n), np.zeros((n, n))))
        if row["i"] < 0:
            sums[row["j"]] = row["s"]
        else:
            products[row["i"], row["j"]] = products[row["j"], row["i"]] = row["s"]
    return out


def fit(vectors: DataFrame, components: int) -> dict[int, Fit]:
    """Fits by vector length over a column ``x`` of distinct whole vectors."""
    totals = _sums(vectors)
    moments = _second_moments(vectors, lambda dim, x: centred(*totals[dim], x) if dim else None)
    fits, residue = {}, {}
    for dim, (sums, products) in moments.items():
        n, exact = totals[dim]
        # The centred vectors' own mean is zero but for rounding; taken out all the same.
        mean = sums / n
        v = products / n - np.outer(mean, mean)
        values, vectors_of = spectrum(v)
        trace = float(np.trace(v))
        some = int((values[:components] > dim * EPS * max(trace, 0.0)).sum())
        if some:
            fits[dim] = Fit(
                n, exact, values[:some], vectors_of[:, :some], values[:some] / trace
            )
            residue[dim] = fits[dim].whiten(mean)

    def whitened(dim: int, x: np.ndarray) -> np.ndarray | None:
        if dim not in fits:
            return None
        own = fits[dim]
        return own.whiten(centred(own.n, own.sums, x)) - residue[dim]

    for dim, (_, products) in _second_moments(vectors, whitened).items():
        own = fits[dim]
        own.identity_error = float(np.abs(products / own.n - np.eye(len(own.values))).max())
    return fits


def whiten(
    rows: DataFrame,
    components: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """One row per vector and component; components are floor(scale * component) + offset."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + offset)
    valid = rows.where(F.col(vector).isNotNull() & finite_vector(F.col(vector))).select(
        F.col(id_column).cast("bigint").alias("vec_id"), x.alias("x")
    )
    fits = fit(stored(valid.select("x").distinct()), components)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own, x in _parts(batch, "x"):
                if dim not in fits:
                    continue
                known = fits[dim]
                count = len(known.values)
                exact = whole(known.n, known.sums, x)
                white = known.whiten((exact / known.n).astype(np.float64))
                each = pa.array(np.repeat(np.arange(len(x)), count))
                size = len(x) * count
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("vec_id").take(each),
                        pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                        pa.array(np.full(size, known.n), pa.int64()),
                        deviations(exact).take(each),
                        pa.array(white.ravel(), pa.float64()),
                        pa.array(np.tile(known.explained, len(x)), pa.float64()),
                        pa.array(np.full(size, known.identity_error), pa.float64()),
                    ],
                    names=[c.split()[0] for c in WHITE.split(",")],
                )

    return valid.mapInArrow(project, WHITE)
