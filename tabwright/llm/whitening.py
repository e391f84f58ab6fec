"""Whitening of embeddings: components from the triangular factor of shifted CholeskyQR."""

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000  # entry c becomes floor(SCALE * c) + OFFSET
CELLS = 1 << 20  # entries handled at once inside a task
ROUND = 2.0**-53
LARGEST = 2.0**52  # entries from here on have no exact whole number
MAX_PASSES = 8


def whole_vectors(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Bounded runs of usable rows of equal length: (row numbers, vectors as whole numbers, batch)."""
    for batch in batches:
        lists = batch.column(column)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.cast(lists.flatten(), pa.float64()).to_numpy(zero_copy_only=False)  # a null entry is not a number
        starts = np.cumsum(lengths) - lengths
        for dim in np.unique(lengths[lengths > 0]).tolist():
            rows, step = np.flatnonzero(lengths == dim), max(1, CELLS // dim)
            for i in range(0, len(rows), step):
                part = rows[i : i + step]
                scaled = np.floor(SCALE * flat[starts[part][:, None] + np.arange(dim)])
                good = (np.abs(scaled) < LARGEST).all(axis=1)
                if good.any():
                    yield part[good], scaled[good].astype(np.int64) + OFFSET, batch


def solve_right(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """x times the inverse of the upper triangle r, column after column."""
    q = np.empty_like(x)
    for j in range(x.shape[1]):
        q[:, j] = (x[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


@dataclass
class Whitening:
    """What a fit knows: number of vectors, sums per dimension, components (columns) by falling eigenvalue, and the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passes: int = 0

    @property
    def rank(self) -> int:
        """Components whose eigenvalue is more than rounding."""
        return int((self.eigenvalues > len(self.sums) * 2 * ROUND * self.trace).sum())

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - sum)^2, exact; null beyond 64 bits."""
        mean, rest = np.divmod(self.sums, self.n)
        off = x - mean
        if len(off) and (float(np.abs(off).max()) + 1) ** 2 * float(self.n) ** 2 * x.shape[1] < 2.0**62:
            return ((self.n * off - rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * off.astype(object) - rest.astype(object)) ** 2).sum(axis=1).tolist()
        return [d if d < 2**63 else None for d in exact]

    def project(self, centred: np.ndarray, k: int) -> np.ndarray:
        """The first k whitened coordinates; those of components without variance are not a number."""
        with np.errstate(divide="ignore", invalid="ignore"):
            width = np.where(np.arange(k) < self.rank, np.sqrt(self.eigenvalues[:k]), np.nan)
            return centred @ self.components[:, :k] / width


def centre(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n; whole parts are subtracted exactly."""
    mean, rest = np.divmod(sums, n)
    return (x - mean) - rest / n


def _gram(vectors: DataFrame, vec: str, dim: int, transform: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of y'y over all rows, y being the transformed row; each task sends one upper triangle, summed in Spark."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x, _ in whole_vectors(batches, vec):
            if x.shape[1] == dim:
                y = transform(x)
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]})

    cells = vectors.select(vec).mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # dim^2 / 2
    size = 1 + max((r["j"] for r in cells), default=-1)
    out = np.zeros((size, size))
    for r in cells:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def _sums(vectors: DataFrame, vec: str) -> tuple[int, np.ndarray]:
    """Number of usable vectors of the commonest length (ties: the shorter) and their sums per dimension."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for _, x, _ in whole_vectors(batches, vec):
            n, total = found.get(x.shape[1], (0, 0))
            found[x.shape[1]] = (n + len(x), total + x.sum(axis=0))
        for dim, (n, total) in found.items():
            yield pa.RecordBatch.from_pydict({"dim": [dim] * dim, "j": list(range(dim)), "n": [n] * dim, "s": total.tolist()}, schema=pa.schema([("dim", pa.int32()), ("j", pa.int32()), ("n", pa.int64()), ("s", pa.int64())]))

    totals = vectors.select(vec).mapInArrow(run, "dim int, j int, n long, s long").groupBy("dim", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    found = totals.groupBy("dim").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("j", "s"))).alias("s")).orderBy(F.desc("n"), "dim").first()
    return (0, np.zeros(0, np.int64)) if found is None else (found["n"], np.array([c["s"] for c in found["s"]], np.int64))


def fit_whitening(vectors: DataFrame, vec: str = "embedding") -> Whitening | None:
    """Components of the covariance of all usable vectors by shifted CholeskyQR; None if there are none.

    With A the centred rows, each pass sums the Gram matrix of A R1^-1 … Rk^-1 over all rows and factors it. The first
    one is shifted by the rounding error of the sum, so it has a factor however ill-conditioned A is; further passes
    repeat until the rows are orthonormal to rounding. Directions without variance stay zero, and with them the
    shift. With G the last Gram matrix, the singular values and right vectors of sqrt(G) Rk … R1 are those of A.
    """
    n, sums = _sums(vectors, vec)
    if n == 0:
        return None
    dim, composed = len(sums), np.eye(len(sums))
    factors: list[np.ndarray] = []
    for step in range(MAX_PASSES + 1):
        chain = list(factors)

        def orthogonalised(x: np.ndarray, chain: Sequence[np.ndarray] = chain) -> np.ndarray:
            y = centre(x, n, sums)
            for r in chain:
                y = solve_right(y, r)
            return y

        gram = _gram(vectors, vec, dim, orthogonalised)
        values, turn = np.linalg.eigh(gram)
        error = 11 * (n * dim + dim * (dim + 1)) * ROUND  # of the sum, relative to its largest eigenvalue
        singular = step == 0 or values[0] < 0.25
        away = np.where(values > 0.5, np.abs(values - 1), np.abs(values)).max()
        if step and (away < (4 * error if singular else 64 * dim * ROUND) or step == MAX_PASSES):
            break
        shift = error * max(values[-1], np.finfo(float).tiny) if singular else 0.0
        factors.append(np.linalg.cholesky(gram + shift * np.eye(dim)).T)
        composed = factors[-1] @ composed
    root = turn @ (np.sqrt(np.maximum(values, 0.0))[:, None] * turn.T)
    _, stretch, right = np.linalg.svd(root @ composed)
    eigenvalues = stretch**2 / n
    return Whitening(n, sums, right.T, eigenvalues, float(eigenvalues.sum()), step)


def whiten(vectors: DataFrame, k: int = 8, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """The first k whitened coordinates of every usable vector: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entry c counts as the whole number floor(1024 c) + 100000. Vectors that are null or empty, hold null or non-finite
    entries or entries of 2^42 and more, or have another length than most (ties: the shorter) take no part; all others
    are fitted. Vectors of fewer than k dimensions have as many components. A component without variance (copies of
    one vector, fewer vectors than dimensions) has a null coordinate and takes no part in identity_error. Null and repeated
    keys are rows like others; other columns are ignored; an empty table gives no rows. The data are read once for the
    sums, once per pass, once for the error and once for the result; the driver holds matrices of the dimension.
    """
    schema = f"{key} {vectors.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = fit_whitening(vectors, vec)
    if fit is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dim, n = len(fit.sums), fit.n
    k = min(k, dim)
    used = min(k, fit.rank)

    def moments(x: np.ndarray) -> np.ndarray:  # a column of ones gives the means as well
        return np.column_stack([np.ones(len(x)), fit.project(centre(x, n, fit.sums), k)[:, :used]])

    gram = _gram(vectors, vec, dim, moments) / n
    error = float(np.abs(gram[1:, 1:] - np.outer(gram[0, 1:], gram[0, 1:]) - np.eye(used)).max(initial=0.0))
    explained = (fit.eigenvalues[:k] / fit.trace if fit.trace > 0 else np.zeros(k)).tolist()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x, batch in whole_vectors(batches, vec):
            if x.shape[1] == dim:
                whitened = fit.project(centre(x, n, fit.sums), k).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).take(pa.array(np.repeat(rows, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(rows) * k, n, np.int64)),
                        pa.array(fit.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                        pa.array(whitened, mask=np.isnan(whitened)),
                        pa.array(explained * len(rows), pa.float64()),
                        pa.array(np.full(len(rows) * k, error)),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.select(key, vec).mapInArrow(run, schema)
