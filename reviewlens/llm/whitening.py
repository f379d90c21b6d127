"""Whitening of embeddings by the eigenvectors of their covariance, refined from single precision."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.session import stage

#: Refinement stops when a step changes less than this, or after so many steps; each step squares the error.
TOLERANCE, STEPS = 1e-18, 12
_WIDE = np.longdouble
BLOCK = 4096  # vectors that a task multiplies at once


def finite_vectors(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    unsound = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(unsound, F.lit(True))


def _whole(df: DataFrame, vector: str) -> bool:
    return df.schema[vector].dataType.elementType.typeName() in ("byte", "short", "integer", "long")


@dataclass(frozen=True)
class Whitening:
    """What is learned from the fit list; all arrays depend on the dimension only.

    ``sums`` are exact Python integers where the vectors are integers. ``components`` holds a unit eigenvector in
    each column, by falling ``eigenvalues``; ``trace`` is the sum of all eigenvalues.
    """

    n: int
    sums: list
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of a batch as rows; integers stay integers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _exact_deviations(x: np.ndarray, n: int, sums: list) -> list:
    """Sum over dimensions of ``(n * x - sum)^2`` per row in whole numbers; null where it exceeds a long."""
    dim, largest = len(sums), max(abs(s) for s in sums) if sums else 0
    bound = n * int(np.abs(x).max(initial=0)) + largest
    if bound < 2**63:
        gaps = x * n - np.array(sums, np.int64)
        if int(np.abs(gaps).max(initial=0)) ** 2 * max(dim, 1) < 2**63:
            return (gaps * gaps).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [e if e < 2**63 else None for e in exact]


def _products(vector: str, dim: int, mean: np.ndarray, project: np.ndarray | None):
    """Per task, the sum of outer products of its vectors less ``mean``, projected if asked; one row per row of it."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = dim if project is None else project.shape[1]
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch[vector], dim)
            for start in range(0, len(x), BLOCK):
                y = x[start : start + BLOCK].astype(np.float64) - mean
                y = y if project is None else y @ project
                total += y.T @ y
        rows = pa.ListArray.from_arrays(np.arange(0, width * width + 1, width, dtype=np.int32), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), rows], ["i", "entries"])

    return products


def _summed(points: DataFrame, vector: str, dim: int, n: int, mean: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the points less ``mean``: partial products are added in Spark, entry by entry."""
    partial = points.select(vector).mapInArrow(_products(vector, dim, mean, project), "i int, entries array<double>")
    entries = partial.select("i", F.posexplode("entries").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    width = dim if project is None else project.shape[1]
    out = np.zeros((width, width))
    out[entries["i"].to_numpy(), entries["j"].to_numpy()] = entries["v"].to_numpy()
    return (out + out.T) / (2 * n)


def _clusters(values: np.ndarray, gap) -> list[np.ndarray]:
    """Runs of at least two eigenvalues, in falling order, whose neighbours are not ``gap`` apart."""
    cuts = np.flatnonzero(values[:-1] - values[1:] > gap) + 1
    return [run for run in np.split(np.arange(len(values)), cuts) if len(run) > 1]


def refine(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors of a symmetric matrix from approximate ``vectors``.

    Steps of Ogita and Aishima: with R = I - X'X and S = X'AX, eigenvalues are S_ii / (1 - R_ii) and X grows by XE,
    where E_ij = (S_ij + l_j R_ij) / (l_j - l_i). Pairs of eigenvalues that the errors do not tell apart only
    get orthogonal, E_ij = R_ij / 2; the eigenvectors of such a cluster are found by a sub-solve: an eigenproblem
    of the cluster's size, shifted by its mean so that the small differences keep their digits. All products are
    in extended precision where the machine has it.
    """
    a, x = matrix.astype(_WIDE), vectors.astype(_WIDE)
    dim = len(a)
    eye, size = np.eye(dim, dtype=_WIDE), np.abs(a).sum(axis=0).max(initial=0)
    values, before = np.zeros(dim, _WIDE), np.inf
    for _ in range(STEPS):
        rest = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2  # else rounding, divided by small gaps, spoils orthogonality
        values = np.diag(s) / (1 - np.diag(rest))
        order = np.argsort(-values, kind="stable")
        x, rest, s, values = x[:, order], rest[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        off = s - np.diag(values)
        blur = 2 * (np.linalg.norm(off.astype(np.float64)) + size * np.linalg.norm(rest.astype(np.float64)))
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > blur
        step = np.where(apart, (s + values[None, :] * rest) / np.where(apart, gaps, 1), rest / 2)
        np.fill_diagonal(step, np.diag(rest) / 2)
        x = x + x @ step
        change = float(np.abs(step).max(initial=0))
        runs = _clusters(values, blur)
        for run in runs:
            part = x[:, run]
            middle = values[run].mean()
            inner = part.T @ (a @ part - middle * part)
            _, turn = np.linalg.eigh(((inner + inner.T) / 2).astype(np.float64))
            x[:, run] = part @ turn[:, ::-1].astype(_WIDE)
        if change <= TOLERANCE or (change >= before and not runs):
            break
        before = change
    x = x / np.sqrt((x * x).sum(axis=0))
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return values[order].astype(np.float64), x[:, order].astype(np.float64)


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors: a single-precision solve, refined.

    The matrix is scaled to a largest entry of one first, so that single precision neither overflows nor vanishes.
    """
    scale = float(np.abs(matrix).max(initial=0)) or 1.0
    scaled = matrix / scale
    _, rough = np.linalg.eigh(scaled.astype(np.float32))
    values, vectors = refine(scaled, rough[:, ::-1].astype(np.float64))
    return values * scale, vectors


def fit(points: DataFrame, vector: str = "vector") -> tuple[Whitening, DataFrame]:
    """The whitening learned from the distinct vectors of ``points``, and these vectors as a written table.

    All vectors have one length, see ``whiten``. Counts, sums and products of centred vectors are added in Spark;
    the driver gets matrices of the dimension only and solves the eigenproblem. Components whose eigenvalue is
    within rounding of zero cannot be scaled to one and are left out.
    """
    listed = stage(points.select(vector).distinct(), "fit-list")
    whole = _whole(listed, vector)
    exact = F.sum(F.col("v").cast("decimal(38,0)" if whole else "double"))
    rows = listed.select(F.posexplode(vector).alias("j", "v")).groupBy("j").agg(exact.alias("s"), F.count("v").alias("n")).collect()
    rows.sort(key=lambda r: r["j"])
    n = rows[0]["n"] if rows else 0
    sums = [int(r["s"]) if whole else r["s"] for r in rows]
    dim = len(sums)
    covariance = _summed(listed, vector, dim, n, np.array([s / n for s in sums])) if dim else np.zeros((0, 0))
    values, vectors = eigen(covariance)
    sound = values > dim * np.finfo(np.float64).eps * values.max(initial=0)
    return Whitening(n, sums, vectors[:, sound], values[sound], float(np.trace(covariance))), listed


def identity_error(listed: DataFrame, model: Whitening, components: int, vector: str = "vector") -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity; 0 without components."""
    scaled = (model.components / np.sqrt(model.eigenvalues))[:, :components]
    if not scaled.size:
        return 0.0
    mean = np.array([s / model.n for s in model.sums])
    return float(np.abs(_summed(listed, vector, model.dim, model.n, mean, scaled) - np.eye(scaled.shape[1])).max())


def _whitened(id_col: str, vector: str, model: Whitening, components: int, whole: bool) -> Callable:
    mean = np.array([s / model.n for s in model.sums]) if model.n else np.zeros(0)
    scaled = (model.components / np.sqrt(model.eigenvalues))[:, :components]
    width = scaled.shape[1]

    def whitened(batches):
        for batch in batches:
            x = _matrix(batch[vector], model.dim)
            out = (x.astype(np.float64) - mean) @ scaled
            far = _exact_deviations(x, model.n, model.sums) if whole else ((x * model.n - np.array(model.sums)) ** 2).sum(axis=1)
            offsets = np.arange(0, len(x) * width + 1, width, dtype=np.int32) if width else np.zeros(len(x) + 1, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch[id_col],
                    pa.array(far, pa.int64() if whole else pa.float64()),
                    pa.ListArray.from_arrays(offsets, pa.array(out.ravel(), pa.float64())),
                ],
                [id_col, "deviation", "whitened"],
            )

    return whitened


def whiten(df: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "vector") -> tuple[DataFrame, Whitening, float]:
    """``(id, deviation, whitened)`` of every sound row, the model, and its identity error.

    ``whitened`` is an array: the vector less the mean, projected on the first ``components`` eigenvectors of the
    covariance and divided by the roots of their eigenvalues. Repeated vectors count once in the mean and the
    covariance and are all whitened. ``deviation`` is n squared times the squared distance from the mean, exact for
    whole numbers, and null where it exceeds a long.

    Rows whose vector is null or empty, or holds a null or non-finite entry, are left out, as are rows whose
    vector has another length than most (of equally frequent lengths, the larger one counts). A null id stays null;
    rows that repeat an id give a row each. Other columns are not read. An empty table gives an empty result.
    Tied eigenvalues leave their components free within the shared space; one choice is used for all rows.
    """
    vector = F.col(vector_col)
    sound = df.select(id_col, vector.alias("vector")).filter(finite_vectors(vector) & (F.size(vector) > 0))
    lengths = sound.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    sound = sound.filter(F.size("vector") == (lengths[0]["d"] if lengths else 0))
    model, listed = fit(sound)
    whole = _whole(sound, "vector")
    out = f"{df.select(id_col).schema.simpleString()[7:-1]}, deviation {'long' if whole else 'double'}, whitened array<double>"
    error = identity_error(listed, model, components)
    return sound.mapInArrow(_whitened(id_col, "vector", model, components, whole), out), model, error
