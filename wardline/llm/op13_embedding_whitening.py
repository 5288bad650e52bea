"""Whitening of embeddings by shifted CholeskyQR (operator 13).

Vectors are put on a grid (whole multiples of 1 / ``SCALE``), so that counts, sums and
deviations are exact.  The fit list holds each distinct vector once.

The centred fit list A is orthogonalised by passes over it: a pass solves the triangular
systems of the factors found so far in its tasks and adds up the Gram matrix Q'Q, d x d
numbers whatever the number of rows.  Its Cholesky factor, taken of a shifted matrix while
Q is far from orthogonal, joins the product R, and the next pass starts from A again.  Two
or three passes give A = QR to double precision where a single Gram matrix would lose half
the digits.  The SVD of R has the components as its right vectors and sqrt(n e) as its
values.

Where A has fewer independent columns than dimensions, Q'Q cannot become the identity.  As
A'A = R'(Q'Q)R holds whatever Q is, the SVD is of the square root of the last Q'Q times R,
and directions without variance come out with no variance.

Defined cases: rows whose vector is null, empty, or has null or non-finite entries are left
out; so are those whose length is not the most frequent one (the smallest of such).
Repeated rows are given out as often as they come and fitted once.  Directions without
variance are no components, so there may be fewer than asked for; an empty table, or one
vector only, gives no rows.  Rows with a null ``vec_id`` are rows like others.  Deviations of
2^63 and more raise an error.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.words import in_batches
from wardline.storage import materialize

SCALE = 256
COMPONENTS = 4
MOST_PASSES = 6
NEAR = 1e-13  # of Q'Q to the identity
NOTHING = 1e-9  # of the largest singular value: below it a direction has no variance


def on_grid(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the usable vectors in whole multiples of 1 / ``scale``, rounded down."""
    finite = F.forall("embedding", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c))
    usable = vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    lengths = usable.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "d").first()
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    return usable.filter(F.size("embedding") == (usual["d"] if usual else 0)).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """One row per vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def summed(vectors: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum of the arrays that ``part`` makes of matrices of vectors, cell by cell.

    Each task adds up its own and gives one row per cell, whatever the number of vectors.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                got = part(_matrix(batch.column(0))).ravel()
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["cell", "v"])

    parts = vectors.select("x").transform(in_batches, add, f"cell int, v {kind}")
    rows = parts.groupBy("cell").agg(F.sum("v").alias("v")).collect()
    found = np.zeros(len(rows), np.int64 if kind == "long" else np.float64)
    for row in rows:
        found[row["cell"]] = row["v"]
    return found


def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``a`` times the inverse of the upper triangular ``r``, column by column."""
    q = np.empty_like(a)
    for j in range(a.shape[1]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular R with R'R = gram, of the matrix with a shift if it needs one."""
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.trace(gram)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


@dataclass(frozen=True)
class Whitening:
    """n and S of the fit list, and per component its variance, its share of all, and its direction."""

    n: int
    sums: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    components: np.ndarray  # a column each

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - self.sums / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n x - S)^2, in whole numbers."""
        furthest = int(np.abs(x).max(initial=0)) * self.n + int(np.abs(self.sums).max(initial=0))
        if furthest**2 * x.shape[1] < 1 << 63:
            return ((self.n * x - self.sums) ** 2).sum(axis=1)
        sums = [int(s) for s in self.sums]
        exact = [sum((self.n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
        return np.array(exact, np.int64)  # raises an error where one does not fit


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a written fit list; None where nothing varies."""
    counted = summed(distinct, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    if not len(counted):
        return None
    sums, n = counted[:-1], int(counted[-1])
    mean, d = sums / n, len(sums)
    r, gram = np.eye(d), None
    factors: list[np.ndarray] = []
    for k in range(MOST_PASSES):
        held = list(factors)

        def part(x: np.ndarray, held: list[np.ndarray] = held) -> np.ndarray:
            q = x - mean
            for factor in held:
                q = solved(q, factor)
            return q.T @ q

        gram = summed(distinct, part, "double").reshape(d, d)
        gram = (gram + gram.T) / 2
        if not np.trace(gram):
            return None
        if k and (np.abs(gram - np.eye(d)).max() <= NEAR or k == MOST_PASSES - 1):
            break
        factors.append(_factor(gram, n, shifted=k == 0))
        r = factors[-1] @ r
    values, vectors = np.linalg.eigh(gram)
    root = vectors * np.sqrt(np.maximum(values, 0)) @ vectors.T
    _, singular, rows = np.linalg.svd(root @ r)
    many = int((singular[:components] > NOTHING * singular[0]).sum())
    e = singular**2 / n
    return Whitening(n, sums, e[:many], (e / e.sum())[:many], rows[:many].T)


def whitening(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Per usable row and component: (vec_id, component, n, deviation, whitened, explained, identity_error).

    ``identity_error`` is measured over the fit list: the largest entry of the whitened
    vectors' covariance minus the identity.
    """
    grid = on_grid(vectors, scale)
    distinct = materialize(grid.select("x").distinct(), "vectors")
    ddl = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = fit(distinct, components)
    if found is None:
        return vectors.sparkSession.createDataFrame([], ddl)
    many = len(found.variances)

    def products(x: np.ndarray) -> np.ndarray:
        w = found.whitened(x)
        return np.append(w.T @ w, w.sum(axis=0))

    cells = summed(distinct, products, "double") / found.n
    covariance = cells[: many * many].reshape(many, many) - np.outer(cells[many * many :], cells[many * many :])
    error = float(np.abs(covariance - np.eye(many)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = _matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(rows), many))),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * many, found.n)),
                    pa.array(np.repeat(found.deviations(x), many)),
                    pa.array(found.whitened(x).ravel()),
                    pa.array(np.tile(found.explained, rows)),
                    pa.array(np.full(rows * many, error)),
                ],
                names=[f.split()[0] for f in ddl.split(", ")],
            )

    return grid.select(F.col("vec_id").cast("long"), "x").transform(in_batches, project, ddl)
