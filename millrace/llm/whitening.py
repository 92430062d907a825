"""Whitening: exact sums and a centred covariance on Spark, its largest components by contour integration, projections.

What reaches the driver has the size of the covariance, one row a dimension, whatever the number of vectors.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import feast
from millrace.llm.common import ship

#: A vector's entries become whole numbers floor(STEPS * c) + SHIFT.
STEPS, SHIFT = 1024, 100_000
#: Entries are below this, so that their whole numbers are exact in a double.
LARGEST = 2.0 ** 42


@dataclass(frozen=True)
class Whitening:
    """n vectors with their sums; falling eigenvalues of their covariance, components as columns, its trace, and the largest
    entry by which the covariance of the whitened vectors departs from the identity."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = float("nan")

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of the mean is taken off exactly, the rest as a double."""
        return (x - self.whole) - self.rest / self.n

    def white(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; None where one does not fit a long."""
        size = ((self.n * np.abs((x - self.whole).astype(float)) + self.n) ** 2).sum(axis=1)
        near = [int(v) for v in ((self.n * (x - self.whole) - self.rest) ** 2).sum(axis=1)]
        for i in np.flatnonzero(size >= 2.0 ** 62):
            exact = sum((self.n * int(c) - s) ** 2 for c, s in zip(x[i], self.sums))
            near[i] = exact if exact < 2 ** 63 else None
        return near


def usable(vector: Column) -> Column:
    """A vector without null or non-finite entries, or any too large for exact whole numbers."""
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)) & ~F.isnan(c))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def matrix_of(column: pa.Array, dimension: int) -> np.ndarray:
    """A column of lists of equal length as whole numbers, one row a vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.floor(STEPS * flat).astype(np.int64).reshape(-1, dimension) + SHIFT


def dimension_of(vectors: DataFrame, vector_col: str) -> int:
    """The length that most usable vectors have; of equally common ones the smallest; 0 without any."""
    sizes = vectors.where(usable(F.col(vector_col))).groupBy(F.size(vector_col).alias("size")).count()
    first = sizes.orderBy(F.desc("count"), "size").first()
    return first["size"] if first else 0


def fitting(vectors: DataFrame, vector_col: str, dimension: int) -> DataFrame:
    return vectors.where(usable(F.col(vector_col)) & (F.size(vector_col) == dimension))


def task_sums(rows: DataFrame, vector_col: str, dimension: int, width: int, part, kind: str) -> list[tuple]:
    """Sums over all vectors of part(x), a table of `width` columns: each task adds its own up, Spark the tasks'."""
    ship(rows.sparkSession)
    arrow = pa.int64() if kind == "long" else pa.float64()

    def run(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                one = part(matrix_of(batch.column(0).slice(at, 4096), dimension))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(len(total)), pa.int32()),
                pa.FixedSizeListArray.from_arrays(pa.array(total.ravel(), arrow), width).cast(pa.list_(arrow))], names=["i", "row"])

    made = rows.select(vector_col).mapInArrow(run, f"i int, row array<{kind}>")
    exact = "decimal(38,0)" if kind == "long" else "double"
    return [tuple(r) for r in made.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j")
            .agg(F.sum(F.col("v").cast(exact))).collect()]


def square(cells: list[tuple], size: int) -> np.ndarray:
    out = np.zeros((size, size))
    for i, j, v in cells:
        out[i, j] = v
    return out


def fit(vectors: DataFrame, vector_col: str = "embedding", most: int = 8) -> Whitening | None:
    """Whitening of the `most` largest components over all usable vectors of the commonest length; None without vectors.

    Components whose eigenvalue is of rounding size are left out: nothing can be scaled to one there.
    """
    spark = vectors.sparkSession
    dimension = dimension_of(vectors, vector_col)
    if not dimension:
        return None
    rows = fitting(vectors, vector_col, dimension)
    cells = {j: int(v) for _, j, v in task_sums(
        rows, vector_col, dimension, dimension + 1,
        lambda x: np.append(x.sum(axis=0), len(x))[None, :], "long")}
    n, sums = cells[dimension], tuple(cells[j] for j in range(dimension))
    bare = Whitening(n, sums, np.zeros(0), np.zeros((dimension, 0)), 0.0)

    def products(x):
        y = bare.centred(x)
        return y.T @ y

    covariance = square(task_sums(rows, vector_col, dimension, dimension, products, "double"), dimension) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, components = feast.largest(spark, covariance, most) if trace > 0 else (np.zeros(0), np.zeros((dimension, 0)))
    real = values > dimension * feast.EPS * max(values.max(initial=0), 0)
    made = Whitening(n, sums, values[real], components[:, real], trace)
    k = int(real.sum())
    if not k:
        return made

    def moments(x):
        w = np.hstack([made.white(x), np.ones((len(x), 1))])
        return w.T @ w

    total = square(task_sums(rows, vector_col, dimension, k + 1, moments, "double"), k + 1) / n
    error = np.abs(total[:k, :k] - np.outer(total[k, :k], total[k, :k]) - np.eye(k)).max()
    return Whitening(n, sums, made.values, made.components, trace, float(error))


def whiten(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each usable vector and component.

    Vectors that are null or empty, or hold null, non-finite or very large (2^42) entries, or have another length than
    the model give no rows; so do all where there is no component (no vectors, or all alike). Repeated rows and ids give
    rows of their own, a null id stays null; `deviation` is null where it does not fit a long. Other columns are not
    looked at.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    ship(vectors.sparkSession)
    dimension, k = model.components.shape
    explained = model.values / model.trace

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = matrix_of(part.column(1), dimension)
                rows = np.repeat(np.arange(len(x)), k)
                deviation = pa.array(model.deviations(x), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(rows), model.n), pa.int64()), deviation.take(pa.array(rows)),
                    pa.array(model.white(x).ravel()), pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(rows), model.identity_error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fitting(vectors, vector_col, dimension).select(id_col, vector_col).mapInArrow(run, schema)
