"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The rows are vectors of whole numbers; the fit list holds each distinct vector
once, as a table in the shared folder.  X is that list with the mean of each
dimension taken off.  Step j multiplies in one pass over the table

    y = X v_j - beta_{j-1} u_{j-1}   and   X'y,

where u_1, u_2, ... are never kept: u_i = X c_i, with c_i a vector of as many
numbers as there are dimensions, so every task makes them anew from its own rows.
The pass also sums u_i'y for all earlier u_i.  With these y is made orthogonal to
all of them, and X'y to all earlier v_i, twice.  A step that leaves nothing goes
on with another vector, so repeated deviations come out as often as they occur.
After as many steps as there are dimensions the bidiagonal matrix has the
singular values of X; its small SVD turns the v_i into the components.

What comes to the driver are sums of as many numbers as a vector has, for each
step; what is sent out are square matrices of that size.  Every task depends on
its rows alone.

Rows whose vector is null, empty or holds null or non-finite numbers are left
out, also those of another length than most vectors have (the greater of two as
frequent lengths).  Repeated rows count once in the fit and are all whitened;
rows without an id are whitened too.  Components along which nothing deviates
(eigenvalue below ``FLAT`` of the first) are left out, so a table of one distinct
vector, or an empty one, gives no rows.  A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import stored

SCALE = 256
COMPONENTS = 4
FLAT = 1e-12
NOTHING = 1e-10  # what orthogonalisation leaves of a vector that lies in the space of the others
ROWS_AT_ONCE = 4096
SEED = 20


@dataclass(frozen=True)
class Model:
    """Sums and components of a fit list; ``values`` are the eigenvalues of its covariance."""

    n: int
    sums: list[int]
    components: np.ndarray  # a row per component
    values: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array(self.sums, np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components.T / np.sqrt(self.values)


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """Each entry times ``scale``, rounded down, as a long; null where an entry is null or not finite."""
    doubles = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(finite & (F.size(vector) > 0), F.transform(doubles, lambda c: F.floor(scale * c)))


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a column as rows; all have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(rows: DataFrame, partial: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of the numbers that ``partial`` gives for some of them."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                total += partial(_matrix(batch.column(0).slice(start, ROWS_AT_ONCE)).astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["slot", "value"])

    parts = rows.select("x").mapInArrow(made, "slot long, value double")
    sums = np.zeros(size)
    for row in parts.groupBy("slot").agg(F.sum("value").alias("value")).collect():
        sums[row.slot] = row.value
    return sums


def _dimension_sums(rows: DataFrame) -> list[int]:
    """Exact sums per dimension."""
    total = F.sum(F.col("value").cast("decimal(28,0)")).alias("total")
    each = rows.select(F.posexplode("x").alias("slot", "value")).groupBy("slot").agg(total)
    return [int(row.total) for row in each.orderBy("slot").collect()]


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What is left of a vector beside the rows of a basis; taken off twice, against rounding."""
    for _ in range(2):
        vector = vector - basis.T @ (basis @ vector)
    return vector


def _another(basis: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """A unit vector that is orthogonal to the rows of a basis."""
    while True:
        made = _orthogonal(random.standard_normal(basis.shape[1]), basis)
        if np.linalg.norm(made) > 1e-3:
            made = _orthogonal(made / np.linalg.norm(made), basis)
            return made / np.linalg.norm(made)


def bidiagonalised(rows: DataFrame, mean: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray]:
    """The vectors v as rows, and the upper bidiagonal matrix B with X V' = U B.

    ``total`` is the sum of all squares in X; it says what counts as nothing.
    """
    d, random, scale = len(mean), np.random.default_rng(SEED), np.sqrt(total)
    v, c = np.zeros((0, d)), np.zeros((0, d))  # u_i = X c_i
    back = np.zeros((0, d))  # X'u_i
    b = np.zeros((d, d))
    following, beta = _another(v, random), 0.0
    for j in range(d):
        v = np.vstack([v, following])
        made_of = following - (beta * c[j - 1] if j else 0.0)

        def both_products(x: np.ndarray, made_of=made_of, earlier=c.T) -> np.ndarray:
            x = x - mean
            y = x @ made_of
            return np.concatenate([x.T @ y, (x @ earlier).T @ y, [y @ y]])

        sums = _summed(rows, both_products, d + j + 1)
        xy, along, squares = sums[:d], sums[d:-1], sums[-1]
        made_of, xy = made_of - along @ c, xy - along @ back
        alpha = np.sqrt(max(squares - along @ along, 0.0))
        if alpha <= NOTHING * scale:
            alpha, made_of, xy = 0.0, np.zeros(d), np.zeros(d)
        else:
            made_of, xy = made_of / alpha, xy / alpha
        c, back, b[j, j] = np.vstack([c, made_of]), np.vstack([back, xy]), alpha
        if j + 1 < d:
            left = _orthogonal(xy - alpha * v[j], v)
            beta = np.linalg.norm(left)
            if beta <= NOTHING * scale:
                following, beta = _another(v, random), 0.0
            else:
                following = _orthogonal(left / beta, v)
                following /= np.linalg.norm(following)
            b[j, j + 1] = beta
    return v, b


def fit(listed: DataFrame, components: int = COMPONENTS) -> Model | None:
    """Fit to the vectors ``x`` (arrays of longs of one length); None if nothing deviates."""
    n = listed.count()
    if not n:
        return None
    sums = _dimension_sums(listed)
    mean = np.array(sums, np.float64) / n
    total = float(_summed(listed, lambda x: np.array([((x - mean) ** 2).sum()]), 1)[0])
    if total == 0.0:
        return None
    v, b = bidiagonalised(listed, mean, total)
    _, deviations, turned = np.linalg.svd(b)
    values = deviations**2 / n
    count = min(components, int((values > FLAT * values[0]).sum()))
    return Model(n, sums, turned[:count] @ v, values[:count], total / n)


def identity_error(listed: DataFrame, model: Model) -> float:
    """The largest entry by which the covariance of the whitened fit list misses the identity."""
    k = len(model.values)
    middle = _summed(listed, lambda x: model.whitened(x).sum(0), k) / model.n

    def squares(x: np.ndarray) -> np.ndarray:
        y = model.whitened(x) - middle
        return (y.T @ y).ravel()

    covariance = _summed(listed, squares, k * k).reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def _exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Of each row the sum over dimensions of (n x - S)^2, null beyond a long."""
    rough = ((n * x.astype(np.float64) - np.array(sums, np.float64)) ** 2).sum(1)
    if rough.max(initial=0) < 2.0**62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return [value if value < 1 << 63 else None for value in exact]


def whiten(embeddings: DataFrame, vector: str, key: str, components: int = COMPONENTS) -> DataFrame:
    """A row per row and component: key, component, n, deviation, whitened, explained, identity_error."""
    schema = (
        "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    names = [field.split()[0] for field in schema.split(", ")]
    rows = embeddings.select(F.col(key).cast("long").alias("key"), whole_numbers(F.col(vector)).alias("x"))
    rows = rows.where("x IS NOT NULL")
    lengths = rows.groupBy(F.size("x").alias("size")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.where(F.size("x") == (usual["size"] if usual else 0))
    listed = stored(rows.select("x").distinct(), "whitening-fit")
    model = fit(listed, components)
    if model is None:
        empty = embeddings.sparkSession.createDataFrame([], schema)
        return empty.withColumnRenamed("key", key)
    error = identity_error(listed, model)
    sums, k, explained = model.sums, len(model.values), model.values / model.trace

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(start, ROWS_AT_ONCE)
                x, count = _matrix(some.column(1)), some.num_rows
                deviation = pa.array(_exact_deviation(x, model.n, sums), pa.int64())
                each = pa.array(np.repeat(np.arange(count), k))
                arrays = [
                    some.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, model.n, np.int64)),
                    deviation.take(each),
                    pa.array(model.whitened(x.astype(np.float64)).ravel()),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(count * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(made, schema).withColumnRenamed("key", key)
