"""Sums of products over all rows, and what is solved from them: the scorecard's Newton steps and principal components.

Each task adds up the products of its own rows; the tasks' sums are added by position, so nothing but sums is shuffled.
What reaches the driver is one number per pair of variables, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow import config
from creditflow.session import stage


def added_up(df: DataFrame, columns: Sequence[str], size: int, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of what ``add`` makes of a block of them: ``size`` numbers from (rows, columns)."""
    schema = pa.schema([("at", pa.int32()), ("part", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += add(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], schema=schema)

    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = rows.mapInArrow(run, "at int, part double").groupBy("at").agg(F.sum("part").alias("whole"))
    out = np.zeros(size)
    for r in parts.collect():
        out[r["at"]] = r["whole"]
    return out


def symmetric(upper: np.ndarray, n: int) -> np.ndarray:
    """The matrix whose upper triangle is given row by row."""
    out = np.zeros((n, n))
    out[np.triu_indices(n)] = upper
    return out + np.triu(out, 1).T


# --- logistic regression -----------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """Coefficients, the constant first, and what is left of the mean gradient."""

    coefficients: np.ndarray
    gradient: float
    steps: int


# A fit is done when no entry of the mean gradient is larger than this.
SMALLEST_GRADIENT = 1e-10
MOST_STEPS = 50
# Directions of the Hessian this much weaker than the strongest are left alone: columns that repeat one another.
WEAKEST_DIRECTION = 1e-10


def patterns(df: DataFrame, variables: Sequence[str], target: str = config.TARGET) -> DataFrame:
    """``n`` and ``bad`` per distinct row of the variables: WOE columns have as many values as bins."""
    known = df.where(F.col(target).isNotNull())
    quoted = [f"`{v}`" for v in variables]
    return known.groupBy(*quoted).agg(F.count("*").alias("__n"), F.sum(F.col(target).cast("bigint")).alias("__bad"))


def logistic(df: DataFrame, variables: Sequence[str], target: str = config.TARGET) -> Fit:
    """Maximum likelihood by Newton's method, one aggregate per step.

    A step that lowers the likelihood is halved. Where columns repeat one another, the step is the shortest of those
    that solve the equations, so equal columns get equal coefficients. Without both classes the constant stays 0.
    """
    counted = stage(patterns(df, variables, target), "patterns")
    n, bads = counted.agg(F.sum("__n"), F.sum("__bad")).first()
    k = len(variables) + 1
    if not n or not 0 < bads < n:
        return Fit(np.zeros(k), 0.0, 0)
    upper = np.triu_indices(k)

    def sums(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def add(block: np.ndarray) -> np.ndarray:
            times, bad = block[:, -2], block[:, -1]
            x = np.column_stack([np.ones(len(block)), block[:, :-2]])
            z = x @ beta
            p = 1 / (1 + np.exp(-z))
            likelihood = bad @ z - times @ np.logaddexp(0, z)
            hessian = (x * (times * p * (1 - p))[:, None]).T @ x
            return np.concatenate([[likelihood], x.T @ (bad - times * p), hessian[upper]])

        found = added_up(counted, [*variables, "__n", "__bad"], 1 + k + len(upper[0]), add)
        return found[0], found[1 : k + 1], symmetric(found[k + 1 :], k)

    beta = np.zeros(k)
    beta[0] = np.log(bads / (n - bads))
    likelihood, gradient, hessian = sums(beta)
    for steps in range(MOST_STEPS):
        if np.abs(gradient).max() / n <= SMALLEST_GRADIENT:
            break
        step = np.linalg.lstsq(hessian, gradient, rcond=WEAKEST_DIRECTION)[0]
        if np.abs(step).max() <= SMALLEST_GRADIENT * np.abs(beta).max():
            break
        for _ in range(30):
            tried = sums(beta + step)
            # near the top the likelihood no longer tells steps apart
            if tried[0] >= likelihood - 1e-9 * abs(likelihood):
                break
            step = step / 2
        beta = beta + step
        likelihood, gradient, hessian = tried
    return Fit(beta, float(np.abs(gradient).max() / n), steps)


# --- principal components --------------------------------------------------------------


# A column varies if its standard deviation is more than this part of its mean, or of 1; below is rounding noise.
LEAST_DEVIATION = 1e-9


@dataclass(frozen=True)
class Correlations:
    """Of the columns that vary, in order."""

    names: list[str]
    matrix: np.ndarray


@dataclass
class Moments:
    """Of some rows: how many, the means, and the products of what is left of the columns."""

    n: float
    means: np.ndarray
    products: np.ndarray

    def add(self, n: float, means: np.ndarray, products: np.ndarray) -> None:
        """Take in other rows. Only differences of means are squared, so large means cost no digits."""
        if n:
            total, gap = self.n + n, means - self.means
            self.products += products + np.outer(gap, gap) * (self.n * n / total)
            self.means = self.means + gap * (n / total)
            self.n = total


# Tasks that put the other tasks' moments together; each gives the driver one matrix.
MERGERS = 8


def moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """One pass, so ``df`` need not be staged. Rows with a null or NaN count for no column."""
    k = len(columns)
    schema = pa.schema([("n", pa.float64()), ("means", pa.binary()), ("products", pa.binary())])

    def empty() -> Moments:
        return Moments(0.0, np.zeros(k), np.zeros((k, k)))

    def row(found: Moments) -> pa.RecordBatch:
        values = [found.n], [found.means.tobytes()], [found.products.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = empty()
        for batch in batches:
            block = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            block = block[~np.isnan(block).any(axis=1)]
            if len(block):
                means = block.mean(axis=0)
                block -= means
                found.add(float(len(block)), means, block.T @ block)
        if found.n:
            yield row(found)

    def take_in(found: Moments, n: float, means: bytes, products: bytes) -> None:
        found.add(n, np.frombuffer(means), np.frombuffer(products).reshape(k, k))

    def of_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = empty()
        for batch in batches:
            for part in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                take_in(found, *part)
        if found.n:
            yield row(found)

    kinds = "n double, means binary, products binary"
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    whole = empty()
    for r in rows.mapInArrow(of_rows, kinds).repartition(MERGERS).mapInArrow(of_tasks, kinds).collect():
        take_in(whole, r["n"], bytes(r["means"]), bytes(r["products"]))
    return whole


def correlations(df: DataFrame, columns: Sequence[str]) -> Correlations:
    """From one pass. Rows with a null or NaN count for no column."""
    found = moments(df, columns) if columns else None
    if found is None or not found.n:
        return Correlations([], np.zeros((0, 0)))
    scale = np.sqrt(np.diag(found.products))
    kept = np.flatnonzero(scale / np.sqrt(found.n) > LEAST_DEVIATION * np.maximum(1.0, np.abs(found.means)))
    matrix = found.products[np.ix_(kept, kept)] / np.outer(scale[kept], scale[kept])
    return Correlations([columns[i] for i in kept], matrix)


# Largest residual of an eigenvector, against the largest eigenvalue.
MOST_RESIDUAL = 1e-9


def eigenvalues(matrix: np.ndarray) -> np.ndarray:
    """Of a symmetric matrix, largest first, checked: every eigenvector satisfies its equation and they are orthogonal."""
    if not len(matrix):
        return np.zeros(0)
    values, vectors = np.linalg.eigh(matrix)
    allowed = MOST_RESIDUAL * max(1.0, float(np.abs(values).max()))
    residual = max(np.abs(matrix @ vectors - vectors * values).max(), np.abs(vectors.T @ vectors - np.eye(len(matrix))).max())
    if residual > allowed:
        raise ArithmeticError(f"eigenvectors leave a residual of {residual:g}")
    return values[::-1]
