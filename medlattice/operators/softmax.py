"""Multinomial logistic regression by Newton steps: few passes over the rows, each adding up slopes and curvature.

The loss is the mean negative log likelihood plus ``penalty`` / 2 times the squares of the coefficients; offsets carry no
penalty. It is convex, so its one minimum does not depend on how it is reached. First-order steps need hundreds of passes to
it, Newton steps about ten, whatever the number of rows: a pass adds up (classes x slots)^2 numbers per task, which are added
up again in tasks before one set reaches the driver. A step that does not lower the loss is halved.

Defined cases: classes without rows have probability 0; offsets are centred over the classes that occur.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.operators.perceptron import Perceptron

#: partial sums that one task adds up; rows whose probabilities are held at once
DIRECT, BLOCK_ROWS = 32, 8_192

#: offset of a class that does not occur: its probability is 0
NEVER = -1e4


@dataclass(frozen=True)
class Fitting:
    """``maxIter`` steps at most, until a step would lower the loss by less than ``tol`` times itself."""

    maxIter: int = 1000
    tol: float = 1e-12
    penalty: float = 0.0


def sums(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Loss, slopes and curvature of rows ``x`` (the last slot is 1) at ``weights`` (slots, classes), added up and flat."""
    slots, classes = weights.shape
    z = x @ weights
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    total = p.sum(axis=1, keepdims=True)
    at = np.arange(len(y))
    cost = float((np.log(total[:, 0]) - z[at, y]).sum())
    p /= total
    slope = p.copy()
    slope[at, y] -= 1.0
    curve = np.empty((classes, slots, classes, slots))
    for a in range(classes):
        for b in range(a, classes):
            w = p[:, a] * ((a == b) - p[:, b])
            curve[a, :, b, :] = x.T @ (x * w[:, None])
            curve[b, :, a, :] = curve[a, :, b, :]
    return np.concatenate([[cost, len(y)], (x.T @ slope).T.ravel(), curve.ravel()])


def _pass(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """``sums`` over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column("label").to_numpy()
            x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
            for at in range(0, len(x), BLOCK_ROWS):
                part = sums(x[at : at + BLOCK_ROWS], y[at : at + BLOCK_ROWS], shared.value)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    found = added_up(rows, run)
    shared.destroy()
    return found


def added_up(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> np.ndarray:
    """The arrays that ``run`` makes of the partitions of ``rows`` (column ``sums``), added up in tasks if there are many."""
    partial = rows.mapInArrow(run, "sums binary")
    if rows.rdd.getNumPartitions() > DIRECT:
        partial = partial.repartition(DIRECT).mapInArrow(_added, "sums binary").repartition(1).mapInArrow(_added, "sums binary")
    return sum(np.frombuffer(r["sums"]) for r in partial.collect())


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for one in batch.column("sums"):
            part = np.frombuffer(one.as_py())
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def fit(encoded: DataFrame, classes: int, how: Fitting) -> tuple[Perceptron, list[float]]:
    """(model, loss after each step) from rows with ``label`` and ``features``."""
    codes = sorted(int(r[0]) for r in encoded.select("label").distinct().collect())
    if not codes:
        raise ValueError("no rows to fit")
    place = F.array_position(F.array(*[F.lit(float(c)) for c in codes]), F.col("label").cast("double")) - 1
    rows = encoded.select(place.cast("int").alias("label"), vector_to_array("features").alias("x")).persist()
    try:
        weights, history = _newton(rows, len(encoded.select("features").first()["features"]) + 1, len(codes), how)
    finally:
        rows.unpersist()
    weights[-1] -= weights[-1].mean()
    whole = np.zeros((len(weights), classes))
    whole[-1] = NEVER
    whole[:, codes] = weights
    return Perceptron(layers=[len(whole) - 1, classes], weights=[float(w) for w in whole.ravel()]), history


def _newton(rows: DataFrame, slots: int, classes: int, how: Fitting) -> tuple[np.ndarray, list[float]]:
    weights = np.zeros((slots, classes))
    penalty = np.tile(np.append(np.full(slots - 1, how.penalty), 0.0), classes)

    def at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        found = _pass(rows, weights)
        flat, n, size = weights.T.ravel(), found[1], slots * classes
        cost = found[0] / n + 0.5 * float(penalty @ flat**2)
        return cost, found[2 : 2 + size] / n + penalty * flat, found[2 + size :].reshape(size, size) / n + np.diag(penalty)

    cost, slope, curve = at(weights)
    history: list[float] = []
    for _ in range(how.maxIter):
        # offsets that all move alike change nothing, nor do slots that add up: the least step of those that fit
        step = -np.linalg.lstsq(curve, slope, rcond=1e-13)[0]
        gain = -float(slope @ step)
        if gain <= how.tol * max(abs(cost), 1e-300):
            break
        share = 1.0
        while share > 1e-6:
            moved = weights + share * step.reshape(classes, slots).T
            found = at(moved)
            if found[0] <= cost - 1e-4 * share * gain:
                break
            share /= 2
        else:
            break
        weights, (cost, slope, curve) = moved, found
        history.append(cost)
    return weights, history


class SoftmaxRegression(Estimator):
    """``fit`` as an estimator over ``label`` and ``features``."""

    def __init__(self, classes: int, how: Fitting) -> None:
        super().__init__()
        self.classes, self.how = classes, how

    def _fit(self, dataset: DataFrame) -> Perceptron:
        return fit(dataset, self.classes, self.how)[0]
