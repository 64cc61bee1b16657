"""Linear machines of all classes, one against the rest, fitted in the same passes.

Each class minimises its mean hinge loss plus ``penalty`` / 2 times the squares of its coefficients (the offset carries none) by
quasi-Newton steps with a bisecting line search, which suits a loss with edges. What a class wants evaluated next is known
without the others, so one pass over the rows answers for all classes: the number of passes is that of the slowest class.
Partial sums are (slots x classes) numbers per task, added up in tasks before one set reaches the driver.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.operators.perceptron import Perceptron
from medlattice.operators.softmax import added_up

#: earlier steps that shape the next one; evaluations of one line search at most
MEMORY, SEARCH = 10, 20


@dataclass(frozen=True)
class Fitting:
    """``maxIter`` steps at most, until one lowers the loss by less than ``tol`` times itself."""

    maxIter: int = 100
    tol: float = 1e-6
    penalty: float = 0.0


def sums(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Hinge losses and slopes of rows ``x`` (the last slot is 1) per class, added up, behind the number of rows; flat."""
    side = np.where(np.arange(weights.shape[1]) == y[:, None], 1.0, -1.0)
    short = np.maximum(1.0 - side * (x @ weights), 0.0)
    side[short == 0] = 0.0
    return np.concatenate([[len(y)], short.sum(axis=0), -(x.T @ side).ravel()])


def descent(size: int, how: Fitting) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Asks for (loss, slopes) at the weights it yields; returns the last it accepted."""
    weights = np.zeros(size)
    cost, slope = yield weights
    past: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=MEMORY)
    for _ in range(how.maxIter):
        way, shares = -slope, []
        for moved, turned in reversed(past):
            shares.append((moved @ way) / (moved @ turned))
            way = way - shares[-1] * turned
        if past:
            way = way * (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        for (moved, turned), share in zip(past, reversed(shares), strict=True):
            way = way + moved * (share - (turned @ way) / (moved @ turned))
        fall = float(slope @ way)
        if fall >= 0:
            break
        low, high, step, found = 0.0, np.inf, 1.0 if past else min(1.0, 1.0 / np.linalg.norm(slope)), None
        for _ in range(SEARCH):
            at = weights + step * way
            answer = yield at
            if answer[0] > cost + 1e-4 * step * fall:
                high = step
            else:
                found = (at, *answer)
                if answer[1] @ way >= 0.9 * fall:
                    break
                low = step
            step = (low + high) / 2 if high < np.inf else 2 * low
        if found is None:
            break
        before, moved, turned = cost, found[0] - weights, found[2] - slope
        weights, cost, slope = found
        if moved @ turned > 0:
            past.append((moved, turned))
        if before - cost <= how.tol * max(abs(before), abs(cost)):
            break
    return weights


def fit(rows: DataFrame, slots: int, classes: int, how: Fitting) -> np.ndarray:
    """Weights (slots and an offset, classes) from rows with ``label`` and the array ``x``."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, slots))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, slots)
            total += np.stack([np.full(slots, len(x)), x.sum(axis=0), (x * x).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    # steps are taken in slots of deviation 1, the penalty stays that of the slots as they are
    count, first, second = added_up(rows, moments).reshape(3, slots)
    spread = np.sqrt(np.maximum(second / count - (first / count) ** 2, 0.0))
    scale = np.append(np.where(spread > 1e-12, spread, 1.0), 1.0)
    penalty = np.append(np.full(slots, how.penalty), 0.0) / scale**2
    asked = {c: descent(slots + 1, how) for c in range(classes)}
    weights = np.zeros((slots + 1, classes))
    wanted = {c: next(one) for c, one in asked.items()}
    while wanted:
        open_ = sorted(wanted)
        trial = np.stack([wanted[c] for c in open_], axis=1)
        shared = rows.sparkSession.sparkContext.broadcast((np.array(open_), trial / scale[:, None]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total, (codes, at) = None, shared.value
            place = np.full(classes, -1)
            place[codes] = np.arange(len(codes))
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
                    part = sums(x, place[batch.column("label").to_numpy()], at)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        found = added_up(rows, run)
        shared.destroy()
        n, many = found[0], len(open_)
        slopes = found[1 + many :].reshape(slots + 1, many) / scale[:, None]
        wanted = {}
        for i, c in enumerate(open_):
            at = trial[:, i]
            try:
                wanted[c] = asked[c].send((found[1 + i] / n + 0.5 * float(penalty @ at**2), slopes[:, i] / n + penalty * at))
            except StopIteration as done:
                weights[:, c] = done.value
    return weights / scale[:, None]


class LinearMachines(Estimator):
    """``fit`` as an estimator over ``label`` and a vector column; the class of the largest margin is predicted."""

    def __init__(self, classes: int, how: Fitting, features: str = "features") -> None:
        super().__init__()
        self.classes, self.how, self.features = classes, how, features

    def _fit(self, dataset: DataFrame) -> Perceptron:
        rows = dataset.select(F.col("label").cast("int").alias("label"), vector_to_array(self.features).alias("x")).persist()
        try:
            slots = len(rows.select("x").first()["x"])
            weights = fit(rows, slots, self.classes, self.how)
        finally:
            rows.unpersist()
        return Perceptron(featuresCol=self.features, layers=[slots, self.classes], weights=[float(w) for w in weights.ravel()])
