"""Multilayer perceptron with rectified units, trained by mini-batch Adam over dealt rows.

* Rows are dealt by the hash of their key to a fixed number of *hands*; a hand's rows lie in one partition of a written
  table. Which rows meet in a batch depends on keys and seed, not on the cluster.
* One epoch is one pass: each hand goes through its mini-batches with the Adam steps of the shared weights and moments,
  then the hands' weights and moments are averaged by their rows. With one hand this is plain mini-batch Adam. A hand's
  rows arrive as a stream and are shuffled within runs of ``RUN`` rows by (seed, epoch, hand), so no task holds more.
* With a held-out share, each pass first scores the weights it was given on the held rows of its hand. Training stops
  when accuracy has not risen by ``tolerance`` for ``patience`` epochs, and the best weights are kept.

What is sent is one set of weights per hand; they are added up in tasks, many in groups first, so one set an epoch is collected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.functions.hashing import key_hash
from medlattice.session import cut_lineage

#: rows shuffled at once; rows of a hand at least, hands at most; hands whose weights one task adds up
RUN, HAND_ROWS, HANDS, DIRECT = 20_000, 50_000, 256, 32
#: weights moved at a time
STEP_CELLS = 8_192


@dataclass(frozen=True)
class Training:
    """Hidden layers and how they are trained."""

    hidden: tuple[int, ...] = (100,)
    epochs: int = 200
    batch: int = 200
    rate: float = 1e-3
    decay: float = 1e-4
    beta1: float = 0.9
    beta2: float = 0.999
    epsilon: float = 1e-8
    tolerance: float = 1e-4
    patience: int = 10
    seed: int = 42
    hands: int | None = None


# ---- the network -------------------------------------------------------------------------------


def shapes(layers: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(layers[:-1], layers[1:], strict=True))


def initial(layers: Sequence[int], seed: int) -> np.ndarray:
    """Flat weights, uniform within sqrt(6 / (inputs + outputs)) of each layer."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in shapes(layers):
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def unpacked(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(matrix, offsets) of each layer, as views."""
    out, at = [], 0
    for a, b in shapes(layers):
        out.append((weights[at : at + a * b].reshape(a, b), weights[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def forward(x: np.ndarray, weights: np.ndarray, layers: Sequence[int]) -> list[np.ndarray]:
    """Outputs of every layer; the last are class probabilities."""
    out = [x]
    parts = unpacked(weights, layers)
    for i, (matrix, offsets) in enumerate(parts):
        z = out[-1] @ matrix + offsets
        if i < len(parts) - 1:
            out.append(np.maximum(z, 0.0))
        else:
            powers = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(powers / powers.sum(axis=1, keepdims=True))
    return out


def loss(x: np.ndarray, y: np.ndarray, weights: np.ndarray, layers: Sequence[int], decay: float, outs: list[np.ndarray] | None = None) -> float:
    """Mean cross entropy with weight decay; ``outs`` is ``forward`` if it is known."""
    p = (forward(x, weights, layers) if outs is None else outs)[-1][np.arange(len(x)), y]
    squares = sum((m * m).sum() for m, _ in unpacked(weights, layers))
    return float(-np.log(np.maximum(p, 1e-300)).mean() + 0.5 * decay * squares / len(x))


def gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray, layers: Sequence[int], decay: float, outs: list[np.ndarray] | None = None) -> np.ndarray:
    """Gradient of ``loss``, flat like the weights."""
    outs = forward(x, weights, layers) if outs is None else outs
    parts = unpacked(weights, layers)
    back = outs[-1].copy()
    back[np.arange(len(x)), y] -= 1.0
    back /= len(x)
    grads: list[np.ndarray] = []
    for i in range(len(parts) - 1, -1, -1):
        matrix, _ = parts[i]
        grads = [(outs[i].T @ back + decay / len(x) * matrix).ravel(), back.sum(axis=0), *grads]
        if i:
            back = (back @ matrix.T) * (outs[i] > 0)
    return np.concatenate(grads)


class Adam:
    """Moments and step count of one hand."""

    def __init__(self, weights: np.ndarray, first: np.ndarray, second: np.ndarray, steps: int, how: Training) -> None:
        self.weights, self.first, self.second, self.steps, self.how = weights.copy(), first.copy(), second.copy(), steps, how

    def step(self, grad: np.ndarray) -> None:
        how = self.how
        self.steps += 1
        rate = how.rate * np.sqrt(1 - how.beta2**self.steps) / (1 - how.beta1**self.steps)
        # in slices that stay in a core's cache
        for at in range(0, len(grad), STEP_CELLS):
            part = slice(at, at + STEP_CELLS)
            g, first, second = grad[part], self.first[part], self.second[part]
            first += (1 - how.beta1) * (g - first)
            second += (1 - how.beta2) * (g * g - second)
            self.weights[part] -= rate * first / (np.sqrt(second) + how.epsilon)


# ---- one epoch ---------------------------------------------------------------------------------

_PARTIAL = "hand int, rows long, steps long, state binary, loss double, held long, hits long"


def _epoch(dealt: DataFrame, layers: Sequence[int], state: tuple[np.ndarray, np.ndarray, np.ndarray], steps: int, epoch: int, how: Training, learn: bool, hands: int) -> tuple:
    """(weights, moments, steps, training loss, held-out accuracy of the given weights) after one pass."""
    shared = dealt.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, first, second = shared.value
        hand, adam, rng = None, None, None
        pending_x: list[np.ndarray] = []
        pending_y: list[np.ndarray] = []
        rows, total, held, hits, waiting = 0, 0.0, 0, 0, 0

        def train() -> None:
            nonlocal total, waiting
            x, y = np.concatenate(pending_x), np.concatenate(pending_y)
            order = rng.permutation(len(x))
            for at in range(0, len(x), how.batch):
                some = order[at : at + how.batch]
                a, b = x[some], y[some]
                outs = forward(a, adam.weights, layers)
                total += loss(a, b, adam.weights, layers, how.decay, outs) * len(some)
                adam.step(gradient(a, b, adam.weights, layers, how.decay, outs))
            pending_x.clear(), pending_y.clear()
            waiting = 0

        def close() -> pa.RecordBatch:
            if waiting:
                train()
            parts = np.stack([adam.weights, adam.first, adam.second]) * rows
            return pa.RecordBatch.from_arrays(
                [pa.array([hand], pa.int32()), pa.array([rows]), pa.array([adam.steps * rows]), pa.array([parts.tobytes()], pa.binary()), pa.array([total]), pa.array([held]), pa.array([hits])],
                names=["hand", "rows", "steps", "state", "loss", "held", "hits"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            hands = batch.column("hand").to_numpy()
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(hands), -1)
            y, out = batch.column("label").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(hands)) + 1
            for part in np.split(np.arange(len(hands)), cuts):
                if hands[part[0]] != hand:
                    if hand is not None:
                        yield close()
                    hand = int(hands[part[0]])
                    adam, rng = Adam(given, first, second, steps, how), np.random.default_rng((how.seed, epoch, hand))
                    rows, total, held, hits = 0, 0.0, 0, 0
                check, fit = part[out[part]], part[~out[part]]
                if len(check):
                    held += len(check)
                    hits += int((forward(x[check], given, layers)[-1].argmax(axis=1) == y[check]).sum())
                rows += len(fit)
                if learn and len(fit):
                    pending_x.append(x[fit]), pending_y.append(y[fit])
                    waiting += len(fit)
                    if waiting >= RUN:
                        train()
        if hand is not None:
            yield close()

    partial = dealt.mapInArrow(run, _PARTIAL)
    found = _added_up(partial, hands).collect()
    shared.destroy()
    rows = sum(r["rows"] for r in found)
    # the same order each time, so that a rerun adds alike
    sums = sum((np.frombuffer(r["state"]).reshape(3, -1) for r in sorted(found, key=lambda r: r["hand"])), np.zeros((3, len(state[0])))) / max(rows, 1)
    held = sum(r["held"] for r in found)
    accuracy = sum(r["hits"] for r in found) / held if held else None
    return (sums[0], sums[1], sums[2]), round(sum(r["steps"] for r in found) / max(rows, 1)), sum(r["loss"] for r in found) / max(rows, 1), accuracy


def _added_up(partial: DataFrame, hands: int) -> DataFrame:
    """One row of sums, always added in the same order, so that a rerun adds alike."""
    if hands > DIRECT:
        partial = partial.repartition(DIRECT, "hand").sortWithinPartitions("hand").mapInArrow(_summed, _PARTIAL)
    return partial.repartition(1).sortWithinPartitions("hand").mapInArrow(_summed, _PARTIAL) if hands > 1 else partial


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of rows that arrive in order; one set of weights is held besides those of a batch."""
    state, first, sums = None, None, [0, 0, 0.0, 0, 0]
    for batch in batches:
        for i in range(batch.num_rows):
            one = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            part = np.frombuffer(one["state"])
            state, first = (part.copy(), one["hand"]) if state is None else (state + part, first)
            sums = [a + one[c] for a, c in zip(sums, ("rows", "steps", "loss", "held", "hits"), strict=True)]
    if state is not None:
        values = [[first], [sums[0]], [sums[1]], [state.tobytes()], *[[x] for x in sums[2:]]]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["hand", "rows", "steps", "state", "loss", "held", "hits"])


# ---- fitting -----------------------------------------------------------------------------------


def dealt_rows(encoded: DataFrame, key: str, hands: int, share: float, seed: int) -> DataFrame:
    """Written rows as (hand, label, held, x), read with a hand in one partition and in the order of its keys' hashes."""
    order = key_hash(key, seed)
    rows = encoded.select(
        (order % hands).cast("int").alias("hand"), F.floor(order / hands).alias("place"), F.col("label").cast("int").alias("label"),
        (key_hash(key, 7) % 10_000 < round(share * 10_000)).alias("held"), vector_to_array("features").alias("x"),
    )
    return cut_lineage(rows, "perceptron-rows").repartition(hands, "hand").sortWithinPartitions("hand", "place", "x").drop("place")


def fit(encoded: DataFrame, classes: int, how: Training, key: str = "patient_id", share: float = 0.0) -> tuple[Perceptron, list[tuple[float, float | None]]]:
    """(model, (training loss, held-out accuracy) of each epoch) from rows with ``label``, ``features`` and an integer key."""
    count = encoded.count()
    if not count:
        raise ValueError("no rows to fit")
    hands = how.hands or max(1, min(HANDS, count // HAND_ROWS))
    dealt = dealt_rows(encoded, key, hands, share, how.seed).persist()
    layers = (len(encoded.select("features").first()["features"]), *how.hidden, classes)
    weights = initial(layers, how.seed)
    state, steps = (weights, np.zeros_like(weights), np.zeros_like(weights)), 0
    best, best_score, waited = weights, -1.0, 0
    history: list[tuple[float, float | None]] = []
    try:
        for epoch in range(how.epochs + 1):
            last = epoch == how.epochs
            if last and not share:
                break
            given = state[0]
            state, steps, cost, score = _epoch(dealt, layers, state, steps, epoch, how, not last, hands)
            if epoch and score is not None:
                # the pass scored the weights of the epoch before
                history[-1] = (history[-1][0], score)
                if score > best_score + how.tolerance:
                    best, best_score, waited = given, score, 0
                else:
                    waited += 1
                    if waited >= how.patience:
                        break
            if not last:
                history.append((cost, None))
    finally:
        dealt.unpersist()
    if history and history[-1][1] is None and share:
        history.pop()
    return Perceptron(layers=list(layers), weights=[float(w) for w in (best if share and best_score >= 0 else state[0])]), history


class MiniBatchPerceptron(Estimator):
    """``fit`` as an estimator over ``label``, ``features`` and a key."""

    def __init__(self, classes: int, how: Training, key: str = "patient_id", share: float = 0.1) -> None:
        super().__init__()
        self.classes, self.how, self.key, self.share = classes, how, key, share

    def _fit(self, dataset: DataFrame) -> Perceptron:
        return fit(dataset, self.classes, self.how, self.key, self.share)[0]


class Perceptron(Transformer, HasFeaturesCol, HasProbabilityCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted network; layers and weights are its parameters."""

    layers = Param(Params._dummy(), "layers", "units per layer, inputs first", TypeConverters.toListInt)
    weights = Param(Params._dummy(), "weights", "all weights, layer by layer", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", probabilityCol="probability", predictionCol="prediction", layers=None, weights=None):
        super().__init__()
        self._setDefault(featuresCol="features", probabilityCol="probability", predictionCol="prediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        layers = self.getOrDefault(self.layers)
        shared = dataset.sparkSession.sparkContext.broadcast(np.array(self.getOrDefault(self.weights)))

        @F.pandas_udf("array<double>")
        def probabilities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                if len(batch) == 0:
                    yield pd.Series([], dtype=object)
                    continue
                yield pd.Series(list(forward(np.stack(batch.to_numpy()), shared.value, layers)[-1]))

        scored = dataset.withColumn("_probabilities", probabilities(vector_to_array(F.col(self.getFeaturesCol()))))
        top = F.array_position("_probabilities", F.array_max("_probabilities"))
        return scored.withColumns({
            self.getProbabilityCol(): array_to_vector("_probabilities"), self.getPredictionCol(): (top - 1).cast("double"),
        }).drop("_probabilities")
