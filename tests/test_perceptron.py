from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from medlattice.operators import perceptron as p
from medlattice.session import scratch_path

HOW = p.Training(hidden=(16, 8), epochs=30, rate=0.01, batch=50, hands=1)


def encoded(spark, n=800, partitions=4):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 4))
    y = ((x[:, 0] ** 2 + x[:, 1] ** 2 > 1.2).astype(int) + (x[:, 2] > 1)).astype(int)
    df = spark.createDataFrame([(i, float(y[i]), [float(v) for v in x[i]]) for i in range(n)], "patient_id long, label double, x array<double>")
    return df.repartition(partitions).withColumn("features", array_to_vector("x")), x, y


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    layers = (5, 7, 4, 3)
    x, y = rng.normal(size=(30, 5)), rng.integers(0, 3, 30)
    weights = p.initial(layers, 1)
    grad = p.gradient(x, y, weights, layers, 0.1)
    for i in rng.choice(len(weights), 40, replace=False):
        step = np.zeros_like(weights)
        step[i] = 1e-6
        slope = (p.loss(x, y, weights + step, layers, 0.1) - p.loss(x, y, weights - step, layers, 0.1)) / 2e-6
        assert abs(slope - grad[i]) < 1e-6


def test_one_hand_is_plain_mini_batch_adam(spark):
    """The distributed fit with one hand equals a loop over the same batches."""
    df, x, y = encoded(spark, 300)
    how = p.Training(hidden=(6,), epochs=3, rate=0.02, batch=32, hands=1)
    model, history = p.fit(df, 3, how)
    order = [tuple(r["x"]) for r in p.dealt_rows(df, "patient_id", 1, 0.0, how.seed).collect()]
    at = {tuple(v): i for i, v in enumerate(x.tolist())}
    rows = np.array([at[v] for v in order])
    layers = (4, 6, 3)
    start = p.initial(layers, how.seed)
    adam, costs = p.Adam(start, start * 0, start * 0, 0, how), []
    for epoch in range(3):
        deal, cost = np.random.default_rng((how.seed, epoch, 0)).permutation(len(rows)), 0.0
        for i in range(0, len(rows), how.batch):
            some = rows[deal[i : i + how.batch]]
            cost += p.loss(x[some], y[some], adam.weights, layers, how.decay) * len(some)
            adam.step(p.gradient(x[some], y[some], adam.weights, layers, how.decay))
        costs.append(cost / len(rows))
    assert np.allclose(model.getOrDefault(model.weights), adam.weights, atol=1e-12)
    assert np.allclose([c for c, _ in history], costs) and costs[-1] < costs[0]


@pytest.mark.parametrize("hands", [1, 3])
def test_learns_alike_on_any_partitions_and_reloads(spark, hands):
    df, _, y = encoded(spark)
    how = p.Training(**{**HOW.__dict__, "hands": hands})
    model, history = p.fit(df, 3, how, share=0.1)
    other, again = p.fit(df.repartition(9), 3, how, share=0.1)
    assert history == again and model.getOrDefault(model.weights) == other.getOrDefault(other.weights)
    path = scratch_path(spark, "perceptron")
    model.write().save(path)
    scored = {r["patient_id"]: r for r in p.Perceptron.load(path).transform(df).select("patient_id", "prediction", "probability").collect()}
    assert np.mean([scored[i]["prediction"] == y[i] for i in scored]) > 0.85
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in scored.values())


def test_early_stop_keeps_the_best_epoch(spark):
    df, x, y = encoded(spark)
    how = p.Training(hidden=(8,), epochs=60, rate=0.05, batch=50, hands=1, patience=3)
    model, history = p.fit(df, 3, how, share=0.2)
    scores = [s for _, s in history]
    held = [r["held"] for r in p.dealt_rows(df, "patient_id", 1, 0.2, how.seed).collect()]
    rows = p.dealt_rows(df, "patient_id", 1, 0.2, how.seed).where("held").collect()
    right = np.mean([p.forward(np.array([r["x"]]), np.array(model.getOrDefault(model.weights)), (4, 8, 3))[-1].argmax() == r["label"] for r in rows])
    best, stop = -1.0, None
    for epoch, score in enumerate(scores):
        if score > best + how.tolerance:
            best, at = score, epoch
        elif epoch - at >= how.patience:
            stop = epoch
            break
    assert right == pytest.approx(best) and (stop is None or len(scores) == stop + 1) and 0 < sum(held) < 400


def test_many_hands_are_averaged_in_groups(spark):
    df, _, _ = encoded(spark)
    how = p.Training(hidden=(4,), epochs=2, hands=6, batch=20)
    before, one = p.DIRECT, p.fit(df, 3, how)[0]
    p.DIRECT = 2
    try:
        other = p.fit(df, 3, how)[0]
    finally:
        p.DIRECT = before
    assert np.allclose(one.getOrDefault(one.weights), other.getOrDefault(other.weights))


def test_no_rows(spark):
    df, _, _ = encoded(spark, 10)
    with pytest.raises(ValueError, match="no rows"):
        p.fit(df.limit(0), 3, HOW)


@pytest.mark.parametrize("hands", [1, 2, 7, 40])
def test_one_set_of_weights_reaches_the_driver(spark, hands):
    rng = np.random.default_rng(hands)
    states = rng.normal(size=(hands, 6))
    rows = [(h, 10 + h, h, states[h].tobytes(), 0.5, 1, 1) for h in range(hands)]
    partial = spark.createDataFrame(rows, p._PARTIAL).repartition(5)
    found = p._added_up(partial, hands).collect()
    assert len(found) == 1
    assert np.allclose(np.frombuffer(found[0]["state"]), states.sum(axis=0))
    assert (found[0]["rows"], found[0]["steps"], found[0]["held"]) == (sum(r[1] for r in rows), sum(r[2] for r in rows), hands)


def test_a_batch_goes_forward_once(monkeypatch):
    """Loss and gradient of a batch share its outputs, and weights moved in slices are the weights moved at once."""
    rng = np.random.default_rng(4)
    layers, how = (3, 5, 4), p.Training()
    x, y, weights = rng.normal(size=(20, 3)), rng.integers(0, 4, 20), p.initial(layers, 1)
    outs = p.forward(x, weights, layers)
    expected = p.loss(x, y, weights, layers, 0.1), p.gradient(x, y, weights, layers, 0.1)
    monkeypatch.setattr(p, "forward", None)
    assert p.loss(x, y, weights, layers, 0.1, outs) == expected[0]
    assert (p.gradient(x, y, weights, layers, 0.1, outs) == expected[1]).all()
    zero = np.zeros_like(weights)
    hands = []
    for cells in (p.STEP_CELLS, 7):
        monkeypatch.setattr(p, "STEP_CELLS", cells)
        hands.append(p.Adam(weights, zero, zero, 0, how))
        hands[-1].step(expected[1])
        hands[-1].step(expected[1] * 2)
    assert (hands[0].weights == hands[1].weights).all() and (hands[0].second == hands[1].second).all()
