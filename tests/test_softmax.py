from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from medlattice.operators import softmax


def _rows(spark, x, y):
    table = spark.createDataFrame([(float(c), [float(v) for v in row]) for c, row in zip(y, x, strict=True)], "label double, x array<double>")
    return table.select("label", array_to_vector("x").alias("features"))


def test_newton_reaches_the_minimum_in_few_passes(spark):
    """The same coefficients as Spark's estimator run to its end, in a small number of steps; slots that add up do not matter."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3))
    x = np.column_stack([x, x[:, 0] > 0, x[:, 0] <= 0])
    y = (x[:, :3] @ rng.normal(size=(3, 4)) + rng.gumbel(size=(600, 4))).argmax(axis=1)
    rows = _rows(spark, x, y)
    model, history = softmax.fit(rows, 4, softmax.Fitting(penalty=1 / 600))
    own = np.array(model.getOrDefault(model.weights)).reshape(-1, 4)
    theirs = LogisticRegression(family="multinomial", regParam=1 / 600, standardization=False, maxIter=5000, tol=1e-12).fit(rows)
    assert len(history) <= 15
    assert own[:-1].T == pytest.approx(theirs.coefficientMatrix.toArray(), abs=1e-3)
    assert own[-1] == pytest.approx(theirs.interceptVector.toArray(), abs=1e-3)
    p = np.exp(x @ own[:-1] + own[-1])
    p /= p.sum(axis=1, keepdims=True)
    slope = x.T @ (p - np.eye(4)[y]) / 600 + own[:-1] / 600
    assert abs(slope).max() < 1e-6


def test_class_without_rows_has_probability_zero(spark):
    rows = _rows(spark, [[0.0], [1.0], [2.0], [3.0]], [0, 2, 0, 2])
    model, _ = softmax.fit(rows, 4, softmax.Fitting(penalty=0.25))
    found = model.transform(rows).select("prediction", "probability").collect()
    assert {r["prediction"] for r in found} <= {0.0, 2.0}
    assert all(r["probability"][1] == r["probability"][3] == 0 for r in found)


def test_parts_are_added_up_alike(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = _rows(spark, rng.normal(size=(50, 2)), rng.integers(0, 3, 50)).repartition(6).persist()
    a, _ = softmax.fit(rows, 3, softmax.Fitting(penalty=0.1))
    monkeypatch.setattr(softmax, "DIRECT", 2)
    b, _ = softmax.fit(rows, 3, softmax.Fitting(penalty=0.1))
    assert a.getOrDefault(a.weights) == pytest.approx(b.getOrDefault(b.weights), abs=1e-6)
