from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from medlattice.operators import boosting as b
from medlattice.session import scratch_path

DEPTH = b.Growth(rounds=4, depth=4, rate=0.3)
LEAF = b.Growth(rounds=4, depth=6, rate=0.3, leaves=9, penalty=0.0, least_hessian=1e-3, least_rows=20, hessian=1.5, prior=True)


def encoded(spark, n=600, features=5, classes=3, partitions=4, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, features)), 2)
    x[:, 4] = rng.integers(0, 2, n)
    y = (x[:, 0] + x[:, 1] * x[:, 4] > 0.3).astype(int) + (x[:, 2] > 0.8)
    rows = [(i, float(y[i]), [float(v) for v in x[i]], bool(i % 10 == 0)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label double, x array<double>, held boolean").repartition(partitions)
    return df.withColumn("features", array_to_vector("x")), x, y


def slow_fit(x, y, classes, growth, cuts):
    """Plain boosting: every node's rows listed, every split tried, one leaf at a time; (trees, margins)."""
    codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    start = np.log([max(float((y == k).sum()), 1e-9) / len(y) for k in range(classes)]) if growth.prior else np.zeros(classes)
    margin = np.tile(start, (len(x), 1))
    trees = []
    for _ in range(growth.rounds):
        p = np.exp(margin - margin.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = np.rint((p - np.eye(classes)[y]) * b.SCALE)
        h = np.rint(np.maximum(growth.hessian * p * (1 - p), 1e-6) * b.SCALE)
        step = np.zeros_like(margin)
        for k in range(classes):

            def score(rows, k=k):
                return (g[rows, k].sum() / b.SCALE) ** 2 / (h[rows, k].sum() / b.SCALE + growth.penalty + 1e-16)

            def best(rows, k=k):
                found = (0.0, None)
                for f in range(x.shape[1]):
                    for cut in range(len(cuts[f])):
                        left, right = rows[codes[rows, f] <= cut], rows[codes[rows, f] > cut]
                        if min(len(left), len(right)) < max(1, growth.least_rows) or min(h[left, k].sum(), h[right, k].sum()) < growth.least_hessian * b.SCALE:
                            continue
                        gain = score(left) + score(right) - score(rows)
                        if gain > found[0] + 1e-9:
                            found = (gain, (f, cut, left, right))
                return found

            rows = np.arange(len(x))
            leaves = [(best(rows), 0, rows)]
            splits = []
            while True:
                able = [i for i, ((gain, s), depth, _) in enumerate(leaves) if s and depth < growth.depth]
                if not able or (growth.leaves and len(leaves) >= growth.leaves):
                    break
                i = max(able, key=lambda i: leaves[i][0][0])
                (_, (f, cut, left, right)), depth, _ = leaves.pop(i)
                splits.append((f, float(cuts[f][cut])))
                leaves += [(best(s) if depth + 1 < growth.depth else (0.0, None), depth + 1, s) for s in (left, right)]
            for _, _, rows in leaves:
                step[rows, k] = -g[rows, k].sum() / (h[rows, k].sum() + growth.penalty * b.SCALE + 1e-16) * growth.rate
            trees.append(sorted(splits))
        margin = margin + step
    return trees, margin


@pytest.mark.parametrize("local", [0, 120, 10_000])
@pytest.mark.parametrize("growth", [DEPTH, LEAF], ids=["depth", "leaf"])
def test_equals_brute_force(spark, growth, local, monkeypatch):
    """Whether passes grow whole trees, one task finishes small nodes, or grows all of a tree."""
    monkeypatch.setattr(b, "LOCAL_ROWS", local)
    df, x, y = encoded(spark)
    model, history = b.fit(df, 3, growth)
    cuts = b.bin_cuts(df, growth.bins)
    trees, margin = slow_fit(x, y, 3, growth, cuts)
    ours = [sorted((int(f), float(c)) for f, c in zip(t[0], t[1], strict=True) if f >= 0) for _, t in model.trees()]
    assert ours == trees and len(ours) == 12
    rows = {r["id"]: r for r in model.transform(df).select("id", "rawPrediction", "probability", "prediction").collect()}
    got = np.array([rows[i]["rawPrediction"].toArray() for i in range(len(x))])
    assert np.allclose(got, margin, atol=1e-9)
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 and r["prediction"] == int(np.argmax(r["rawPrediction"].toArray())) for r in rows.values())
    assert len(history) == 3 and history[-1][0] < history[0][0]


def test_leaf_wise_differs_from_depth_wise(spark):
    df, _, _ = encoded(spark)
    depth, _ = b.fit(df, 3, b.Growth(rounds=2, depth=3))
    leaf, _ = b.fit(df, 3, b.Growth(rounds=2, depth=8, leaves=8))
    shapes = [sorted((t[0] >= 0).sum() for _, t in m.trees()) for m in (depth, leaf)]
    assert max(shapes[0]) <= 7 and max(shapes[1]) == 7

    def deepest(tree):
        level, found = [0], 0
        while level:
            found += 1
            level = [c for n in level if tree[0][n] >= 0 for c in (tree[2][n], tree[3][n])]
        return found

    assert max(deepest(t) for _, t in leaf.trees()) > max(deepest(t) for _, t in depth.trees())


def test_partitions_and_written_rounds_change_nothing(spark):
    df, _, _ = encoded(spark)
    before = b.CUT, b.DIRECT_PARTITIONS, b.PASS_CELLS, b.LOCAL_ROWS
    one, _ = b.fit(df, 3, LEAF)
    try:
        b.CUT, b.DIRECT_PARTITIONS, b.PASS_CELLS, b.LOCAL_ROWS = 2, 2, 200, 50
        other, _ = b.fit(df.repartition(9), 3, LEAF)
    finally:
        b.CUT, b.DIRECT_PARTITIONS, b.PASS_CELLS, b.LOCAL_ROWS = before
    assert one.nodes.equals(other.nodes)


def test_early_stop_at_the_round_brute_force_names(spark):
    df, x, y = encoded(spark)
    growth = b.Growth(rounds=40, depth=3, rate=0.9)
    model, history = b.fit(df, 3, growth, held="held", patience=4)
    held = np.arange(len(x)) % 10 == 0
    cuts = b.bin_cuts(df, growth.bins)
    losses = []
    for n in range(1, len(history) + 1):
        trees, _ = slow_fit(x[~held], y[~held], 3, b.Growth(rounds=n, depth=3, rate=0.9), cuts) if n in (1, 2) else (None, None)
        if trees:
            ours = [sorted((int(f), float(c)) for f, c in zip(t[0], t[1], strict=True) if f >= 0) for _, t in model.trees()][: len(trees)]
            assert ours == trees
    scored = {r["id"]: r["probability"] for r in model.transform(df).select("id", "probability").collect()}
    mine = np.mean([-np.log(scored[i][int(y[i])]) for i in np.flatnonzero(held)])
    losses = [h for _, h in history]
    best = int(np.argmin(losses)) + 1
    assert model.num_rounds == best and len(history) == min(40, best + 4) and abs(mine - losses[best - 1]) < 1e-4


def test_saved_and_reloaded(spark):
    df, _, _ = encoded(spark)
    model, _ = b.fit(df, 4, DEPTH)
    path = scratch_path(spark, "boosted")
    model.write().save(path)
    again = b.BoostedTrees.load(path)
    assert again.nodes.equals(model.nodes) and again.num_leaves == model.num_leaves
    both = model.transform(df).select("id", "prediction", F.col("probability").alias("p")).join(again.transform(df).select("id", F.col("probability").alias("q")), "id")
    assert both.where("p != q").count() == 0
    # the fourth class does not occur
    assert both.where("prediction = 3").count() == 0


def test_nodes_are_dealt_by_their_rows():
    """No task gets two large nodes while another has small ones only, and a node that is one task's work takes one job."""
    sizes = {(k, 0): 1000 for k in range(8)} | {(k, 1): 10 for k in range(8)}
    places = b._places(sizes, 8)
    assert sorted(places[k, 0] for k in range(8)) == list(range(8)) and set(places) == set(sizes)
    assert b.LOCAL_ROWS >= 72_000


def test_rows_go_on_from_the_node_they_wait_in():
    tree = (np.array([0, 1, -1, -1, -1]), np.array([1, 0, 0, 0, 0]), np.array([1, 3, -1, -1, -1]), np.array([2, 4, -1, -1, -1]))
    codes = np.array([[0, 0], [1, 1], [2, 0]], np.uint8)
    node = b._routed(tuple(np.array([x[0], -1, -1]) if i == 0 else x[:3] for i, x in enumerate(tree)), codes)
    assert node.tolist() == [1, 1, 2]
    assert b._routed(tree, codes, node).tolist() == b._routed(tree, codes).tolist() == [3, 4, 2]


def test_no_rows(spark):
    df, _, _ = encoded(spark)
    with pytest.raises(ValueError, match="no rows"):
        b.fit(df.limit(0), 3, DEPTH)
