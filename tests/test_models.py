from __future__ import annotations

import time
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from medlattice import schema as S
from medlattice.operators import attribution, encode, explain, models, split
from medlattice.operators.kernel import RandomFourierFeatures, scale_gamma
from medlattice.sources import store
from medlattice.session import scratch_path


@pytest.fixture(scope="module")
def parts(patients):
    data = split.hash_split(patients)
    return data.filter("is_train").drop("is_train"), data.filter("not is_train").drop("is_train")


@pytest.mark.parametrize("algorithm", ["RandomForest", "LogisticRegression", "NeuralNetwork", "XGBoost", "LightGBM", "SVM"])
def test_every_algorithm_learns_and_reloads(spark, parts, algorithm):
    train, test = parts
    params = models.quick_params("lifestyle", algorithm)
    fitted = models.train(train, "lifestyle", algorithm, params)
    assert models.evaluate(fitted, test)["accuracy"] > 0.6
    scored = fitted.predict(test)
    total = F.aggregate("probability", F.lit(0.0), lambda a, v: a + v)
    assert scored.filter(F.abs(total - 1) > 1e-9).count() == 0
    path = scratch_path(spark, "model")
    store.save_model(fitted, path)
    again = store.load_trained(spark, path, "lifestyle", algorithm).predict(test)
    changed = scored.select("patient_id", F.col("predicted_class").alias("a")).join(
        again.select("patient_id", F.col("predicted_class").alias("b")), "patient_id"
    )
    assert changed.filter("a != b").count() == 0


def test_the_grid_has_every_algorithm_on_every_task(spark, monkeypatch):
    """Six algorithms on three tasks, each scored on the test rows; with few iterations here."""
    from medlattice.plans import dataset, queries

    rows = dataset.build_patients(spark, 400).persist()
    monkeypatch.setattr(dataset, "patients", lambda spark, folder: rows)
    small = {**models.QUICK, "XGBoost": {"rounds": 2, "depth": 3}, "LightGBM": {"rounds": 2, "depth": 3, "leaves": 4}, "SVM": {"maxIter": 2, "components": 16}}
    monkeypatch.setattr(models, "STUDY", {a: dict.fromkeys(S.TARGETS, params) for a, params in small.items()})
    found = queries.queries()["model_grid"](spark, "").collect()
    assert sorted((r["task"], r["algorithm"]) for r in found) == sorted((t, a) for t in S.TARGETS for a in models.ALGORITHMS)
    assert all(0 < r["accuracy"] <= 1 and r["training_time_seconds"] > 0 for r in found)


def test_kernel_machine_without_a_class(parts):
    """A class that is absent from training is not predicted and does not stop the fit."""
    train, test = (p.filter("lifestyle_plan not in ('Alcohol_Reduction', 'Maintenance')") for p in parts)
    fitted = models.train(train, "lifestyle", "SVM", {"maxIter": 3, "components": 32})
    assert fitted.classes == tuple(c for c in S.LIFESTYLE_PLANS if c not in ("Alcohol_Reduction", "Maintenance"))
    assert {r[0] for r in fitted.predict(test).select("predicted_class").distinct().collect()} <= set(fitted.classes)
    assert models.evaluate(fitted, test)["accuracy"] > 0.5


def test_cross_validation(parts):
    fitted = models.train(parts[0], "lifestyle", "RandomForest", {"numTrees": 5, "maxDepth": 4}, folds=3)
    assert 0.5 < fitted.cv_mean <= 1.0 and fitted.cv_std >= 0.0


def test_early_stopping_of_both_kinds(spark, parts):
    fitted, history = models.fit_perceptron_early_stopping(parts[0], "lifestyle", {"hidden": (8,), "epochs": 6, "rate": 0.02, "patience": 2})
    assert 1 <= len(history) <= 6 and all(0 <= score <= 1 for _, score in history)
    assert models.evaluate(fitted, parts[1])["accuracy"] > 0.3
    boosted, losses = models.fit_booster_early_stopping(parts[0], "lifestyle", rounds=12, depth=4, rate=0.9, leaves=8, patience=2)
    best = min(range(len(losses)), key=lambda i: losses[i][1]) + 1
    assert boosted.model.stages[-2].num_rounds == best and len(losses) <= best + 2
    path = scratch_path(spark, "boosted")
    store.save_model(boosted, path)
    again = store.load_trained(spark, path, "lifestyle", "LightGBM")
    assert models.evaluate(again, parts[1]) == models.evaluate(boosted, parts[1]) and models.evaluate(boosted, parts[1])["accuracy"] > 0.6


def test_importances_sum_to_one(patients, parts):
    fitted = models.train_forest(parts[0], "diet", {"numTrees": 5, "maxDepth": 4})
    rows = models.feature_importances(fitted, patients).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert {r["feature"] for r in rows} == {*S.NUMERIC, *S.CATEGORICAL}


def test_unknown_model_path(spark):
    assert store.load_model(spark, scratch_path(spark, "nothing")) is None
    with pytest.raises(FileNotFoundError):
        store.load_trained(spark, scratch_path(spark, "nothing"), "diet", "RandomForest")


def test_kernel_map_approximates_rbf(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(20, 3))
    data = encode.assembler(["a", "b", "c"], "features").transform(
        spark.createDataFrame([tuple(map(float, p)) for p in points], "a double, b double, c double").repartition(3)
    )
    gamma = scale_gamma(data)
    assert gamma == pytest.approx(1.0 / (3 * points.var()))
    mapped = RandomFourierFeatures(components=4000, gamma=gamma).transform(data).select("features", "kernel_features").collect()
    x, z = np.array([r[0].toArray() for r in mapped]), np.array([r[1].toArray() for r in mapped])
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.1


def test_cluster_choice(spark):
    sweep = spark.createDataFrame([(3, 0.2), (4, 0.4), (5, 0.4)], "k int, silhouette double")
    assert models.choose_k(sweep) == 5 and models.choose_k(sweep, "best") == 4


# --- Shapley values -------------------------------------------------------------------------


def tree_value(nodes, node, row, known, stats_class):
    """Expected value of a tree when only the features in ``known`` are given."""
    n = nodes[node]
    if n["left"] < 0:
        return n["stats"][stats_class] / n["stats"].sum()
    if n["feature"] in known:
        child = n["left"] if row[n["feature"]] <= n["threshold"] else n["right"]
        return tree_value(nodes, child, row, known, stats_class)
    left, right = nodes[n["left"]]["stats"].sum(), nodes[n["right"]]["stats"].sum()
    return (
        left * tree_value(nodes, n["left"], row, known, stats_class)
        + right * tree_value(nodes, n["right"], row, known, stats_class)
    ) / (left + right)


def brute_force(trees, row, features, stats_class):
    out = np.zeros(features)

    def value(known):
        return np.mean([tree_value(t, 0, row, known, stats_class) for t in trees])

    for j in range(features):
        rest = [f for f in range(features) if f != j]
        for size in range(features):
            weight = factorial(size) * factorial(features - size - 1) / factorial(features)
            for chosen in combinations(rest, size):
                out[j] += weight * (value({*chosen, j}) - value(set(chosen)))
    return out


def random_tree(rng, features, classes, depth):
    nodes = {}

    def grow(level):
        i = len(nodes)
        nodes[i] = None
        if level == depth or (level > 1 and rng.random() < 0.3):
            nodes[i] = {"left": -1, "right": -1, "feature": -1, "threshold": None, "stats": rng.integers(1, 20, classes).astype(float)}
            return i
        left, right = grow(level + 1), grow(level + 1)
        nodes[i] = {
            "left": left, "right": right, "feature": int(rng.integers(features)), "threshold": float(rng.normal()),
            "stats": nodes[left]["stats"] + nodes[right]["stats"],
        }
        return i

    grow(0)
    return nodes


def as_frame(trees):
    return pd.DataFrame(
        [{"tree": t, "id": i, **n} for t, nodes in enumerate(trees) for i, n in nodes.items()]
    )


@pytest.mark.parametrize("seed", range(4))
def test_shapley_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    features, classes = 4, 3
    trees = [random_tree(rng, features, classes, 5) for _ in range(3)]
    tables = [attribution.tree_table(tree, features, len(trees)) for _, tree in as_frame(trees).groupby("tree")]
    rows = rng.normal(size=(12, features))
    parts = [table.explain(rows, None) for table in tables]
    phi, value, base = sum(p for p, _ in parts), sum(v for _, v in parts), sum(table.base() for table in tables)
    chosen = rng.integers(0, classes, len(rows))
    own = sum(table.explain(rows, chosen)[0] for table in tables)
    assert own[:, :, 0] == pytest.approx(phi[np.arange(len(rows)), :, chosen], abs=1e-12)
    for i, row in enumerate(rows):
        for c in range(classes):
            assert phi[i, :, c] == pytest.approx(brute_force(trees, row, features, c), abs=1e-12)
            assert value[i, c] == pytest.approx(base[c] + phi[i, :, c].sum(), abs=1e-12)


def test_deep_trees_and_stumps():
    """More edges than the rows of a block hold, features that come back on the path, and a tree of one leaf."""
    rng = np.random.default_rng(9)
    trees = [random_tree(rng, 3, 2, 9), {0: {"left": -1, "right": -1, "feature": -1, "threshold": None, "stats": np.array([1.0, 3.0])}}]
    rows = rng.normal(size=(5, 3))
    for tree in trees:
        table = attribution.tree_table(as_frame([tree]), 3, 1)
        phi, value = table.explain(rows, None)
        for i, row in enumerate(rows):
            assert phi[i, :, 1] == pytest.approx(brute_force([tree], row, 3, 1), abs=1e-12)
            assert value[i, 1] == pytest.approx(table.base()[1] + phi[i, :, 1].sum(), abs=1e-12)


def test_blocks_and_tree_groups_add_up(spark, patients, surrogate, monkeypatch):
    whole = attribution.tree_tables(spark, models.forest_of(surrogate.model))
    parts = attribution.tree_tables(spark, models.forest_of(surrogate.model), limit=100)
    assert len(whole) == 1 and len(parts) > 1
    rows = surrogate.model.transform(patients.limit(50)).select(
        "patient_id", F.col("prediction").cast("int").alias("class"), vector_to_array("features").alias("vector")
    )
    a = {r["patient_id"]: r["phi"] for r in attribution.add_contributions(rows, whole).collect()}
    monkeypatch.setattr(attribution, "BLOCK_CELLS", 5000)
    b = {r["patient_id"]: r["phi"] for r in attribution.add_contributions(rows, parts).collect()}
    assert all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a) and len(a) == 50


def test_rows_that_are_alike_share_their_products():
    """A tree is walked in cases, not row by row: 20,000 rows take no long time, and a value that is no number follows no split."""
    rng = np.random.default_rng(3)
    tree = random_tree(rng, 4, 3, 12)
    table = attribution.tree_table(as_frame([tree]), 4, 1)
    rows = rng.normal(size=(20_000, 4))
    rows[7, 2] = np.nan
    started = time.perf_counter()
    phi, value = table.explain(rows, None)
    assert time.perf_counter() - started < 20
    for i in (0, 1, 19_999):
        assert phi[i, :, 1] == pytest.approx(brute_force([tree], rows[i], 4, 1), abs=1e-12)
    assert value.sum(axis=1)[7] == 0 and np.isfinite(phi).all()


def test_subtrees_give_what_leaves_give(monkeypatch):
    """Rows that no split of a subtree tells apart take its sums by one look-up, for the own class and for all, also where a
    value is no number; subtrees of any size, down to single leaves, add up to the same."""
    rng = np.random.default_rng(5)
    trees = [random_tree(rng, 4, 3, 9) for _ in range(2)]
    rows = rng.normal(size=(400, 4))
    rows[::17, 2], rows[5], rows[9, 0] = np.nan, np.nan, np.inf
    chosen = rng.integers(0, 3, 400)
    for tree in trees:
        table = attribution.tree_table(as_frame([tree]), 4, 1)
        walked = [table.explain(rows, c) for c in (None, chosen)]
        monkeypatch.setattr(attribution, "SUBTREE_ROWS", 1)
        for cases, sets, joint in ((1 << 16, 1 << 18, 4096), (40, 50, 1), (1, 1, 30)):
            for name, value in (("SUBTREE_CASES", cases), ("FOLLOWED_SETS", sets), ("JOINT_BINS", joint)):
                monkeypatch.setattr(attribution, name, value)
            for c, (phi, value) in zip((None, chosen), walked, strict=True):
                found, explained = table.explain(rows, c)
                assert np.abs(found - phi).max() < 1e-13 and np.abs(explained - value).max() < 1e-13
        assert table.explain(rows, None)[0][1, :, 1] == pytest.approx(brute_force([tree], rows[1], 4, 1), abs=1e-12)
        monkeypatch.undo()


def test_tables_dealt_by_trees(spark, patients, surrogate, monkeypatch):
    """The same contributions when tasks have a share of the trees each; equal rows stay, each on its own."""
    tables = attribution.tree_tables(spark, models.forest_of(surrogate.model))
    rows = surrogate.model.transform(patients.limit(40)).select(
        "patient_id", F.col("prediction").cast("int").alias("class"), vector_to_array("features").alias("vector")
    )
    rows = rows.union(rows).persist()
    for every in (False, True):
        monkeypatch.setattr(attribution, "FEW_ROWS", 1000)
        a = sorted(map(tuple, attribution.add_contributions(rows, tables, every).select("patient_id", "phi", "base", "explained").collect()))
        monkeypatch.setattr(attribution, "FEW_ROWS", 0)
        b = sorted(map(tuple, attribution.add_contributions(rows, tables, every).select("patient_id", "phi", "base", "explained").collect()))
        assert len(a) == len(b) == 80
        assert all(x[0] == y[0] and all(p == pytest.approx(q, abs=1e-12) for p, q in zip(x[1:], y[1:], strict=True)) for x, y in zip(a, b, strict=True))


def test_local_accuracy(patients, surrogate):
    out = attribution.tree_shap(surrogate, patients, S.ORDINAL_FEATURES)
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, e: acc + e["value"])
    worst = out.select(
        F.abs(F.col("base_value") + total - F.get("probability", F.col("class"))).alias("gap"),
        F.abs(F.col("explained_value") - F.get("probability", F.col("class"))).alias("tree_gap"),
    ).agg(F.max("gap"), F.max("tree_gap"), F.count(F.lit(1))).first()
    assert worst[0] < 1e-9 and worst[1] < 1e-9 and worst[2] == 1500


def test_classes_add_up_to_zero(patients, surrogate):
    """Probabilities sum to 1 for every row, so contributions to all classes cancel."""
    out = attribution.tree_shap_all_classes(surrogate, patients.limit(20), S.ORDINAL_FEATURES)
    sums = out.groupBy("patient_id", "feature").agg(F.abs(F.sum("value")).alias("s")).agg(F.max("s"), F.count(F.lit(1))).first()
    assert sums[0] < 1e-9 and sums[1] == 20 * 11


def test_single_patient_record(spark, surrogate):
    """The high-risk smoke patient is explained as a one-row table."""
    row = (1, 65.0, 32.5, 155.0, 180.0, 260.0, 5.5, 12.0, "Male", "High", "Sedentary", "Western", "Current")
    fields = "patient_id long, " + ", ".join(f"{c} double" for c in S.NUMERIC) + ", sex string, stress_level string, activity_level string, diet_type string, smoking string"
    record = explain.explain(surrogate, spark.createDataFrame([row], fields)).first()
    assert record["prediction"] in S.DISEASES and record["prediction"] != "Healthy"
    assert len(record["contributions"]) == 11 and len(record["explanation"].split("\n")) == 5
    magnitudes = [abs(c["value"]) for c in record["contributions"]]
    assert magnitudes == sorted(magnitudes, reverse=True)


def test_clustered_rows_are_dealt_by_their_number(spark, monkeypatch):
    """A table of one file is no single task when it is large; one that fits a task is left as it is."""
    from medlattice.plans import queries

    assert queries._cluster_input(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 1
    monkeypatch.setattr(models, "SPREAD_ROWS", 40)
    dealt = queries._cluster_input(spark, "/root/testdata/sf0.001")
    assert dealt.rdd.getNumPartitions() == -(-dealt.count() // 40) > 1
