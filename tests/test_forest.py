from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from medlattice.operators import forest, models, split

HOW = forest.Growth(numTrees=6, maxDepth=7, minInstancesPerNode=2, subsamplingRate=0.8)


@pytest.fixture(scope="module")
def encoded(patients):
    return models.encode_training(patients, "disease", "coded")[1].persist()


def _plain(codes, label, weight, tree, path, depth, bins, classes, how):
    """(path, feature, cut) of every split, node by node."""
    n = np.bincount(label, weight, classes)
    if depth == 0 or n.max() == n.sum():
        return {}, n
    best = (1e-12, None)
    for f in forest.tried_features(np.array([path], np.uint64), tree, codes.shape[1], how)[0]:
        for cut in range(bins):
            on = codes[:, f] <= cut
            a, b = np.bincount(label[on], weight[on], classes), np.bincount(label[~on], weight[~on], classes)
            if min(a.sum(), b.sum()) < how.minInstancesPerNode:
                continue
            gain = (n.sum() - (n**2).sum() / n.sum() - a.sum() + (a**2).sum() / a.sum() - b.sum() + (b**2).sum() / b.sum()) / n.sum()
            if gain > best[0] + 1e-12:
                best = (gain, (int(f), cut, on))
    if best[1] is None:
        return {}, n
    f, cut, on = best[1]
    found, says = {path: (f, cut)}, []
    for right, part in ((0, on), (1, ~on)):
        below, counts = _plain(codes[part], label[part], weight[part], tree, 2 * path + right, depth - 1, bins, classes, how)
        found |= below
        says.append((below, counts.argmax()))
    if not says[0][0] and not says[1][0] and says[0][1] == says[1][1]:
        return {}, n
    return found, n


def test_grown_tree_is_the_plain_one():
    rng = np.random.default_rng(1)
    codes, label = rng.integers(0, 9, (400, 6)).astype(np.uint8), rng.integers(0, 3, 400)
    label[codes[:, 2] > 5] = 1
    weight = rng.integers(1, 4, 400).astype(np.uint8)
    for tree in range(4):
        feature, cut, left, stats = forest.grow(codes, label, weight, tree, 1, 6, 9, 3, HOW)
        ours, paths = {}, {0: 1}
        for i in range(len(feature)):
            if feature[i] >= 0:
                ours[paths[i]] = (int(feature[i]), int(cut[i]))
                paths[int(left[i])], paths[int(left[i]) + 1] = 2 * paths[i], 2 * paths[i] + 1
                assert (stats[i] == stats[left[i]] + stats[left[i] + 1]).all()
        assert ours == _plain(codes, label, weight, tree, 1, 6, 9, 3, HOW)[0]


def test_trees_do_not_depend_on_partitions_or_passes(encoded, monkeypatch):
    def trees(rows):
        return [[x.tolist() for x in tree] for tree in forest.fit(rows, 11, HOW, "patient_id").trees]

    one = trees(encoded)
    assert trees(encoded.repartition(3)) == one
    # large nodes by passes of few cells, then one task each
    monkeypatch.setattr(forest, "LOCAL_ROWS", 150)
    monkeypatch.setattr(forest, "PASS_CELLS", 20_000)
    passed = forest.fit(encoded, 11, HOW, "patient_id").trees

    def splits(tree, node=0, path=1):
        feature, limit, left, stats = tree
        if feature[node] < 0:
            return {path: tuple(stats[node])}
        return {path: (int(feature[node]), float(limit[node]))} | splits(tree, left[node], 2 * path) | splits(tree, left[node] + 1, 2 * path + 1)

    monkeypatch.undo()
    assert [splits(t) for t in passed] == [splits(t) for t in forest.fit(encoded, 11, HOW, "patient_id").trees]
    assert all(len(t[0]) == 1 for t in forest.fit(encoded, 11, forest.Growth(numTrees=2, maxDepth=0), "patient_id").trees)


def test_what_is_shuffled_follows_the_rows_not_the_nodes(encoded):
    """Fits in seconds where histograms of every node and partition were shuffled before: 120 deep trees over 64 partitions."""
    how = forest.Growth(numTrees=120, maxDepth=15, maxBins=64, featureSubsetStrategy="sqrt")
    model = forest.fit(encoded.repartition(64), 11, how, "patient_id")
    assert model.getNumTrees == 120 and max(len(t[0]) for t in model.trees) > 100


def test_as_accurate_as_sparks_forest(spark, patients):
    from pyspark.ml.classification import RandomForestClassifier

    data = split.hash_split(patients)
    train, test = data.filter("is_train").drop("is_train"), data.filter("not is_train").drop("is_train")
    features, rows = models.encode_training(train, "disease", "production")
    held = models.encode.label_indexer("disease", models.S.CLASSES["disease"]).transform(features.transform(test))
    settings = {"numTrees": 40, "maxDepth": 10, "minInstancesPerNode": 2}
    ours = forest.fit(rows, 11, forest.Growth(**settings), "patient_id").transform(held)
    theirs = RandomForestClassifier(seed=42, **settings).fit(rows).transform(held)
    right = [x.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] for x in (ours, theirs)]
    assert right[0] > right[1] - 0.03


def test_odd_rows(spark):
    data = [(None, 0.0, Vectors.dense(1.0, 5.0))] * 5 + [(1, 1.0, Vectors.dense(2.0, 5.0))] * 5
    rows = spark.createDataFrame(data, ["patient_id", "label", "features"])
    model = forest.fit(rows, 3, forest.Growth(numTrees=9, maxDepth=3, featureSubsetStrategy="all"), "patient_id")
    scored = model.transform(rows).select("label", "prediction", vector_to_array("probability").alias("p")).collect()
    assert all(abs(sum(r["p"]) - 1) < 1e-9 and len(r["p"]) == 3 for r in scored)
    # repeated rows are drawn together, so a bag may lack a class
    assert model.featureImportances.toArray()[1] == 0
    with pytest.raises(ValueError):
        forest.fit(rows.limit(0), 3, HOW, "patient_id")
