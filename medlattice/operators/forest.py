"""Random forest on distributed rows: large nodes by histograms, the rest of a tree where its rows are.

* Rows are binned once into a table of bytes. A tree's bag is a Poisson draw per (row, tree), and the features tried at a
  node are a draw per (tree, place of the node), so neither partitions nor retries change a tree.
* A node of more than ``LOCAL_ROWS`` drawn rows is split by histograms of its tried features: every task counts its rows for
  the nodes of all trees, the counts of a node are added up and searched by one task, and one split per node reaches the
  driver.
* A smaller node is sent to one task, its rows once, and its whole subtree is grown there, level by level. So what is
  shuffled is trees times rows of a few bytes each, however deep or many the nodes are.
* As in Spark's own forest, splits maximise the Gini gain, leaves beside each other that predict the same class are merged,
  and the probability is the mean of the trees' class shares.

A tree is four arrays (feature or -1, limit, left child, class counts); the right child stands behind the left one.
Defined cases: rows that repeat with key and features share their draws; a null key is hashed like a value.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.operators.boosting import _binary, _matrix, bin_cuts
from medlattice.session import cut_lineage

#: drawn rows of a node whose subtree one task grows; histogram cells of one pass, and held at once while growing
LOCAL_ROWS, PASS_CELLS, BLOCK_CELLS = 200_000, 4_000_000, 1_000_000
#: trees whose rows a task gathers before they are sent on; nodes of a broadcast
SEND_TREES, BROADCAST_NODES = 16, 2_000_000

Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Growth:
    """How trees are bagged and grown, by the names of Spark's forest."""

    numTrees: int = 20
    maxDepth: int = 5
    maxBins: int = 32
    minInstancesPerNode: int = 1
    subsamplingRate: float = 1.0
    featureSubsetStrategy: str = "auto"
    seed: int = 42

    def tried(self, features: int) -> int:
        """Features tried at a node."""
        if self.featureSubsetStrategy not in ("auto", "sqrt", "all"):
            raise ValueError(f"unknown featureSubsetStrategy {self.featureSubsetStrategy}")
        every = self.featureSubsetStrategy == "all" or (self.featureSubsetStrategy == "auto" and self.numTrees == 1)
        return features if every else int(np.ceil(np.sqrt(features)))


# ---- draws -------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64 bits of each entry (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(how: Growth, tree: int, use: int) -> np.uint64:
    return _mixed(np.array([(how.seed << 40) + (tree << 2) + use], np.uint64))[0]


def bag(draws: np.ndarray, tree: int, how: Growth) -> np.ndarray:
    """How often each row is in the tree's bag: Poisson, by inversion; a lone tree takes every row once."""
    if how.numTrees == 1 and how.subsamplingRate == 1.0:
        return np.ones(len(draws), np.uint8)
    u = (_mixed(draws ^ _stream(how, tree, 0)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    terms = np.cumprod(np.concatenate([[1.0], how.subsamplingRate / np.arange(1, 41)]))
    return np.searchsorted(np.cumsum(terms) * np.exp(-how.subsamplingRate), u, side="right").astype(np.uint8)


def tried_features(paths: np.ndarray, tree: int, features: int, how: Growth) -> np.ndarray:
    """(nodes, tried) features of the nodes at ``paths`` (1 for the root, 2p and 2p + 1 for the children of p), ascending."""
    k = how.tried(features)
    if k >= features:
        return np.tile(np.arange(features), (len(paths), 1))
    scores = _mixed(_mixed(paths.astype(np.uint64) ^ _stream(how, tree, 1))[:, None] + np.arange(features, dtype=np.uint64))
    return np.sort(np.argpartition(scores, k - 1, axis=1)[:, :k], axis=1)


# ---- splits ------------------------------------------------------------------------------------


def counted(codes: np.ndarray, label: np.ndarray, weight: np.ndarray, slot: np.ndarray, tried: np.ndarray, bins: int, classes: int) -> np.ndarray:
    """Drawn rows (node, tried feature, bin, class) of rows that lie in the nodes ``slot``."""
    m, k = tried.shape
    at = tried[slot]
    cells = ((slot[:, None] * k + np.arange(k)) * bins + np.take_along_axis(codes, at, axis=1)) * classes + label[:, None]
    return np.bincount(cells.ravel(), np.repeat(weight.astype(np.float64), k), minlength=m * k * bins * classes).reshape(m, k, bins, classes)


def best_splits(hist: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gain, position among the tried features, last bin on the left, class counts on the left) of each node; the first of equal splits."""
    m, k, bins, classes = hist.shape
    left = hist.cumsum(axis=2)
    total = left[:, :1, -1:, :]
    right = total - left
    n_left, n_right, n = left.sum(axis=3), right.sum(axis=3), total.sum(axis=3)
    squares = [np.einsum("mkbc,mkbc->mkb", x, x) for x in (left, right, total)]
    fit = (n_left >= max(1, least)) & (n_right >= max(1, least))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fit, (squares[0] / n_left + squares[1] / n_right - squares[2] / n) / n, -1.0)
    at = gain.reshape(m, -1).argmax(axis=1)
    place, cut = at // bins, at % bins
    rows = np.arange(m)
    return gain.reshape(m, -1)[rows, at], place, cut, left[rows, place, cut]


_GAIN = 1e-12


def grow(codes: np.ndarray, label: np.ndarray, weight: np.ndarray, tree: int, path: int, depth: int, bins: int, classes: int, how: Growth) -> Tree:
    """The tree over some rows, whose root stands at ``path``; limits are bins."""
    features, k = codes.shape[1], how.tried(codes.shape[1])
    stats = [np.bincount(label, weight, classes)[None]]
    feature, limit, left = [np.full(1, -1, np.int64)], [np.zeros(1, np.int64)], [np.full(1, -1, np.int64)]
    size = 1
    paths, rows, slot = np.array([path], np.uint64), np.arange(len(codes)), np.zeros(len(codes), np.int64)
    step = max(1, BLOCK_CELLS // (k * bins * classes))
    for _ in range(depth):
        here = stats[-1]
        n = here.sum(axis=1)
        can = np.flatnonzero((here.max(axis=1) < n) & (n >= 2 * max(1, how.minInstancesPerNode)))
        if not len(can):
            break
        rank = np.full(len(here), -1, np.int64)
        rank[can] = np.arange(len(can))
        slot = rank[slot]
        rows, slot = rows[slot >= 0], slot[slot >= 0]
        order = np.argsort(slot, kind="stable")
        rows, slot = rows[order], slot[order]
        parts, goes_right, split_rank, done = [], [], np.full(len(can), -1, np.int64), 0
        for start in range(0, len(can), step):
            stop = min(start + step, len(can))
            a, b = np.searchsorted(slot, (start, stop))
            tried = tried_features(paths[can[start:stop]], tree, features, how)
            some, inside = rows[a:b], slot[a:b] - start
            gain, place, cut, on_left = best_splits(counted(codes[some], label[some], weight[some], inside, tried, bins, classes), how.minInstancesPerNode)
            chosen = tried[np.arange(stop - start), place]
            split = np.flatnonzero(gain > _GAIN)
            split_rank[start + split] = done + np.arange(len(split))
            done += len(split)
            parts.append((can[start + split], chosen[split], cut[split], on_left[split]))
            goes_right.append(codes[some, chosen[inside]] > cut[inside])
        nodes, chosen, cut, on_left = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(nodes):
            break
        at = size + 2 * np.arange(len(nodes))
        feature[-1][nodes], limit[-1][nodes], left[-1][nodes] = chosen, cut, at
        both = np.empty((2 * len(nodes), classes))
        both[0::2], both[1::2] = on_left, here[nodes] - on_left
        below = np.empty(2 * len(nodes), np.uint64)
        below[0::2], below[1::2] = paths[nodes] * np.uint64(2), paths[nodes] * np.uint64(2) + np.uint64(1)
        stats.append(both), feature.append(np.full(len(both), -1, np.int64)), limit.append(np.zeros(len(both), np.int64)), left.append(np.full(len(both), -1, np.int64))
        size, paths = size + len(both), below
        keep = split_rank[slot]
        slot = np.where(keep >= 0, 2 * keep + np.concatenate(goes_right), -1)
        rows, slot = rows[slot >= 0], slot[slot >= 0]
    return merged((np.concatenate(feature), np.concatenate(limit), np.concatenate(left), np.concatenate(stats)))


def merged(tree: Tree) -> Tree:
    """The tree whose leaves beside each other predict different classes, its nodes level by level."""
    feature, limit, left, stats = (x.copy() for x in tree)
    says = stats.argmax(axis=1)
    while True:
        inner = np.flatnonzero(feature >= 0)
        a = left[inner]
        same = inner[(feature[a] < 0) & (feature[a + 1] < 0) & (says[a] == says[a + 1])]
        if not len(same):
            break
        feature[same], left[same], limit[same] = -1, -1, 0
    order, level = [np.zeros(1, np.int64)], np.zeros(1, np.int64)
    while len(level := level[feature[level] >= 0]):
        level = np.stack([left[level], left[level] + 1], axis=1).ravel()
        order.append(level)
    order = np.concatenate(order)
    place = np.full(len(feature), -1, np.int64)
    place[order] = np.arange(len(order))
    return feature[order], limit[order], np.where(left[order] >= 0, place[left[order]], -1), stats[order]


def routed(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The node each row ends in."""
    feature, limit, left = tree[:3]
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x)) if feature[0] >= 0 else node[:0]
    while len(rows):
        at = node[rows]
        node[rows] = left[at] + (x[rows, feature[at]] > limit[at])
        rows = rows[feature[node[rows]] >= 0]
    return node


# ---- passes over the rows ----------------------------------------------------------------------

_ROW = "codes binary, label int, draw long"


def binned(encoded: DataFrame, cuts: list[np.ndarray], key: str | None) -> DataFrame:
    """Rows as bin bytes with their label and the hash that their draws come from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts))
                codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([_binary(codes), batch.column("label"), batch.column("draw")], names=["codes", "label", "draw"])

    x = vector_to_array("features")
    seen = [F.col(key)] if key and key in encoded.columns else []
    return encoded.select(x.alias("x"), F.col("label").cast("int").alias("label"), F.xxhash64(*seen, x, "label").alias("draw")).mapInArrow(run, _ROW)


def _columns(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _matrix(batch.column("codes"), np.uint8, width), batch.column("label").to_numpy(), batch.column("draw").to_numpy().view(np.uint64)


class _Top:
    """The part of a tree that is grown by passes."""

    def __init__(self, classes: int) -> None:
        self.feature, self.limit, self.left, self.path = [-1], [0], [-1], [1]
        self.stats = [np.zeros(classes)]

    def arrays(self) -> Tree:
        return np.array(self.feature), np.array(self.limit), np.array(self.left), np.stack(self.stats)

    def split(self, node: int, feature: int, cut: int, on_left: np.ndarray) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.limit[node], self.left[node] = feature, cut, at
        for right, stats in ((0, on_left), (1, self.stats[node] - on_left)):
            self.feature.append(-1), self.limit.append(0), self.left.append(-1), self.stats.append(stats)
            self.path.append(2 * self.path[node] + right)
        return at, at + 1


_SPLIT = "slot int, gain double, feature int, cut int, counts binary"


def _pass(rows: DataFrame, trees: list[_Top], wanted: list[tuple[int, int]], bins: int, classes: int, width: int, how: Growth, tasks: int) -> list:
    """(slot, gain, feature, cut, class counts on the left and in all) of each wanted (tree, node)."""
    by_tree: dict[int, list[int]] = {}
    for i, (tree, _) in enumerate(wanted):
        by_tree.setdefault(tree, []).append(i)
    plan = []
    for tree, slots in by_tree.items():
        nodes = [wanted[i][1] for i in slots]
        local = np.full(len(trees[tree].feature), -1, np.int64)
        local[nodes] = np.arange(len(nodes))
        plan.append((tree, np.array(slots), local, trees[tree].arrays(), tried_features(np.array([trees[tree].path[n] for n in nodes], np.uint64), tree, width, how)))
    tried_of = {int(i): p[4][j] for p in plan for j, i in enumerate(p[1])}
    shared = rows.sparkSession.sparkContext.broadcast((plan, tried_of))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, label, draws = _columns(batch, width)
            for tree, _, local, top, tried in shared.value[0]:
                weight = bag(draws, tree, how)
                slot = local[routed(top, codes)]
                some = np.flatnonzero((slot >= 0) & (weight > 0))
                found = counted(codes[some], label[some], weight[some], slot[some], tried, bins, classes)
                sums[tree] = sums[tree] + found if tree in sums else found
        for tree, slots, *_ in shared.value[0]:
            if tree in sums:
                for i, part in zip(slots.tolist(), sums[tree], strict=True):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.astype(np.int64).tobytes()], pa.binary())], names=["slot", "counts"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums = None, None

        def close() -> pa.RecordBatch:
            tried = shared.value[1][key]
            hist = sums.reshape(1, len(tried), bins, classes).astype(np.float64)
            gain, place, cut, on_left = best_splits(hist, how.minInstancesPerNode)
            both = np.concatenate([on_left[0], hist[0, 0].sum(axis=0)])
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int32()), pa.array(gain), pa.array([tried[place[0]]], pa.int32()), pa.array(cut, pa.int32()), pa.array([both.tobytes()], pa.binary())],
                names=["slot", "gain", "feature", "cut", "counts"],
            )

        for batch in batches:
            for slot, part in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                part = np.frombuffer(part, np.int64)
                if slot != key:
                    if key is not None:
                        yield close()
                    key, sums = slot, part.copy()
                else:
                    sums += part
        if key is not None:
            yield close()

    parts = rows.mapInArrow(count, "slot int, counts binary").repartition(min(tasks, len(wanted)), "slot").sortWithinPartitions("slot")
    found = parts.mapInArrow(search, _SPLIT).collect()
    shared.destroy()
    return found


_SUBTREE = "tree int, node int, feature binary, cut binary, left binary, counts binary"


def _finish(rows: DataFrame, trees: list[_Top], open_: list[list[int]], bins: int, classes: int, width: int, how: Growth, tasks: int) -> list:
    """The subtree of each open node, grown by one task from the node's rows."""
    plan = []
    for tree, nodes in enumerate(open_):
        if nodes:
            local = np.full(len(trees[tree].feature), -1, np.int64)
            local[nodes] = nodes
            plan.append((tree, local, trees[tree].arrays()))
    paths = {(tree, node): trees[tree].path[node] for tree, nodes in enumerate(open_) for node in nodes}
    shared = rows.sparkSession.sparkContext.broadcast((plan, paths))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(out: list[tuple]) -> pa.RecordBatch:
            tree, node, data = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(node, pa.int32()), pa.array(data, pa.binary())], names=["tree", "node", "data"])

        for batch in batches:
            if not batch.num_rows:
                continue
            codes, label, draws = _columns(batch, width)
            out: list[tuple] = []
            for done, (tree, local, top) in enumerate(shared.value[0], 1):
                weight = bag(draws, tree, how)
                node = local[routed(top, codes)]
                some = np.flatnonzero((node >= 0) & (weight > 0))
                some = some[np.argsort(node[some], kind="stable")]
                data = np.concatenate([codes[some], label[some, None].astype(np.uint8), weight[some, None]], axis=1)
                cuts = np.flatnonzero(np.diff(node[some])) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(some)], strict=True):
                    if b > a:
                        out.append((tree, int(node[some[a]]), data[a:b].tobytes()))
                if out and done % SEND_TREES == 0:
                    yield result(out)
                    out = []
            if out:
                yield result(out)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(held), np.uint8).reshape(-1, width + 2)
            path = shared.value[1][key]
            # rows arrive in any order; counts, and so the tree, do not depend on it
            feature, cut, left, stats = grow(
                np.ascontiguousarray(data[:, :width]), data[:, width].astype(np.int64), data[:, width + 1], key[0], path, how.maxDepth - path.bit_length() + 1, bins, classes, how
            )
            values = (feature.astype(np.int16), cut.astype(np.uint8), left.astype(np.int32), stats.astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in values]],
                names=["tree", "node", "feature", "cut", "left", "counts"],
            )

        for batch in batches:
            for tree, node, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (tree, node) != key:
                    if key is not None:
                        yield close()
                    key, held = (tree, node), []
                held.append(data)
        if key is not None:
            yield close()

    groups = sum(map(len, open_))
    parts = rows.mapInArrow(send, "tree int, node int, data binary").repartition(max(1, min(tasks, groups)), "tree", "node").sortWithinPartitions("tree", "node")
    found = parts.mapInArrow(finish, _SUBTREE).collect()
    shared.destroy()
    return found


def fit(encoded: DataFrame, classes: int, how: Growth, key: str | None = None) -> ForestModel:
    """A forest from rows with ``label`` and ``features``."""
    if how.maxBins > 256 or classes > 256:
        raise ValueError("at most 256 bins and classes")
    cuts = bin_cuts(encoded, how.maxBins)
    if not cuts:
        raise ValueError("no rows to fit")
    width, bins = len(cuts), max(len(c) for c in cuts) + 1
    rows = cut_lineage(binned(encoded, cuts, key), "forest-rows")
    shares = np.zeros(classes)
    for r in rows.groupBy("label").count().collect():
        shares[r["label"]] = r["count"]
    count = int(shares.sum())
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    trees = [_Top(classes) for _ in range(how.numTrees)]
    open_: list[list[int]] = [[] for _ in trees]
    wanted = [(t, 0) for t in range(len(trees))] if count * how.subsamplingRate > LOCAL_ROWS and how.maxDepth else []
    if not wanted:
        open_ = [[0] for _ in trees]
    step = max(1, PASS_CELLS // (how.tried(width) * bins * classes))
    while wanted:
        below: list[tuple[int, int]] = []
        for start in range(0, len(wanted), step):
            some = wanted[start : start + step]
            for r in _pass(rows, trees, some, bins, classes, width, how, 4 * parallel):
                (t, node), both = some[r["slot"]], np.frombuffer(r["counts"])
                trees[t].stats[node] = both[classes:]
                if r["gain"] <= _GAIN:
                    continue
                for child in trees[t].split(node, r["feature"], r["cut"], both[:classes]):
                    stats = trees[t].stats[child]
                    if trees[t].path[child].bit_length() > how.maxDepth or stats.max() == stats.sum():
                        continue
                    if stats.sum() > LOCAL_ROWS:
                        below.append((t, child))
                    else:
                        open_[t].append(child)
        wanted = sorted(below)
    subtrees: list[list] = [[] for _ in trees]
    # a task of about 32 MB of rows, and trees spread over all cores
    tasks = max(8 * parallel, int(count * how.numTrees * (width + 2) / (32 << 20)))
    for r in _finish(rows, trees, open_, bins, classes, width, how, tasks) if any(open_) else []:
        subtrees[r["tree"]].append(r)
    for top, parts in zip(trees, subtrees, strict=True):
        if not parts and not top.stats[0].any():
            # a bag that drew no row says what the table says
            top.stats[0] = shares
    return ForestModel.of([_whole(top, sorted(parts, key=lambda r: r["node"]), classes, cuts) for top, parts in zip(trees, subtrees, strict=True)], width, classes)


def _whole(top: _Top, parts: list, classes: int, cuts: list[np.ndarray]) -> Tree:
    """One tree from its top and its subtrees, with values as limits."""
    arrays = [[x] for x in top.arrays()]
    size = len(top.feature)
    for r in parts:
        part = [np.frombuffer(r["feature"], np.int16), np.frombuffer(r["cut"], np.uint8), np.frombuffer(r["left"], np.int32), np.frombuffer(r["counts"], np.int32).reshape(-1, classes)]
        left = np.where(part[2] >= 0, part[2].astype(np.int64) + size - 1, -1)
        for one, value in zip(arrays, (part[0], part[1], left, part[3]), strict=True):
            one[0][r["node"]] = value[0]
            one.append(value[1:])
        size += len(part[0]) - 1
    feature, cut, left, stats = merged(tuple(np.concatenate(x) for x in arrays))
    limit = np.zeros(len(feature))
    for f, c in enumerate(cuts):
        at = feature == f
        limit[at] = c[cut[at].astype(np.int64)]
    return feature.astype(np.int16), limit, left.astype(np.int32), stats.astype(np.int32)


class BaggedForest(Estimator):
    """``fit`` as an estimator over ``label``, ``features`` and, if there is one, a key."""

    def __init__(self, classes: int, how: Growth, key: str | None = None) -> None:
        super().__init__()
        self.classes, self.how, self.key = classes, how, key

    def _fit(self, dataset: DataFrame) -> ForestModel:
        return fit(dataset, self.classes, self.how, self.key)


# ---- the model as a pipeline stage -------------------------------------------------------------


class ForestModel(Transformer, HasFeaturesCol, HasRawPredictionCol, HasProbabilityCol, HasPredictionCol, MLReadable, MLWritable):
    """Fitted trees; saved as parameters and a table of one row per tree."""

    numFeatures = Param(Params._dummy(), "numFeatures", "slots of a feature vector", TypeConverters.toInt)
    numClasses = Param(Params._dummy(), "numClasses", "classes", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", rawPredictionCol="rawPrediction", probabilityCol="probability", predictionCol="prediction", numFeatures=None, numClasses=None):
        super().__init__()
        self._setDefault(featuresCol="features", rawPredictionCol="rawPrediction", probabilityCol="probability", predictionCol="prediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.trees: list[Tree] = []

    @classmethod
    def of(cls, trees: list[Tree], features: int, classes: int) -> ForestModel:
        model = cls(numFeatures=features, numClasses=classes)
        model.trees = trees
        return model

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Gini gain times rows per feature, each tree scaled to one, then the sum of the trees."""
        total = np.zeros(self.getOrDefault(self.numFeatures))
        for feature, _, left, stats in self.trees:
            inner = np.flatnonzero(feature >= 0)
            score = (stats.astype(np.float64) ** 2).sum(axis=1) / np.maximum(stats.sum(axis=1), 1)
            gain = score[left[inner]] + score[left[inner] + 1] - score[inner]
            one = np.bincount(feature[inner], gain, len(total))
            total += one / one.sum() if one.sum() > 0 else 0.0
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def groups(self, limit: int) -> list[list[int]]:
        """Numbers of the trees in groups of at most ``limit`` nodes, or of one larger tree."""
        out, filled = [[]], 0
        for i, tree in enumerate(self.trees):
            if out[-1] and filled + len(tree[0]) > limit:
                out.append([])
                filled = 0
            out[-1].append(i)
            filled += len(tree[0])
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        context, classes = dataset.sparkSession.sparkContext, self.getOrDefault(self.numClasses)
        shared = [context.broadcast([self.trees[i] for i in group]) for group in self.groups(BROADCAST_NODES)]

        @F.pandas_udf("array<double>")
        def votes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                if len(batch) == 0:
                    yield pd.Series([], dtype=object)
                    continue
                x = np.stack(batch.to_numpy())
                out = np.zeros((len(x), classes))
                for group in shared:
                    for tree in group.value:
                        counts = tree[3][routed(tree, x)].astype(np.float64)
                        out += counts / counts.sum(axis=1, keepdims=True)
                yield pd.Series(list(out))

        scored = dataset.withColumn("_votes", votes(vector_to_array(F.col(self.getFeaturesCol()))))
        total = F.aggregate("_votes", F.lit(0.0), lambda a, v: a + v)
        return scored.withColumns({
            self.getRawPredictionCol(): array_to_vector("_votes"),
            self.getProbabilityCol(): array_to_vector(F.transform("_votes", lambda v: v / total)),
            self.getPredictionCol(): (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double"),
        }).drop("_votes")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: ForestModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        rows = [(i, *[x.tobytes() for x in tree]) for i, tree in enumerate(self.instance.trees)]
        self.sparkSession.createDataFrame(rows, "tree int, feature binary, threshold binary, left binary, counts binary").write.parquet(f"{path}/data")


class _Reader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        classes = model.getOrDefault(model.numClasses)
        rows = sorted(self.sparkSession.read.parquet(f"{path}/data").collect(), key=lambda r: r["tree"])
        model.trees = [
            (np.frombuffer(r["feature"], np.int16), np.frombuffer(r["threshold"]), np.frombuffer(r["left"], np.int32), np.frombuffer(r["counts"], np.int32).reshape(-1, classes))
            for r in rows
        ]
        return model
