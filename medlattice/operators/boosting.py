"""Multiclass gradient boosting on distributed feature histograms, depth-wise or leaf-wise.

One round fits one tree per class to the softmax loss, all of them together:

* Rows are binned once into a table of bytes; each row carries its margin per class.
* A pass over that table gives the histograms (gradient, hessian, rows per bin) of every node that is to be split, for
  the trees of all classes. Only the smaller child of a split is counted, its sibling is the parent less the child.
* Gradients are whole numbers (multiples of 2^-24), so sums are exact: neither partitioning nor subtraction nor a
  rerun changes a tree.
* *Depth-wise* growth splits every node of a level that gains. *Leaf-wise* growth takes the leaf of the largest gain next
  until the tree has ``leaves`` leaves; a pass explores all leaves that the order known so far would take, so a tree needs
  about as many passes as it is deep, not one for each split.
* A node of at most ``LOCAL_ROWS`` rows, which is counted before, is finished in one task: its rows are sent there once
  and its subtree is grown by the same rules on the same whole numbers, so it is the tree that passes would give. Nodes are
  dealt to tasks by their rows, so that no task gets many large ones.
* A finished round moves each row's margins by one tree per class, which the next round's first pass computes on the
  way. Every ``CUT`` rounds the table is written, so a lost executor repeats a few rounds' margins at most.
* With a held-out share the loss over all classes is taken from the held rows' margins in that same first pass; boosting
  stops when it has not improved for ``patience`` rounds and keeps the trees of the best round.

What reaches the driver is bounded by parameters (classes, nodes of a pass, bins), not by rows: with many partitions the
histograms are added up by (class, feature) before they are collected.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.session import cut_lineage

SCALE = float(1 << 24)
#: rounds between written tables; histogram cells of one class in one pass; partitions whose histograms are collected as they are
CUT, PASS_CELLS, DIRECT_PARTITIONS = 16, 4_000_000, 8
#: rows of a node whose subtree one task grows
LOCAL_ROWS = 1_000_000


@dataclass(frozen=True)
class Growth:
    """How trees grow. ``leaves`` makes growth leaf-wise; ``hessian`` scales p (1 - p)."""

    rounds: int = 100
    depth: int = 10
    rate: float = 0.1
    leaves: int | None = None
    penalty: float = 1.0
    least_hessian: float = 1.0
    least_rows: int = 1
    hessian: float = 2.0
    bins: int = 255
    #: start from the log of the class shares instead of equal margins
    prior: bool = False


# ---- trees on the driver -----------------------------------------------------------------------


@dataclass
class _Tree:
    """One class's tree while it grows; ``hist`` of a node that may still be split."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    sums: list[np.ndarray] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    best: list[tuple[int, int]] = field(default_factory=list)
    hist: dict[int, np.ndarray] = field(default_factory=dict)

    def add(self, sums: np.ndarray, depth: int) -> int:
        for values, value in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.sums, sums), (self.depth, depth), (self.gain, 0.0), (self.best, (-1, -1))):
            values.append(value)
        return len(self.feature) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x, np.int32) for x in (self.feature, self.cut, self.left, self.right))


class _Bins:
    """Cut points per feature; bins of all features lie behind each other."""

    def __init__(self, cuts: list[np.ndarray]) -> None:
        self.cuts = cuts
        self.sizes = np.array([len(c) + 1 for c in cuts])
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.total = int(self.sizes.sum())
        self.feature = np.repeat(np.arange(len(cuts)), self.sizes)

    def splits(self, hist: np.ndarray, growth: Growth) -> tuple[np.ndarray, np.ndarray]:
        """(gain, bin) of the best split of each node of ``hist`` (nodes, bins, 3); the first of equal ones."""
        upto = np.cumsum(hist, axis=1)
        before = np.concatenate([np.zeros_like(upto[:, :1]), upto], axis=1)[:, self.offsets][:, self.feature]
        left = upto - before
        ends = upto[:, self.offsets + self.sizes - 1][:, self.feature] - before
        right = ends - left

        def score(x: np.ndarray) -> np.ndarray:
            return (x[..., 0] / SCALE) ** 2 / (x[..., 1] / SCALE + growth.penalty + 1e-16)

        fit = (left[..., 2] >= growth.least_rows) & (right[..., 2] >= growth.least_rows)
        fit &= (np.minimum(left[..., 1], right[..., 1]) >= growth.least_hessian * SCALE) & (left[..., 2] > 0) & (right[..., 2] > 0)
        gain = np.where(fit, score(left) + score(right) - score(ends), -np.inf)
        at = gain.argmax(axis=1)
        return gain[np.arange(len(gain)), at], at


def _explore(tree: _Tree, growth: Growth) -> tuple[list[int], list[int]]:
    """(nodes to expand next, nodes whose split is in the tree so far)."""
    if growth.leaves is None:
        wanted = [i for i in range(len(tree.gain)) if tree.gain[i] > 0 and tree.left[i] < 0]
        return wanted, [i for i in range(len(tree.gain)) if tree.left[i] >= 0]
    heap = [(-tree.gain[0], 0)] if tree.gain[0] > 0 else []
    taken, wanted = [], []
    while heap and len(taken) < growth.leaves - 1:
        _, node = heapq.heappop(heap)
        taken.append(node)
        if tree.left[node] < 0:
            wanted.append(node)
            continue
        for child in (tree.left[node], tree.right[node]):
            if tree.gain[child] > 0:
                heapq.heappush(heap, (-tree.gain[child], child))
    return wanted, taken


# ---- passes over the rows ----------------------------------------------------------------------

_ROW = "bins binary, label int, held boolean, margin binary"


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """A fixed-width binary column as a matrix, without copying it."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return np.frombuffer(data.tobytes(), kind).reshape(len(column), width)


def _binary(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as a binary column."""
    n, width = len(values), values.dtype.itemsize * values.shape[1]
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _routed(tree: tuple[np.ndarray, ...], bins: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
    """The node each row ends in; rows go on from ``node``, which is changed, if it is given."""
    feature, cut, left, right = tree
    if node is None:
        node = np.zeros(len(bins), np.int32)
        rows = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
    else:
        rows = np.flatnonzero(feature[node] >= 0)
    while len(rows):
        at = node[rows]
        goes = bins[rows, feature[at]] <= cut[at]
        node[rows] = np.where(goes, left[at], right[at])
        rows = rows[feature[node[rows]] >= 0]
    return node


def softmax(margin: np.ndarray) -> np.ndarray:
    powers = np.exp(margin - margin.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def gradients(margin: np.ndarray, label: np.ndarray, hessian: float) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number gradients and hessians (rows, classes) of the softmax loss."""
    p = softmax(margin)
    h = np.rint(np.maximum(hessian * p * (1 - p), 1e-6) * SCALE)
    p[np.arange(len(p)), label] -= 1
    return np.rint(p * SCALE), h


def _histograms(state: DataFrame, trees: list[_Tree], wanted: list[list[int]], bins: _Bins, growth: Growth, loss: bool, reduce: bool) -> tuple[list[np.ndarray], np.ndarray]:
    """(per class the histograms (node, bin, 3) of its wanted nodes, (loss, rows) of the training and of the held rows).
    ``reduce`` adds up the partitions' histograms before they are collected."""
    classes, width = len(trees), len(bins.cuts)
    arrays = [t.arrays() for t in trees]
    slots = []
    for tree, nodes in zip(trees, wanted, strict=True):
        slot = np.full(len(tree.feature), -1, np.int64)
        slot[nodes] = np.arange(len(nodes))
        slots.append(slot)
    offsets, total, sizes, hessian = bins.offsets, bins.total, bins.sizes, growth.hessian

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((3, int(s.max(initial=-1)) + 1, total)) for s in slots]
        losses = np.zeros(4, np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            codes = _matrix(batch.column("bins"), np.uint8, width)
            label, held = batch.column("label").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False)
            margin = _matrix(batch.column("margin"), np.float64, classes)
            g, h = gradients(margin, label, hessian)
            if loss:
                each = -np.log(np.maximum(softmax(margin)[np.arange(n), label], 1e-300))
                each = np.rint(each * (1 << 20)).astype(np.int64)
                losses += [each[~held].sum(), (~held).sum(), each[held].sum(), held.sum()]
            for k in range(classes):
                if not sums[k].size:
                    continue
                slot = slots[k][_routed(arrays[k], codes)]
                rows = np.flatnonzero((slot >= 0) & ~held)
                cells = (slot[rows, None] * total + offsets + codes[rows]).ravel()
                size = sums[k][0].size
                for i, weight in enumerate((g[rows, k], h[rows, k], None)):
                    counted = np.bincount(cells, None if weight is None else np.repeat(weight, width), minlength=size)
                    sums[k][i] += counted.reshape(sums[k][i].shape)
        out: list[tuple] = [(-1, 0, losses.tobytes(), b"")] if loss else []
        for k in range(classes):
            for f in range(width if sums[k].size else 0):
                part = sums[k][:, :, offsets[f] : offsets[f] + sizes[f]].reshape(3, -1)
                at = np.flatnonzero(part[2])
                out.append((k, f, at.astype(np.int64).tobytes(), part[:, at].astype(np.int64).tobytes()))
        yield _rows(out)

    partial = state.mapInArrow(run, "cls int, feature int, at binary, sums binary")
    if reduce:
        partial = partial.repartition("cls", "feature").sortWithinPartitions("cls", "feature").mapInArrow(_added, "cls int, feature int, at binary, sums binary")
    found = [np.zeros((len(nodes), total, 3), np.int64) for nodes in wanted]
    losses = np.zeros(4, np.int64)
    for cls, f, at, values in partial.collect():
        if cls < 0:
            losses += np.frombuffer(at, np.int64)
            continue
        at = np.frombuffer(at, np.int64)
        found[cls][at // sizes[f], offsets[f] + at % sizes[f]] += np.frombuffer(values, np.int64).reshape(3, -1).T
    return found, losses


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cls, feature, at, sums = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(cls, pa.int32()), pa.array(feature, pa.int32()), pa.array(at, pa.binary()), pa.array(sums, pa.binary())], names=["cls", "feature", "at", "sums"]
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of each (class, feature), which arrive behind each other."""
    key, at, sums = None, np.zeros(0, np.int64), np.zeros((3, 0), np.int64)
    for batch in batches:
        for cls, f, more_at, more in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            more_at = np.frombuffer(more_at, np.int64)
            if (cls, f) != key:
                if key:
                    yield _rows([(*key, at.tobytes(), sums.tobytes())])
                key, at, sums = (cls, f), (np.zeros(4, np.int64) if cls < 0 else more_at[:0]), np.zeros((3, 0), np.int64)
            if cls < 0:
                at = at + more_at
                continue
            every, place = np.unique(np.concatenate([at, more_at]), return_inverse=True)
            both = np.concatenate([sums, np.frombuffer(more, np.int64).reshape(3, -1)], axis=1)
            sums = np.zeros((3, len(every)), np.int64)
            np.add.at(sums.T, place, both.T)
            at = every
    if key:
        yield _rows([(*key, at.tobytes(), sums.tobytes())])


def _moved(state: DataFrame, trees: list[tuple[np.ndarray, ...]], values: list[np.ndarray], width: int) -> DataFrame:
    """Margins after one more tree per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = _matrix(batch.column("bins"), np.uint8, width)
            margin = _matrix(batch.column("margin"), np.float64, len(trees)).copy()
            for k, tree in enumerate(trees):
                margin[:, k] += values[k][_routed(tree, codes)]
            yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("label"), batch.column("held"), _binary(margin)], names=["bins", "label", "held", "margin"])

    return state.mapInArrow(run, _ROW)


# ---- fitting -----------------------------------------------------------------------------------


def bin_cuts(encoded: DataFrame, bins: int) -> list[np.ndarray]:
    """Cut points of every slot: quantiles of its values, at most ``bins`` of them, the largest left out."""
    slots = encoded.select(F.posexplode(vector_to_array("features")).alias("slot", "x"))
    shares = [i / bins for i in range(1, bins + 1)]
    found = slots.groupBy("slot").agg(F.percentile_approx("x", shares, 20_000).alias("q")).orderBy("slot").collect()
    return [np.unique(r["q"])[:-1] for r in found]


def binned(encoded: DataFrame, bins: _Bins, start: np.ndarray, held: str | None = None) -> DataFrame:
    """Rows as bin bytes with label, held-out flag and starting margins."""
    cuts = bins.cuts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts))
            codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([_binary(codes), batch.column("label"), batch.column("held"), _binary(np.tile(start, (n, 1)))], names=["bins", "label", "held", "margin"])

    rows = encoded.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label"), (F.col(held) if held else F.lit(False)).alias("held"))
    return rows.mapInArrow(run, _ROW)


def _known(tree: _Tree, nodes: list[int], hist: np.ndarray, bins: _Bins, growth: Growth) -> None:
    gain, at = bins.splits(hist, growth)
    for i, node in enumerate(nodes):
        tree.gain[node], tree.best[node] = float(gain[i]), (int(bins.feature[at[i]]), int(at[i]))
        if gain[i] > 0:
            tree.hist[node] = hist[i]


def _expanded(trees: list[_Tree], bins: _Bins, growth: Growth, counted: Callable[[list[list[int]]], list[np.ndarray]], local: int) -> list[list[int]]:
    """Grow ``trees`` by histograms from ``counted`` (wanted nodes per tree) as far as they go. Children of which both
    have at most ``local`` rows are left to others and returned per tree."""
    left_over: list[list[int]] = [[] for _ in trees]
    while True:
        wanted: list[list[int]] = []
        siblings: list[dict[int, tuple[int, int]]] = []
        any_split = False
        for tree, over in zip(trees, left_over, strict=True):
            count, other = [], {}
            for node in _explore(tree, growth)[0]:
                any_split = True
                f, at = tree.best[node]
                hist = tree.hist[node]
                left_sums = hist[bins.offsets[f] : at + 1].sum(axis=0)
                depth = tree.depth[node] + 1
                left, right = tree.add(left_sums, depth), tree.add(tree.sums[node] - left_sums, depth)
                tree.feature[node], tree.cut[node], tree.left[node], tree.right[node] = f, at - int(bins.offsets[f]), left, right
                small, large = (left, right) if tree.sums[left][2] <= tree.sums[right][2] else (right, left)
                if depth < growth.depth and tree.sums[large][2] > local:
                    count.append(small)
                    other[small] = (large, node)
                    continue
                del tree.hist[node]
                if depth < growth.depth:
                    over += [left, right]
            wanted.append(count), siblings.append(other)
        if not any_split:
            return left_over
        step = max(1, PASS_CELLS // bins.total)
        while any(wanted):
            now, wanted = [w[:step] for w in wanted], [w[step:] for w in wanted]
            hists = counted(now)
            for tree, nodes, other, hist in zip(trees, now, siblings, hists, strict=True):
                if nodes:
                    rest = np.stack([tree.hist.pop(other[s][1]) for s in nodes]) - hist
                    _known(tree, nodes, hist, bins, growth)
                    _known(tree, [other[s][0] for s in nodes], rest, bins, growth)


def _subtree(codes: np.ndarray, g: np.ndarray, h: np.ndarray, bins: _Bins, growth: Growth) -> _Tree:
    """The tree over some rows, grown where they are."""
    tree = _Tree()
    columns, node = np.ascontiguousarray(codes.T), np.zeros(len(codes), np.int32)

    def counted(wanted: list[list[int]]) -> list[np.ndarray]:
        nodes = wanted[0]
        slot = np.full(len(tree.feature), -1, np.int64)
        slot[nodes] = np.arange(len(nodes))
        # rows wait where they were counted last
        slot = slot[_routed(tree.arrays(), codes, node)]
        rows = np.flatnonzero(slot >= 0)
        slot, weights = slot[rows], (g[rows], h[rows], None)
        found = np.empty((len(nodes), bins.total, 3), np.int64)
        for column, offset, size in zip(columns, bins.offsets, bins.sizes, strict=True):
            cells = slot * size + column[rows]
            for i, weight in enumerate(weights):
                found[:, offset : offset + size, i] = np.bincount(cells, weight, minlength=len(nodes) * size).reshape(-1, size)
        return [found]

    tree.add(np.array([g.sum(), h.sum(), len(g)]).astype(np.int64), 0)
    if growth.depth:
        _known(tree, [0], counted([[0]])[0], bins, growth)
        _expanded([tree], bins, growth, counted, 0)
    return tree


_SUBTREE = "cls int, node int, shape binary, sums binary, gain binary"


def _places(sizes: dict[tuple[int, int], int], tasks: int) -> dict[tuple[int, int], int]:
    """A task for each node, the largest first to the task of the fewest rows."""
    heap = [(0, i) for i in range(tasks)]
    place = {}
    for key in sorted(sizes, key=lambda k: (-sizes[k], k)):
        filled, i = heap[0]
        place[key] = i
        heapq.heapreplace(heap, (filled + sizes[key] + 1, i))
    return place


def _subtrees(state: DataFrame, trees: list[_Tree], wanted: list[list[int]], bins: _Bins, growth: Growth, loss: bool) -> np.ndarray:
    """Attach to each wanted node the subtree that one task grows from its rows; returns the losses like ``_histograms``."""
    classes, width = len(trees), len(bins.cuts)
    arrays = [t.arrays() for t in trees]
    depths = {(k, node): trees[k].depth[node] for k in range(classes) for node in wanted[k]}
    tasks = min(len(depths), 4 * state.sparkSession.sparkContext.defaultParallelism)
    # losses go to the first task
    places = _places({(k, node): int(trees[k].sums[node][2]) for k, node in depths}, tasks) | {(-1, 0): 0}
    picks = []
    for k in range(classes):
        pick = np.zeros(len(trees[k].feature), bool)
        pick[wanted[k]] = True
        picks.append(pick)
    hessian = growth.hessian

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            codes = _matrix(batch.column("bins"), np.uint8, width)
            label, held = batch.column("label").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False)
            margin = _matrix(batch.column("margin"), np.float64, classes)
            g, h = gradients(margin, label, hessian)
            out: list[tuple] = []
            if loss:
                each = -np.log(np.maximum(softmax(margin)[np.arange(n), label], 1e-300))
                each = np.rint(each * (1 << 20)).astype(np.int64)
                out.append((-1, 0, np.array([each[~held].sum(), (~held).sum(), each[held].sum(), held.sum()], np.int64).tobytes(), b""))
            for k in range(classes):
                if not wanted[k]:
                    continue
                node = _routed(arrays[k], codes)
                rows = np.flatnonzero(picks[k][node] & ~held)
                rows = rows[np.argsort(node[rows], kind="stable")]
                for part in np.split(rows, np.flatnonzero(np.diff(node[rows])) + 1):
                    if len(part):
                        out.append((k, int(node[part[0]]), codes[part].tobytes(), np.stack([g[part, k], h[part, k]], axis=1).astype(np.int32).tobytes()))
            if out:
                yield _rows(out).append_column("place", pa.array([places[c, n] for c, n, *_ in out], pa.int32()))

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, codes, weights = None, [], []

        def close() -> pa.RecordBatch:
            cls, node = key
            if cls < 0:
                sums = np.sum([np.frombuffer(c, np.int64) for c in codes], axis=0)
                values = (b"", sums.tobytes(), b"")
            else:
                x, w = np.frombuffer(b"".join(codes), np.uint8).reshape(-1, width), np.frombuffer(b"".join(weights), np.int32).reshape(-1, 2)
                tree = _subtree(x, w[:, 0].astype(np.float64), w[:, 1].astype(np.float64), bins, replace(growth, depth=growth.depth - depths[key]))
                shape = np.array([tree.feature, tree.cut, tree.left, tree.right, tree.depth], np.int32)
                values = (shape.tobytes(), np.array(tree.sums, np.int64).tobytes(), np.array(tree.gain).tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([cls], pa.int32()), pa.array([node], pa.int32()), *[pa.array([v], pa.binary()) for v in values]], names=["cls", "node", "shape", "sums", "gain"]
            )

        for batch in batches:
            for cls, node, x, w in zip(*[c.to_pylist() for c in batch.columns[:4]], strict=True):
                if (cls, node) != key:
                    if key:
                        yield close()
                    key, codes, weights = (cls, node), [], []
                codes.append(x), weights.append(w)
        if key:
            yield close()

    parts = state.mapInArrow(sent, "cls int, feature int, at binary, sums binary, place int").repartitionById(tasks, "place").sortWithinPartitions("cls", "feature")
    losses = np.zeros(4, np.int64)
    for cls, node, shape, sums, gain in parts.mapInArrow(grown, _SUBTREE).collect():
        sums = np.frombuffer(sums, np.int64)
        if cls < 0:
            losses += sums
            continue
        tree, first = trees[cls], len(trees[cls].feature) - 1
        feature, cut, left, right, depth = np.frombuffer(shape, np.int32).reshape(5, -1).tolist()
        at_depth, sums = tree.depth[node], sums.reshape(-1, 3)

        def moved(child: int, first: int = first) -> int:
            return child + first if child >= 0 else -1

        for i in range(1, len(feature)):
            tree.add(sums[i], at_depth + depth[i])
        for i, gained in enumerate(np.frombuffer(gain).tolist()):
            k = first + i if i else node
            tree.feature[k], tree.cut[k], tree.left[k], tree.right[k], tree.gain[k], tree.sums[k] = feature[i], cut[i], moved(left[i]), moved(right[i]), gained, sums[i]
    return losses


def _grown(state: DataFrame, classes: int, bins: _Bins, growth: Growth, reduce: bool, rows: int) -> tuple[list[_Tree], np.ndarray]:
    """The trees of one round, with the splits that are in them, and the losses before it."""
    trees = [_Tree() for _ in range(classes)]
    for tree in trees:
        tree.add(np.zeros(3, np.int64), 0)
    if rows <= LOCAL_ROWS:
        return trees, _subtrees(state, trees, [[0]] * classes, bins, growth, True)
    hists, losses = _histograms(state, trees, [[0]] * classes, bins, growth, True, reduce)
    for tree, hist in zip(trees, hists, strict=True):
        tree.sums[0] = hist[0][: bins.sizes[0]].sum(axis=0)
        _known(tree, [0], hist, bins, growth)
    while any(over := _expanded(trees, bins, growth, lambda now: _histograms(state, trees, now, bins, growth, False, reduce)[0], LOCAL_ROWS)):
        _subtrees(state, trees, over, bins, growth, False)
    return trees, losses


def _pruned(tree: _Tree, growth: Growth) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """(feature, cut, left, right), values and covers of the tree without explored but untaken splits."""
    taken = set(_explore(tree, growth)[1])
    order, at = [0], 0
    while at < len(order):
        node = order[at]
        at += 1
        if node in taken:
            order += [tree.left[node], tree.right[node]]
    place = {node: i for i, node in enumerate(order)}
    inner = [node in taken for node in order]
    arrays = (
        np.array([tree.feature[n] if t else -1 for n, t in zip(order, inner, strict=True)], np.int32), np.array([tree.cut[n] for n in order], np.int32),
        np.array([place[tree.left[n]] if t else -1 for n, t in zip(order, inner, strict=True)], np.int32),
        np.array([place[tree.right[n]] if t else -1 for n, t in zip(order, inner, strict=True)], np.int32),
    )
    sums = np.array([tree.sums[n] for n in order], np.float64)
    values = -sums[:, 0] / (sums[:, 1] + growth.penalty * SCALE + 1e-16) * growth.rate
    return arrays, np.where(inner, 0.0, values), sums[:, 2]


def fit(encoded: DataFrame, classes: int, growth: Growth, held: str | None = None, patience: int = 10) -> tuple[BoostedTrees, list[tuple[float, float | None]]]:
    """(model, (training loss, held-out loss) after each round) from rows with ``label`` and ``features``.

    ``held`` names a boolean column of held-out rows; without it all rounds are run. An absent class keeps its
    place and gets a small probability.
    """
    cuts = bin_cuts(encoded, growth.bins)
    if not cuts:
        raise ValueError("no rows to fit")
    bins = _Bins(cuts)
    start = np.zeros(classes)
    if growth.prior:
        training = encoded.where(~F.col(held)) if held else encoded
        counts = {int(r[0]): r[1] for r in training.groupBy("label").count().collect()}
        shares = np.array([max(counts.get(k, 0), 1e-9) for k in range(classes)], float)
        start = np.log(shares / shares.sum())
    state = cut_lineage(binned(encoded, bins, start, held), "boost-rows").persist()
    reduce = state.rdd.getNumPartitions() > DIRECT_PARTITIONS
    rows = state.where("NOT held").count()
    rounds: list[list[tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]]] = []
    history: list[tuple[float, float | None]] = []
    best, best_round = np.inf, 0
    spent: list[DataFrame] = []
    try:
        for number in range(growth.rounds + 1):
            if number == growth.rounds and held is None:
                break
            # the first pass of a round tells the loss after the round before
            last = number == growth.rounds
            trees, losses = _grown(state, classes, bins, growth, reduce, rows) if not last else ([], _losses(state, classes, bins, growth, reduce))
            for old in spent:
                old.unpersist()
            spent.clear()
            if number:
                train = losses[0] / max(1, losses[1]) / (1 << 20)
                kept = losses[2] / max(1, losses[3]) / (1 << 20) if held and losses[3] else None
                history.append((float(train), None if kept is None else float(kept)))
                if kept is not None and kept < best - 1e-9:
                    best, best_round = kept, number
                if kept is not None and number - best_round >= patience:
                    break
            if last:
                break
            rounds.append([_pruned(tree, growth) for tree in trees])
            moved = _moved(state, [t[0] for t in rounds[-1]], [t[1] for t in rounds[-1]], len(cuts))
            if (number + 1) % CUT == 0:
                moved = cut_lineage(moved, "boost-rows")
                reduce = moved.rdd.getNumPartitions() > DIRECT_PARTITIONS
            # the next pass fills the cache; the rows before it go once it has
            spent.append(state)
            state = moved.persist()
    finally:
        for old in (*spent, state):
            old.unpersist()
    if held and best_round:
        rounds = rounds[:best_round]
    return BoostedTrees.of(rounds, cuts, start), history


def _losses(state: DataFrame, classes: int, bins: _Bins, growth: Growth, reduce: bool) -> np.ndarray:
    trees = [_Tree() for _ in range(classes)]
    for tree in trees:
        tree.add(np.zeros(3, np.int64), 0)
    return _histograms(state, trees, [[] for _ in trees], bins, growth, True, reduce)[1]


class SoftmaxBooster(Estimator):
    """``fit`` as an estimator over ``label`` and ``features``."""

    def __init__(self, classes: int, growth: Growth) -> None:
        super().__init__()
        self.classes, self.growth = classes, growth

    def _fit(self, dataset: DataFrame) -> BoostedTrees:
        return fit(dataset, self.classes, self.growth)[0]


# ---- the model as a pipeline stage -------------------------------------------------------------


class BoostedTrees(Transformer, HasFeaturesCol, HasRawPredictionCol, HasProbabilityCol, HasPredictionCol, MLReadable, MLWritable):
    """Fitted trees of all rounds and classes; saved as parameters and a table of nodes."""

    start = Param(Params._dummy(), "start", "starting margin per class", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", rawPredictionCol="rawPrediction", probabilityCol="probability", predictionCol="prediction", start=None):
        super().__init__()
        self._setDefault(featuresCol="features", rawPredictionCol="rawPrediction", probabilityCol="probability", predictionCol="prediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.nodes: pd.DataFrame | None = None

    @classmethod
    def of(cls, rounds: list, cuts: list[np.ndarray], start: np.ndarray) -> BoostedTrees:
        parts = []
        for r, trees in enumerate(rounds):
            for k, ((feature, cut, left, right), value, cover) in enumerate(trees):
                limit = np.array([cuts[f][c] if f >= 0 else 0.0 for f, c in zip(feature, cut, strict=True)])
                parts.append(pd.DataFrame({
                    "round": r, "cls": k, "node": np.arange(len(feature)), "feature": feature, "limit": limit, "left": left, "right": right, "value": value, "cover": cover,
                }))
        model = cls(start=[float(x) for x in start])
        columns = {"round": "int32", "cls": "int32", "node": "int32", "feature": "int32", "limit": "float64", "left": "int32", "right": "int32", "value": "float64", "cover": "float64"}
        model.nodes = (pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=list(columns))).astype(columns)
        return model

    @property
    def num_rounds(self) -> int:
        return 0 if self.nodes.empty else int(self.nodes["round"].max()) + 1

    @property
    def num_leaves(self) -> int:
        return int((self.nodes["feature"] < 0).sum())

    def trees(self) -> list[tuple[int, tuple[np.ndarray, ...]]]:
        """(class, (feature, limit, left, right, value)) of every tree, by round."""
        return [
            (int(cls), tuple(tree[c].to_numpy() for c in ("feature", "limit", "left", "right", "value")))
            for (_, cls), tree in self.nodes.groupby(["round", "cls"], sort=True)
        ]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast((self.trees(), np.array(self.getOrDefault(self.start))))

        @F.pandas_udf("array<double>")
        def margins(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            trees, start = shared.value
            for batch in batches:
                if len(batch) == 0:
                    yield pd.Series([], dtype=object)
                    continue
                x = np.stack(batch.to_numpy())
                out = np.tile(start, (len(x), 1))
                for k, (feature, limit, left, right, value) in trees:
                    node = np.zeros(len(x), np.int64)
                    rows = np.arange(len(x)) if feature[0] >= 0 else node[:0]
                    while len(rows):
                        at = node[rows]
                        node[rows] = np.where(x[rows, feature[at]] <= limit[at], left[at], right[at])
                        rows = rows[feature[node[rows]] >= 0]
                    out[:, k] += value[node]
                yield pd.Series(list(out))

        scored = dataset.withColumn("_margins", margins(vector_to_array(F.col(self.getFeaturesCol()))))
        top = F.array_max("_margins")
        powers = F.transform("_margins", lambda m: F.exp(m - top))
        scored = scored.withColumn("_powers", powers)
        total = F.aggregate("_powers", F.lit(0.0), lambda a, v: a + v)
        scored = scored.withColumns({
            self.getRawPredictionCol(): array_to_vector("_margins"),
            self.getProbabilityCol(): array_to_vector(F.transform("_powers", lambda v: v / total)),
            self.getPredictionCol(): (F.array_position("_margins", top) - 1).cast("double"),
        })
        return scored.drop("_margins", "_powers")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: BoostedTrees) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        schema = "round int, cls int, node int, feature int, limit double, left int, right int, value double, cover double"
        self.sparkSession.createDataFrame(self.instance.nodes, schema).write.parquet(f"{path}/data")


class _Reader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> BoostedTrees:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.nodes = self.sparkSession.read.parquet(f"{path}/data").toPandas().sort_values(["round", "cls", "node"], ignore_index=True)
        return model
