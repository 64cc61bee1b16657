"""Tree Shapley values for whole tables.

The path-dependent Shapley value of feature j in one leaf with value v is

    v (o_j - z_j) * integral over t in [0, 1] of prod_{i != j} (z_i (1 - t) + o_i t)

where z_i is the share of training rows that follow feature i's splits on the path and o_i says
whether the explained row does. The product runs over the features of the path only. It is kept as
its values at the nodes of a Gauss-Legendre quadrature, which is exact for it.

* What a leaf gives depends only on which features of its path a row follows, so its products are made once for each such
  set, not per row.
* A tree is cut into subtrees that see few different rows: all values between two of the subtree's splits are alike, as are
  all outside its box. A subtree's sums are made once for each case of these that occurs; a row takes them by one look-up. So
  the cost per row is a look-up per subtree, not per split, the less the more rows are taken together.
* Few rows, or paths of many features, are taken down the tree in cases: two rows that have followed the splits of the same
  features so far are alike in all that is below. Up the tree the tables of two subtrees are added up for the pairs of
  cases that occur, as long as these are few. Only compact edge tables travel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medlattice.operators.forest import ForestModel, Tree
from medlattice.operators.models import Trained, forest_of, with_probability
from medlattice.session import cut_lineage, scratch_path

#: edges broadcast at a time; a single larger tree is broadcast alone
BROADCAST_EDGES = 2_000_000

#: cells of a (rows, features) block worked on at a time inside a task
BLOCK_CELLS = 1_000_000

#: pairs of cases that are looked up to join two subtrees; rows that a joined case has at least, on average
CASE_CELLS, ROWS_A_CASE = 1 << 20, 4

#: cases that the splits of a subtree can tell apart; sets of followed features whose sums are held at once
SUBTREE_CASES, FOLLOWED_SETS = 1 << 16, 1 << 18

#: rows of a block, and features of a path at most, that are explained by subtrees
SUBTREE_ROWS, SUBTREE_FEATURES = 4_096, 12

#: rows that a task explains together; tables of this many rows at most are not dealt by trees
TASK_ROWS, FEW_ROWS = 65_536, 1_000

#: rows whose sums are added at a time; values of joint bins of features
SLICE_ROWS, JOINT_BINS = 2_048, 4_096

_RESULTS = ("phi", "base", "explained")


@dataclass(frozen=True)
class TreeTable:
    """One tree; position 0 is the root, the levels follow each other, siblings stand together.

    An edge is named by its lower end. ``low < x <= high`` holds for all splits of its feature on the path so far,
    ``share`` is the product of their row shares; ``prior`` is the earlier edge with the same feature, 0 if none.
    ``leaf`` numbers the rows of ``value``, the leaves' class shares divided by the trees of the forest.
    """

    parent: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    prior: np.ndarray
    leaf: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    levels: np.ndarray
    depth: int

    def base(self) -> np.ndarray:
        return self.weight @ self.value

    def explain(self, rows: np.ndarray, chosen: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(contributions[row, feature, class], explained[row, class]) of the classes in ``chosen`` (row), or of all."""
        n, width = rows.shape
        many = self.value.shape[1] if chosen is None else 1
        first = np.full(len(self.parent), -1)
        first[self.parent[1::2]] = np.arange(1, len(self.parent), 2)
        sums = np.zeros((n, (width + 1) * many))
        step = max(1, BLOCK_CELLS // (width + 1))
        for start in range(0, n, step):
            block = slice(start, start + step)
            some, codes = rows[block], None if chosen is None else chosen[block]
            if len(some) < SUBTREE_ROWS or self.depth > SUBTREE_FEATURES:
                _Walk(self, first, some, codes, sums[block]).run()
            elif codes is None:
                _Subtrees(self, first, some, None, sums[block]).run()
            else:
                # rows of a class behind each other, as a look-up stays in the part of a table that is its class's
                order = np.argsort(codes, kind="stable")
                found = np.zeros((len(some), width + 1))
                _Subtrees(self, first, some[order], codes[order], found).run()
                sums[block][order] = found
        return sums[:, : width * many].reshape(n, width, many), sums[:, width * many :]


class _Walk:
    """One tree and a block of rows. ``state`` numbers the cases that occur at a node: the bits of the features whose splits
    a row has followed so far, above them its class. A subtree's result is a case per row and a table of their sums."""

    def __init__(self, table: TreeTable, first: np.ndarray, rows: np.ndarray, chosen: np.ndarray | None, sums: np.ndarray) -> None:
        self.table, self.first, self.sums = table, first, sums
        self.columns = np.ascontiguousarray(rows.T)
        self.width, self.each = rows.shape[1], chosen is not None
        # a value that is no number follows no split
        seen = (~np.isnan(rows)) @ (1 << np.arange(self.width))
        self.start = seen if chosen is None else seen + (chosen.astype(np.int64) << self.width)

    def run(self) -> None:
        state, rows = np.unique(self.start, return_inverse=True)
        self._add(self._below(0, rows, state, {}))

    def _add(self, result: tuple[np.ndarray, np.ndarray] | None) -> None:
        if result is not None:
            rows, table = result
            # in slices that stay in a core's cache
            for at in range(0, len(rows), SLICE_ROWS):
                part = slice(at, at + SLICE_ROWS)
                self.sums[part] += table.take(rows[part], axis=0)

    def _below(self, at: int, rows: np.ndarray, state: np.ndarray, share: dict[int, float]) -> tuple[np.ndarray, np.ndarray] | None:
        """Result of the subtree at ``at`` for rows of these cases, None if it was added to the sums already."""
        left = self.first[at]
        if left < 0:
            return rows, self._leaf(at, state, share)
        feature = self.table.feature[left]
        bit = 1 << int(feature)
        goes = rows << 1
        goes |= self.columns[feature] <= self.table.high[left]
        met = np.zeros(2 * len(state), bool)
        met[goes] = True
        met = np.flatnonzero(met)
        had, on_left = state[met >> 1], (met & 1).astype(bool)
        sides = []
        for edge, follows in ((left, on_left), (left + 1, ~on_left)):
            known, place = np.unique(np.where(follows, had, had & ~bit), return_inverse=True)
            sides.append((edge, known, place, {**share, int(feature): self.table.share[edge]}))
        number = np.empty(2 * len(state), np.int64)
        if self.first[left] < 0 and self.first[left + 1] < 0:
            number[met] = np.arange(len(met))
            return number[goes], sum(self._leaf(edge, known, path)[place] for edge, known, place, path in sides)
        results = []
        for edge, known, place, path in sides:
            number[met] = place
            results.append(self._below(edge, number[goes], known, path))
        return self._joined(*results)

    def _joined(self, a: tuple[np.ndarray, np.ndarray] | None, b: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Both results as one, as long as their rows fall in few cases together."""
        if a is not None and b is not None and len(a[1]) * len(b[1]) <= min(CASE_CELLS, 16 * len(a[0])):
            both = a[0] * len(b[1])
            both += b[0]
            met = np.zeros(len(a[1]) * len(b[1]), bool)
            met[both] = True
            met = np.flatnonzero(met)
            if len(met) * ROWS_A_CASE <= len(both):
                number = np.empty(len(a[1]) * len(b[1]), np.int64)
                number[met] = np.arange(len(met))
                return number[both], a[1][met // len(b[1])] + b[1][met % len(b[1])]
        self._add(a)
        self._add(b)
        return None

    def _leaf(self, at: int, state: np.ndarray, share: dict[int, float]) -> np.ndarray:
        """What the leaf adds to each feature and class, and to the explained value, for each case."""
        value = self.table.value[self.table.leaf[at]]
        value = value[state >> self.width][:, None] if self.each else np.broadcast_to(value, (len(state), len(value)))
        parts = np.zeros((len(state), self.width + 1))
        inside = np.ones(len(state), bool)
        if share:
            t, w = _nodes(max(1, (len(share) + 1) // 2))
            features, z = np.array(list(share)), np.array(list(share.values()))
            case, place = np.unique(state & ((1 << self.width) - 1), return_inverse=True)
            follows = (case[:, None] >> features) & 1
            factor = (z[:, None] * (1 - t))[None] + follows[:, :, None] * t
            product = factor.prod(axis=1) * w
            found = np.zeros((len(case), self.width))
            found[:, features] = (follows - z) * (product[:, None] / factor).sum(axis=2)
            parts[:, :-1], inside = found[place], follows.all(axis=1)[place]
        parts[:, -1] = inside
        return (parts[:, :, None] * value[:, None]).reshape(len(state), -1)


class _Subtrees:
    """One tree and a block of rows. A value is known by its *bin*, the number of the tree's splits of its feature below it;
    a value that is no number has the bin behind the last. The box of a node is kept in bins."""

    def __init__(self, table: TreeTable, first: np.ndarray, rows: np.ndarray, chosen: np.ndarray | None, sums: np.ndarray) -> None:
        self.table, self.first, self.chosen, self.sums = table, first, chosen, sums
        self.rows, self.width = rows.shape
        size, width, feature = len(table.parent), self.width, table.feature
        # the last edge of each feature on a node's path
        self.last = np.zeros((size, width), np.int64)
        for a, b in zip(table.levels[:-1], table.levels[1:], strict=True):
            self.last[a:b] = self.last[table.parent[a:b]]
            self.last[np.arange(a, b), feature[a:b]] = np.arange(a, b)
        left = np.arange(1, size, 2)
        cuts = [np.unique(table.high[left][feature[left] == f]) for f in range(width)]
        self.counts = np.array([len(c) for c in cuts])
        self.offsets = np.cumsum(self.counts) - self.counts
        self.low, self.high = np.full(size, -1), np.zeros(size, np.int64)
        empty, bins = np.zeros(width, bool), []
        for f, c in enumerate(cuts):
            bins.append(np.searchsorted(c, rows[:, f], side="left"))
            missing = np.isnan(rows[:, f])
            bins[f][missing] = len(c) + 1
            empty[f] = missing.any()
            edges = 1 + np.flatnonzero(feature[1:] == f)
            self.low[edges] = np.where(np.isneginf(table.low[edges]), -1, np.searchsorted(c, table.low[edges]))
            self.high[edges] = np.where(np.isposinf(table.high[edges]), len(c), np.searchsorted(c, table.high[edges]))
        self.joint = self._joint(bins)
        # the splits below each node, and how many ranges of a feature they tell apart, with the one outside its box
        self.used = np.zeros((size, int(self.counts.sum())), bool)
        self.used[table.parent[left], self.offsets[feature[left]] + self.high[left]] = True
        for a, b in zip(table.levels[-2::-1], table.levels[:0:-1], strict=True):
            at = np.arange(a, b, 2)
            self.used[table.parent[at]] |= self.used[at] | self.used[at + 1]
        below = np.stack([self.used[:, a : a + n].sum(axis=1) for a, n in zip(self.offsets, self.counts, strict=True)], axis=1)
        self.states = below + 1 + ((self.last > 0) | (empty & (below > 0)))

    def _joint(self, bins: list[np.ndarray]) -> list[tuple[list[int], np.ndarray]]:
        """(features, their bins as one number), so that a look-up serves several features."""
        out: list[tuple[list[int], np.ndarray]] = []
        sizes: list[int] = []
        for f in np.argsort(-self.counts, kind="stable").tolist():
            size = int(self.counts[f]) + 2
            at = next((i for i, known in enumerate(sizes) if known * size <= JOINT_BINS), None)
            if at is None:
                out.append(([f], bins[f])), sizes.append(size)
            else:
                out[at] = ([*out[at][0], f], out[at][1] * size + bins[f])
                sizes[at] *= size
        return out

    def run(self) -> None:
        small = (np.log2(self.states).sum(axis=1) <= np.log2(SUBTREE_CASES) + 1e-9) | (self.first < 0)
        self.code, self.part = np.empty(self.rows, np.int64), np.empty(self.rows, np.int64)
        held: list[tuple[int, np.ndarray]] = []
        sets, stack = 0, [0]
        while stack:
            at = stack.pop()
            if not small[at]:
                stack += [self.first[at], self.first[at] + 1]
                continue
            leaves = self._leaves(at)
            more = int((1 << (self.last[leaves] > 0).sum(axis=1)).sum())
            if held and sets + more > FOLLOWED_SETS:
                self._add(held)
                held, sets = [], 0
            held.append((at, leaves))
            sets += more
        self._add(held)

    def _leaves(self, at: int) -> np.ndarray:
        out, level = [], np.array([at])
        while len(level):
            below = self.first[level]
            out.append(level[below < 0])
            below = below[below >= 0]
            level = np.concatenate([below, below + 1])
        return np.concatenate(out)

    def _add(self, held: list[tuple[int, np.ndarray]]) -> None:
        """Add what the subtrees (root, leaves) give to the rows' sums."""
        starts, bits, parts = self._sets(np.concatenate([leaves for _, leaves in held]))
        done = 0
        for at, leaves in held:
            mine = slice(done, done + len(leaves))
            done += len(leaves)
            cases, place = self._cases(at, leaves, starts[mine], bits[mine])
            value = self.table.value[self.table.leaf[leaves]]
            found = parts.take(place.ravel(), axis=0).reshape(len(leaves), -1)
            if self.chosen is None:
                table = (found.T @ value).reshape(place.shape[1], -1)
            else:
                table = (value.T @ found).reshape(-1, self.width + 1)
                cases += np.multiply(self.chosen, place.shape[1], out=self.part)
            # in slices that stay in a core's cache
            step = max(1, SLICE_ROWS * (self.width + 1) // self.sums.shape[1])
            for start in range(0, self.rows, step):
                part = slice(start, start + step)
                self.sums[part] += table.take(cases[part], axis=0)

    def _sets(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first row of each leaf, bit of each feature on its path, what a leaf of value one adds to each feature and to the
        explained value, a row for each set of followed features)."""
        on = self.last[leaves] > 0
        count = on.sum(axis=1)
        starts = np.cumsum(1 << count) - (1 << count)
        bits = np.where(on, 1 << np.maximum(np.cumsum(on, axis=1) - 1, 0), 0)
        out = np.zeros((int((1 << count).sum()), self.width + 1))
        out[starts + (1 << count) - 1, self.width] = 1.0
        for k in np.unique(count[count > 0]).tolist():
            some = np.flatnonzero(count == k)
            features = np.nonzero(on[some])[1].reshape(-1, k)
            z = self.table.share[self.last[leaves[some][:, None], features]]
            t, w = _nodes(max(1, (k + 1) // 2))
            # (leaf, feature, followed or not, node)
            factor = z[:, :, None, None] * (1 - t) + np.arange(2)[:, None] * t
            product = np.broadcast_to(w, (len(some), 1, len(w)))
            for p in range(k):
                product = (factor[:, p, :, None] * product[:, None]).reshape(len(some), -1, len(w))
            weight = (np.arange(2) - z[:, :, None])[..., None] / factor
            found = (product @ weight.reshape(len(some), 2 * k, -1).transpose(0, 2, 1)).reshape(len(some), -1, k, 2)
            sets = np.arange(1 << k)
            for p in range(k):
                out[starts[some][:, None] + sets, features[:, p][:, None]] = np.where(sets >> p & 1, found[:, :, p, 1], found[:, :, p, 0])
        return starts, bits, out

    def _cases(self, at: int, leaves: np.ndarray, starts: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(case of each row at the subtree, the set of followed features (leaf, case))."""
        size, place, luts = 1, starts[:, None], {}
        for f in np.flatnonzero(self.states[at] > 1).tolist():
            bins = np.arange(self.counts[f] + 2)
            cuts = np.flatnonzero(self.used[at, self.offsets[f] : self.offsets[f] + self.counts[f]])
            edge = self.last[at, f]
            low, high = (self.low[edge], self.high[edge]) if edge else (-1, self.counts[f])
            ranges = np.searchsorted(cuts, bins)
            ranges[(bins <= low) | (bins > high)] = len(cuts) + 1
            luts[f] = ranges * size
            # a bin of each range; the last is outside
            one = np.concatenate([cuts, [high, self.counts[f] + 1]])[: self.states[at, f]]
            edges = self.last[leaves, f]
            follows = (one > self.low[edges][:, None]) & (one <= np.where(edges, self.high[edges], self.counts[f] + 1)[:, None])
            place = ((follows * bits[:, f, None])[:, :, None] + place[:, None]).reshape(len(leaves), -1)
            size *= len(one)
        cases = self.code
        cases[:] = 0
        for features, joint in self.joint:
            if any(f in luts for f in features):
                lut = reduce(np.add.outer, [luts.get(f, np.zeros(self.counts[f] + 2, np.int64)) for f in features]).ravel()
                cases += lut.take(joint, out=self.part, mode="clip")
        if size * 32 <= self.rows:
            return cases, place
        met = np.zeros(size, bool)
        met[cases] = True
        met = np.flatnonzero(met)
        number = np.zeros(size, np.int64)
        number[met] = np.arange(len(met))
        self.code, self.part = number.take(cases, out=self.part, mode="clip"), self.code
        return self.code, place[:, met]


@cache
def _nodes(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and weights of the quadrature on [0, 1]."""
    t, w = np.polynomial.legendre.leggauss(count)
    return (t + 1.0) / 2.0, w / 2.0


def tree_table(tree: pd.DataFrame, features: int, trees: int) -> TreeTable:
    """Edges of one tree from its nodes: id, left, right (-1 for a leaf), feature, threshold, stats (class weights)."""
    tree = tree.sort_values("id")
    left, right, split = (tree[c].to_numpy(np.int64) for c in ("left", "right", "feature"))
    limit = tree["threshold"].to_numpy(np.float64)
    stats = np.stack(tree["stats"].to_numpy()).astype(np.float64)
    cover = stats.sum(axis=1)
    place = {int(i): k for k, i in enumerate(tree["id"])}
    position = np.vectorize(lambda i: place.get(int(i), -1), otypes=[np.int64])
    left, right = position(left), position(right)
    # per level: rows of ``tree``, their positions, and the last edge on their path for each feature
    at, where, last = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros((1, features), np.int64)
    columns: dict[str, list[np.ndarray]] = {"node": [at], "parent": [at], "feature": [at], "low": [np.full(1, -np.inf)], "high": [np.full(1, np.inf)], "share": [np.ones(1)], "prior": [at]}
    levels, depth, size = [1], 1, 1
    while True:
        inner = np.flatnonzero(left[at] >= 0)
        if not len(inner):
            break
        low, high, share = (np.concatenate(columns[c]) for c in ("low", "high", "share"))
        nodes = np.stack([left[at[inner]], right[at[inner]]], axis=1).ravel()
        above = np.repeat(inner, 2)
        feature, threshold = split[at[above]], limit[at[above]]
        prior = last[above, feature]
        goes_left = np.arange(len(nodes)) % 2 == 0
        # an edge without an earlier one of its feature starts from the root's open box
        columns["node"].append(nodes), columns["parent"].append(where[above]), columns["feature"].append(feature), columns["prior"].append(prior)
        columns["low"].append(np.where(goes_left, low[prior], np.maximum(low[prior], threshold)))
        columns["high"].append(np.where(goes_left, np.minimum(high[prior], threshold), high[prior]))
        columns["share"].append(share[prior] * cover[nodes] / cover[at[above]])
        last = last[above]
        where = np.arange(size, size + len(nodes))
        last[np.arange(len(nodes)), feature] = where
        at = nodes
        size += len(nodes)
        levels.append(size)
        depth = max(depth, int((last > 0).sum(axis=1).max()))
    joined = {c: np.concatenate(v) for c, v in columns.items()}
    node = joined["node"]
    is_leaf = left[node] < 0
    leaf = np.where(is_leaf, np.cumsum(is_leaf) - 1, -1)
    ends = node[is_leaf]
    return TreeTable(
        joined["parent"], joined["feature"], joined["low"], joined["high"], joined["share"], joined["prior"], leaf,
        stats[ends] / (cover[ends] * trees)[:, None], cover[ends] / cover[node[0]], np.array(levels), depth,
    )


def _node_rows(tree: Tree) -> pd.DataFrame:
    """A tree's nodes as ``tree_table`` takes them."""
    feature, threshold, left, stats = tree
    right = np.where(left >= 0, left + 1, -1)
    return pd.DataFrame({"id": np.arange(len(left)), "left": left, "right": right, "feature": feature, "threshold": threshold, "stats": list(stats)})


def saved_nodes(spark: SparkSession, model) -> DataFrame:
    """Node rows of a tree ensemble, read back from its saved form."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["split"]["numCategories"].alias("categories"), node["impurityStats"].alias("stats"),
    )


def tree_tables(spark: SparkSession, model, limit: int = BROADCAST_EDGES) -> list[list[TreeTable]]:
    """Tables of a forest's trees in groups of at most ``limit`` edges (a single tree may exceed it only
    if the tree alone does). Node rows are read one group of trees at a time."""
    if isinstance(model, ForestModel):
        features = model.getOrDefault(model.numFeatures)
        return [[tree_table(_node_rows(model.trees[i]), features, model.getNumTrees) for i in group] for group in model.groups(limit)]
    nodes = saved_nodes(spark, model).persist()
    try:
        if nodes.filter(F.col("categories") > 0).limit(1).count():
            raise ValueError("categorical splits are not supported; encode categories as numbers")
        sizes = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).orderBy("tree").collect()
        features, trees = model.numFeatures, model.getNumTrees
        groups: list[list[int]] = [[]]
        filled = 0
        for row in sizes:
            if groups[-1] and filled + row["n"] > limit:
                groups.append([])
                filled = 0
            groups[-1].append(row["tree"])
            filled += row["n"]
        out = []
        for group in groups:
            rows = nodes.filter(F.col("tree").isin(group)).drop("categories").toPandas()
            out.append([tree_table(tree, features, trees) for _, tree in rows.groupby("tree", sort=True)])
        return out
    finally:
        nodes.unpersist()


def add_contributions(df: DataFrame, groups: Sequence[Sequence[TreeTable]], all_classes: bool = False) -> DataFrame:
    """Append ``phi`` (flat array), ``base`` and ``explained`` (arrays) for rows with a
    ``vector`` array and a ``class`` code.

    With ``all_classes`` the arrays cover every class, feature-major; otherwise the row's own
    class only. A tree's cost per row falls with the rows that a task explains together: a table of fewer blocks of
    ``TASK_ROWS`` rows than cores is dealt by trees too, each task with a share of the trees, whose results are added up
    per row. Any other table takes one narrow pass for all trees.
    """
    spark = df.sparkSession
    out = df.withColumns({c: F.lit(None).cast("array<double>") for c in _RESULTS})
    shared = [spark.sparkContext.broadcast(list(tables)) for tables in groups]
    rows, trees = df.count(), sum(len(tables) for tables in groups)
    blocks = -(-rows // TASK_ROWS)
    # three tasks a core, so that none is waited for long
    wanted = 3 * spark.sparkContext.defaultParallelism
    parts = min(trees, -(-wanted // blocks)) if rows > FEW_ROWS else 1
    if parts == 1:
        return out.mapInPandas(_explainer(shared, all_classes, 0, 1), out.schema)
    numbered = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()), "explained-rows")
    dealt = numbered.select("_row", "vector", "class").repartition(blocks, "_row")
    dealt = dealt.withColumns({c: F.lit(None).cast("array<double>") for c in _RESULTS})
    found = [dealt.mapInPandas(_explainer(shared, all_classes, part, parts), dealt.schema).withColumn("_part", F.lit(part)) for part in range(parts)]
    # always added up in the same order
    whole = reduce(DataFrame.unionAll, found).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_part", *_RESULTS))).alias("parts"))
    whole = whole.select("_row", *[_added("parts", c).alias(c) for c in _RESULTS])
    return numbered.join(whole, "_row").select(*out.columns)


def _added(parts: str, name: str) -> Column:
    """The arrays ``name`` of all parts, added up place by place."""
    arrays = F.transform(parts, lambda p: p[name])
    return F.aggregate(F.slice(arrays, 2, F.size(arrays)), F.get(arrays, F.lit(0)), lambda acc, more: F.zip_with(acc, more, lambda a, b: a + b))


def _explainer(shared: list, all_classes: bool, part: int, parts: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Fills ``phi``, ``base`` and ``explained`` in by every ``parts``-th tree, from ``part`` on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = [table for group in shared for table in group.value][part::parts]
        base = sum(table.base() for table in tables)
        for batch in _in_blocks(batches):
            x = np.stack(batch["vector"].to_numpy())
            chosen = None if all_classes else batch["class"].to_numpy(dtype=int)
            phi, value = 0.0, 0.0
            for table in tables:
                more, explained = table.explain(x, chosen)
                phi, value = phi + more, value + explained
            bases = np.tile(base, (len(batch), 1)) if all_classes else base[chosen][:, None]
            for name, found in (("phi", phi.reshape(len(batch), -1)), ("base", bases), ("explained", value)):
                batch[name] = list(found)
            yield batch

    return run


def _in_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows in blocks of about ``TASK_ROWS``, none empty."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= TASK_ROWS:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if size:
        yield pd.concat(held, ignore_index=True)


def tree_shap(
    trained: Trained, df: DataFrame, names: Sequence[str], keys: Sequence[str] = ("patient_id",)
) -> DataFrame:
    """Contributions to the predicted class for every row of ``df``. The work is bound by the processor, so a large
    table of few files is best spread by its caller.

    Columns: keys, ``class``, ``prediction``, ``probability`` (array), ``base_value``,
    ``explained_value`` and ``contributions`` as array of (feature, value). The base value and
    the contributions add up to the probability of the predicted class.
    """
    scored = _scored(trained, df, keys)
    tables = tree_tables(df.sparkSession, forest_of(trained.model))
    out = add_contributions(scored, tables)
    return out.select(
        *keys, "class", "prediction", "probability", F.get("base", F.lit(0)).alias("base_value"),
        F.get("explained", F.lit(0)).alias("explained_value"), named(F.col("phi"), names).alias("contributions"),
    )


def tree_shap_all_classes(
    trained: Trained, df: DataFrame, names: Sequence[str], keys: Sequence[str] = ("patient_id",)
) -> DataFrame:
    """Contributions to every class: keys, ``class``, ``feature``, ``value``."""
    tables = tree_tables(df.sparkSession, forest_of(trained.model))
    out = add_contributions(_scored(trained, df, keys), tables, all_classes=True)
    classes = len(trained.classes)
    return out.select(*keys, F.posexplode("phi").alias("pos", "value")).select(
        *keys, (F.col("pos") % classes).cast("int").alias("class"),
        F.element_at(F.array(*[F.lit(n) for n in names]), (F.floor(F.col("pos") / classes) + 1).cast("int")).alias("feature"),
        "value",
    )


def _scored(trained: Trained, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    scored = with_probability(trained.model.transform(df))
    return scored.select(
        *keys, F.col("prediction").cast("int").alias("class"), F.col("predicted_class").alias("prediction"),
        "probability", vector_to_array("features").alias("vector"),
    )


def named(values, names: Sequence[str]):
    """An array of values as an array of (feature, value)."""
    labels = F.array(*[F.lit(n) for n in names])
    return F.zip_with(labels, values, lambda n, v: F.struct(n.alias("feature"), v.alias("value")))

