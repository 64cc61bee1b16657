"""Jaccard join on word n-grams by T-occurrence search over inverted lists.

Two texts link when the sets of their ``WORDS``-word shingles have a Jaccard similarity of ``PERCENT`` hundredths or
more. Texts with equal sets are one *node*. A set of n shingles shares at least T = ceil(0.8 n) of them with a partner.

* Which nodes can have a partner: of the first ``n - T + k`` shingles in the order of their hashes, k have to be shared
  with any partner, so a node with fewer shared ones is alone. Only these shingles of all texts are listed.
* The shingles of the other nodes are listed whole; those in one node are dropped, the others are ordered by the
  length of their lists. A partner is met in one of the ``n - T + 1`` shortest lists, unshared ones counted; of a pair, the
  smaller set meets the other within an even shorter prefix, because it shares more than 8/9 of itself.
* A list is no source of all its pairs. Its most central node, whose shingles are in the longest lists, is the query
  against the others, then its next ``MORE`` - 1 against what is left in other components, then ``MORE`` times as many, until
  each pair of a list was searched or is connected. Lists that hold one component are closed.
* T-occurrence search of one query against the nodes it meets, in blocks: the query's lists are divided (DivideSkip) into
  long ones and short ones; the short ones are merged with a heap, nodes that occur often enough are looked up in
  the long ones by binary search, and those that reach the overlap link. Counts are exact, so the search decides.

Shingles are told apart by 64 hashed bits, sets by 64 bits and their size.

Defined cases: a text with fewer words than a shingle is one shingle; null, empty and blank texts have no shingles and
link with nothing, so their component is their own id; repeated rows share a component; a null ``doc_id`` is kept, and its
component is the smallest known id of it (null if there is none); an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from heapq import merge
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlattice.llm.common import cut_lineage, in_slices, in_small_batches, row_key, utf8
from medlattice.llm.simhash import roots
from medlattice.session import broadcast_if_small

WORDS, PERCENT = 5, 80
#: shingles looked at beyond the prefix, as a share of the set: the more, the fewer nodes are left, the more are listed
EXTRA = 8
#: lists longer than this count as equally long; nodes of one search block; lenders broadcast at most
LONG, BLOCK, BROADCAST_ROWS = 4096, 2048, 200_000
#: shingles of the nodes searched at once, which bounds a task's memory whatever the texts' lengths are
BLOCK_SHINGLES = 1 << 18
#: growth of the queries of a list from round to round; edges of forests merged in one step at most
MORE, FEW_EDGES = 8, 1 << 20
#: weight of a binary search against a step of the merge, when lists are divided
MU = 0.01
_SLICE = 1 << 20
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


# ---- shingle sets ------------------------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * (out[-1:] * _MIX[2])])
    return out[:n]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[ord("A") : ord("Z") + 1] += np.uint64(32)


def word_hashes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every lower-cased word, words before each text and after the last) of some texts' bytes."""
    inside = ~_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < len(raw)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    counts = np.searchsorted(starts, ends)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    word = np.cumsum(begins) - 1
    place = np.arange(len(raw)) - starts[np.maximum(word, 0)]
    place[~inside] = 0
    terms = _LOWER[raw] * _powers(int(place.max()) + 1)[place]
    terms[~inside] = 0
    return _mixed(np.add.reduceat(terms, starts)), counts


def shingle_sets(raw: np.ndarray, ends: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(raw, ends)
    factors = _powers(k + 1)[1:]
    windows = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for i in range(k):
        windows += words[i : i + len(windows)] * factors[i]
    windows = _mixed(windows)
    out = []
    for a, b in zip(counts[:-1].tolist(), counts[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(windows[a : b - k + 1]))
        elif b > a:
            out.append(_mixed((words[a:b] * factors[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(windows[:0])
    return out


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of ``n`` shares with any partner."""
    return -(-percent * n // 100)


def _extra(n: int) -> int:
    return max(1, n // EXTRA)


def least_shared(n: int, percent: int = PERCENT) -> int:
    """Shingles among the listed ones that a set of ``n`` shares with any partner: the smallest partner lists fewest."""
    return _extra(least_overlap(n, percent))


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    """Hash arrays as an Arrow list column; None stays null."""
    sizes = [len(r) if r is not None else 0 for r in rows]
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    some = [r for r in rows if r is not None]
    flat = np.concatenate(some) if some else np.zeros(0, np.uint64)
    mask = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)), mask=mask)


def _sets(docs: DataFrame, k: int, percent: int, whole: bool) -> DataFrame:
    """``doc_id``, ``h`` (hash of the text), ``node``, ``n`` and ``tokens`` of every row of ``docs`` (doc_id, h, text).

    ``tokens`` are the first shingles by hash, or all if ``whole``; null where the partition gave them already, and
    for sets too small to have a partner that differs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for part in in_slices(batch, "text", _SLICE):
                sets = shingle_sets(*utf8(part.column("text")), k)
                nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                tokens: list[np.ndarray | None] = []
                for node, s in zip(nodes.tolist(), sets, strict=True):
                    n = len(s)
                    new = node not in given and n > 0 and 100 * n >= percent * (n + 1)
                    tokens.append((s if whole else s[: n - least_overlap(n, percent) + _extra(n)]) if new else None)
                    given.add(node)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("h"), pa.array(nodes), pa.array([len(s) for s in sets], pa.int64()), _lists(tokens)],
                    names=["doc_id", "h", "node", "n", "tokens"],
                )

    return in_small_batches(docs).mapInArrow(run, "doc_id long, h long, node long, n long, tokens array<long>")


# ---- shared shingles ---------------------------------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(token, node, size) of the rows of every list with two nodes or more, from rows sorted by (token, node).

    ``size`` is the length of the list, or ``limit`` beyond it: a longer list is passed on as it comes.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    passing: tuple[int, int] | None = None  # (token, last node) of a list over the limit
    for batch in batches:
        token, node = batch.column("token").to_numpy(), batch.column("node").to_numpy()
        if held:
            token, node = np.concatenate([held[0][0], token]), np.concatenate([held[0][1], node])
            held = []
        if not len(token):
            continue
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        if passing and token[0] == passing[0] and node[0] == passing[1]:
            new[0] = False
        token, node = token[new], node[new]
        if not len(token):
            continue
        starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        sizes = np.diff(np.append(starts, len(token)))
        if passing and token[0] == passing[0]:
            sizes[0] = limit
        else:
            passing = None
        # the last list may go on in the next batch
        if sizes[-1] < limit:
            held = [(token[starts[-1] :], node[starts[-1] :])]
            token, node, starts, sizes = token[: starts[-1]], node[: starts[-1]], starts[:-1], sizes[:-1]
            passing = None
        else:
            passing = (int(token[-1]), int(node[-1]))
        if len(token):
            size = np.repeat(np.minimum(sizes, limit), np.diff(np.append(starts, len(token))))
            yield token[size > 1], node[size > 1], size[size > 1]
    if held and len(held[0][0]) > 1:
        token, node = held[0]
        yield token, node, np.full(len(token), len(token))


def _dealt(tokens: DataFrame) -> DataFrame:
    return tokens.repartition("token").sortWithinPartitions("token", "node")


def _shared_counts(listed: DataFrame) -> DataFrame:
    """(node, shared): how many of a node's listed shingles are in another node's list too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, node, _ in _runs(batches, LONG):
            nodes, counts = np.unique(node, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(counts)], names=["node", "shared"])

    return _dealt(listed).mapInArrow(run, "node long, shared long").groupBy("node").agg(F.sum("shared").alias("shared"))


def _shared_tokens(listed: DataFrame) -> DataFrame:
    """(node, token, size) of the shingles that two nodes or more hold, with the length of their lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, node, size in _runs(batches, LONG):
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(token), pa.array(size.astype(np.int32))], names=["node", "token", "size"])

    return _dealt(listed).mapInArrow(run, "node long, token long, size int")


# ---- T-occurrence search -----------------------------------------------------------------------


def required(a: int, b: int, percent: int = PERCENT) -> int:
    """Least overlap of linked sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def divide_skip(query: np.ndarray, size: int, others: Sequence[tuple[int, np.ndarray]], percent: int = PERCENT) -> list[tuple[int, int]]:
    """(position, overlap) of the sets of ``others`` (size, sorted shared shingles) that link with the query.

    ``query`` holds the sorted shared shingles of a set of ``size``.
    """
    need = np.array([required(size, n, percent) for n, _ in others])
    lengths = [len(s) for _, s in others]
    flat = np.concatenate([s for _, s in others]) if others else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(others)), lengths)
    at = np.searchsorted(query, flat)
    hit = at < len(query)
    hit[hit] = query[at[hit]] == flat[hit]
    order = np.argsort(at[hit], kind="stable")
    owner = owner[hit][order]
    counts = np.bincount(at[hit], minlength=len(query))
    stops = np.cumsum(counts)
    # inverted lists of the query's shingles, the shortest first
    by_length = [i for i in np.argsort(counts, kind="stable").tolist() if counts[i]]
    if not by_length:
        return []
    least = int(need.min())
    longest = int(counts.max())
    n_long = min(least - 1, int(least / (MU * log2(longest) + 1)), len(by_length)) if longest > 1 else min(least - 1, len(by_length))
    inverted = [owner[stops[i] - counts[i] : stops[i]] for i in by_length]
    short, long = inverted[: len(inverted) - n_long], inverted[len(inverted) - n_long :]
    # heap merge: a set comes once per short list that holds it
    found = {i: sum(1 for _ in same) for i, same in groupby(merge(*[s.tolist() for s in short]))}
    alive = np.array([i for i, c in found.items() if c >= need[i] - n_long], np.int64)
    overlap = np.array([found[i] for i in alive.tolist()], np.int64)
    # binary search in the long lists; who can't reach the overlap any more is dropped
    for left, members in zip(range(len(long) - 1, -1, -1), long, strict=True):
        if not len(alive):
            break
        place = np.minimum(np.searchsorted(members, alive), len(members) - 1)
        overlap += members[place] == alive
        stays = overlap + left >= need[alive]
        alive, overlap = alive[stays], overlap[stays]
    return list(zip(alive.tolist(), overlap.tolist(), strict=True))


def _searched(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) among ``pairs`` (hub, node) of ``nodes`` (node, n, tokens). A hub's nodes are searched in blocks, so
    a query against many is spread over tasks."""
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = cut_lineage(pairs.join(sizes, "hub").select("hub", "node", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")), "overlap-blocks")
    other = dealt.join(nodes, "node").select("hub", "block", F.lit(1).alias("side"), "node", "n", "tokens")
    query = dealt.select("hub", "block").distinct().join(nodes.withColumnRenamed("node", "hub"), "hub")
    query = query.select("hub", "block", F.lit(0).alias("side"), F.col("hub").alias("node"), "n", "tokens")
    grouped = query.unionByName(other).repartition("hub", "block").sortWithinPartitions("hub", "block", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, size, wanted, held, names, cells = None, 0, None, [], [], 0
        a: list[int] = []
        b: list[int] = []

        def search() -> None:
            for i, _ in divide_skip(wanted, size, held, percent) if held else ():
                a.append(key[0]), b.append(names[i])
            held.clear(), names.clear()

        for batch in batches:
            lists = batch.column("tokens")
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            rows = zip(*[batch.column(c).to_pylist() for c in ("hub", "block", "side", "node", "n")], strict=True)
            for i, (hub, block, side, node, n) in enumerate(rows):
                tokens = flat[offsets[i] : offsets[i + 1]]
                if not side:
                    if key:
                        search()
                    key, size, wanted, cells = (hub, block), n, tokens.copy(), 0
                else:
                    held.append((n, tokens.copy())), names.append(node)
                    cells += len(tokens)
                    if cells >= BLOCK_SHINGLES:
                        search()
                        cells = 0
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a.clear(), b.clear()
        if key:
            search()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return cut_lineage(grouped.mapInArrow(run, "a long, b long"), "overlap-edges")


# ---- components --------------------------------------------------------------------------------


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of every node of some edges that is not the smallest itself."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(names))
    one, other = ends[: len(a)], ends[len(a) :]
    while True:
        # hook the larger root below the smaller one, then shorten the paths
        x, y = root[one], root[other]
        open_ = x != y
        if not open_.any():
            break
        one, other, x, y = one[open_], other[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    child = root != np.arange(len(names))
    return names[child], names[root[child]]


def _merged_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = 0
    for batch in batches:
        a, b = np.concatenate([a, batch.column(0).to_numpy()]), np.concatenate([b, batch.column(1).to_numpy()])
        if len(a) > 2 * held + (1 << 16):
            a, b = _forest(a, b)
            held = len(a)
    if len(a):
        a, b = _forest(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["node", "root"])


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the smallest node of its component, written.

    Each partition reduces its edges to a forest first. At most ``FEW_EDGES`` that are left, which is counted, are
    merged in one step; more go through the rounds of star contraction.
    """
    forest = cut_lineage(edges.mapInArrow(_merged_forests, "node long, root long"), "overlap-forest")
    if forest.limit(FEW_EDGES + 1).count() <= FEW_EDGES:
        return cut_lineage(forest.coalesce(1).mapInArrow(_merged_forests, "node long, root long"), "overlap-roots")
    return cut_lineage(roots(forest.select(F.col("node").alias("a"), F.col("root").alias("b"))), "overlap-roots")


# ---- rounds ------------------------------------------------------------------------------------


def ranked(lists: DataFrame) -> DataFrame:
    """``lists`` with the ``place`` of each node in its list, the most central first, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column("token").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            sizes = np.diff(np.append(starts, len(token)))
            place = np.arange(len(token)) - np.repeat(starts, sizes)
            if token[0] == last:
                place[: sizes[0]] += count
            last, count = token[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "place"])

    ordered = lists.repartition("token").sortWithinPartitions("token", F.desc("score"), "node")
    return cut_lineage(ordered.mapInArrow(run, T.StructType([*ordered.schema.fields, T.StructField("place", T.LongType())])), "overlap-ranked")


def _queries(lists: DataFrame, least: int, hubs: int, percent: int) -> DataFrame:
    """(hub, node) of the nodes at places ``least`` to ``hubs`` - 1 of each list against all behind them that are in other
    components and whose sizes allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, heads = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens, node, n, place, root = (batch.column(c).to_numpy() for c in ("token", "node", "n", "place", "root"))
            inner = batch.column("inner").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
            a, b = [], []
            for s, e in zip(starts.tolist(), np.append(starts[1:], len(tokens)).tolist(), strict=True):
                if tokens[s] != token:
                    token, heads = tokens[s], []
                old = len(heads)
                heads += [(node[i], n[i], inner[i], root[i], place[i]) for i in range(s, min(e, s + hubs)) if place[i] < hubs]
                rows = slice(s, e)
                for k, (hub, hub_n, hub_inner, hub_root, hub_place) in enumerate(heads):
                    if k >= old and e - s == 1:
                        continue
                    small, large = np.minimum(n[rows], hub_n), np.maximum(n[rows], hub_n)
                    met = np.where(n[rows] <= hub_n, inner[rows], hub_inner)
                    good = np.flatnonzero((root[rows] != hub_root) & met & (100 * small >= percent * large) & (place[rows] > hub_place))
                    if len(good):
                        a.append(np.full(len(good), hub)), b.append(node[rows][good])
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
            pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["hub", "node"])

    ordered = lists.where(F.col("place") >= least).repartition("token").sortWithinPartitions("token", "place")
    return ordered.select("token", "node", "n", "inner", "place", "root").mapInArrow(run, "hub long, node long").distinct()


def _open(lists: DataFrame, rooted: DataFrame, least: int) -> DataFrame:
    """The lists that hold more than one component from place ``least`` on, with the component of each node."""
    placed = lists.where(F.col("place") >= least).drop("root").join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = cut_lineage(placed, "overlap-placed")
    mixed = placed.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("token")
    mixed, _ = broadcast_if_small(mixed, "overlap-mixed", BROADCAST_ROWS)
    return cut_lineage(placed.join(mixed, "token"), "overlap-open")


def connected(lists: DataFrame, nodes: DataFrame, percent: int, split: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, root) of all linked nodes which meet in a list of ``lists`` (token, score, node, n, inner).

    ``nodes`` (node, n, tokens) holds the shingles to compare. ``split`` may deal the lists anew that the first query of
    each has left open.
    """
    lists = ranked(lists).withColumn("root", F.col("node"))
    edges, rooted = None, None
    least, hubs = 0, 1
    while True:
        pairs = cut_lineage(_queries(lists, least, hubs, percent), "overlap-pairs")
        found = _searched(pairs, nodes, percent) if pairs.limit(1).count() else None
        if found is not None:
            edges = found if edges is None else edges.unionByName(found)
            rooted = component_roots(edges)
        if rooted is None:
            rooted = component_roots(pairs.select(F.col("hub").alias("a"), F.col("node").alias("b")))
        lists = _open(lists, rooted, hubs)
        if not lists.limit(1).count():
            return rooted
        if split:
            lists, split = ranked(split(lists.drop("root", "place"))), None
            lists, least, hubs = _open(lists, rooted, 0), 0, MORE
            continue
        least, hubs = hubs, hubs * MORE


def prefix_lists(whole: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(nodes (node, n, tokens), lists (token, score, node, n, inner)) of whole sets (node, n, tokens): the shingles that two
    of them or more hold, and the shortest lists, in which each set meets all its partners."""
    shared = _shared_tokens(whole.select(F.explode("tokens").alias("token"), "node"))
    by_node = shared.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("size", "token"))).alias("known"))
    known = by_node.join(whole.groupBy("node").agg(F.first("n").alias("n")), "node")
    # unshared shingles are the shortest lists of all: they stand first
    prefix = F.expr(f"cast(n - ceil({percent} * n / 100D) + 1 - (n - size(known)) as int)")
    inner = F.expr(f"cast(n - ceil({2 * percent} * n / {100 + percent}D) + 1 - (n - size(known)) as int)")
    score = F.aggregate("known", F.lit(0.0), lambda a, e: a + e["size"]) / F.col("n")
    known = known.withColumns({"prefix": prefix, "inner": inner, "score": score}).where("prefix > 0")
    known = cut_lineage(known, "overlap-known")
    nodes = known.select("node", "n", F.array_sort(F.transform("known", lambda e: e["token"])).alias("tokens"))
    lists = known.select("node", "n", "score", F.col("inner").alias("within"), F.posexplode(F.slice("known", 1, F.col("prefix"))).alias("at", "e"))
    lists = cut_lineage(lists.select(F.col("e.token").alias("token"), "score", "node", "n", (F.col("at") < F.col("within")).alias("inner")), "overlap-lists")

    return nodes, lists


def links(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(``doc_id``, ``h``, ``node``, ``n`` of every row, (node, root) of all linked nodes)."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    found = cut_lineage(_sets(named, k, percent, False), "overlap-sets")
    rows = found.drop("tokens")
    counts = _shared_counts(found.where("tokens IS NOT NULL").select(F.explode("tokens").alias("token"), "node"))
    sizes = rows.groupBy("node").agg(F.first("n").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("lent"))
    # the same bound as least_shared, in integers
    bound = F.expr(f"greatest(1, ceil({percent} * n / 100D) div {EXTRA})")
    live = cut_lineage(counts.join(sizes, "node").where(F.col("shared") >= bound).select("node", *row_key("lent.doc_id", "lent.h")), "overlap-live")

    lenders, _ = broadcast_if_small(live.select("key", "no_id", "h"), "overlap-lenders", BROADCAST_ROWS)
    lent = named.select("doc_id", "text", *row_key("doc_id", "h")).join(lenders, ["key", "no_id", "h"], "left_semi").select("doc_id", "h", "text")
    whole = cut_lineage(_sets(lent, k, percent, True).where("tokens IS NOT NULL").select("node", "n", "tokens"), "overlap-whole")
    nodes, lists = prefix_lists(whole, percent)
    return rows, connected(lists, nodes, percent)


def components(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest id reachable by links) of every row."""
    rows, rooted = links(docs, k, percent)
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id")).join(rooted, "node", "left")
    nodes = cut_lineage(nodes.select("node", "first_id", F.coalesce("root", "node").alias("root")), "overlap-nodes")
    smallest = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_node = cut_lineage(nodes.join(smallest, "root").select("node", "component_id"), "overlap-components")
    linked = rows.where("n > 0").join(by_node, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
