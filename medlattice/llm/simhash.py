"""SimHash near-duplicates by segment popcounts.

A fingerprint has one bit per hash bit, set where over half of a text's shingle hashes set it. Two
fingerprints link at ``RADIUS`` or fewer differing bits.

* Equal fingerprints are merged first, with partial counts, so exact copies cost nothing later.
* Embedding: a fingerprint is cut into 32 segments of two bits; the number of ones per segment is a
  point in a grid. The Manhattan distance of two points is never above the Hamming distance.
* Grid join: the segments form ``GROUPS`` groups. Points within Manhattan distance ``RADIUS`` agree
  exactly in at least ``GROUPS - RADIUS`` groups, so each point is dealt to one cell per choice of
  that many groups; linked fingerprints meet in at least one cell.
* In a cell the Manhattan bound, then the exact distance, is taken from one fingerprint to all not yet
  reached: a spanning forest of the cell, never all of its pairs.
* A cell with more than ``CELL`` fingerprints is not gathered: its points are dealt again by bits
  (``GROUPS`` bit groups as above), into cells that leave at most 32 bits open, and once more by the
  bits that are still open, which leaves 16: at most 65,536 different fingerprints.
* Components come from alternating star contractions on the forest's edges, each round a written table.

Defined cases: a text with fewer words than a shingle is one shingle; null, empty and blank texts have
fingerprint zero and link like any other; a null ``doc_id`` is kept, and its component is the smallest
known id (null if there is none); repeated rows share a component; empty tables give empty results;
other columns are ignored by ``components`` and kept by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import cut_lineage, in_slices, in_small_batches, lower_words, packed, row_key, utf8

WORDS, SEED, RADIUS, GROUPS, CELL = 4, 42, 4, 8, 16_384
_LANES, _PAIRS = 0x0101010101010101, 0x5555555555555555
#: bytes of text whose hashes are held at once
_SLICE = 4 << 20


def _hashes(data: bytes, k: int) -> np.ndarray:
    """XXH64 of the k-word shingles of one text, repeats included."""
    words = lower_words(data)
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = np.concatenate(([0], ends[: len(words) - k])).tolist()
    last = (ends[k - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)], np.uint64)


def fingerprints(hashes: list[np.ndarray]) -> np.ndarray:
    """Majority bits of each text's hashes, as uint64.

    Bits are counted in the eight byte lanes of a word, for runs of at most 255 hashes, then widened.
    """
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    every = np.concatenate([hashes[i] for i in some])
    runs = -(-sizes[some] // 255)
    first_run = np.cumsum(runs) - runs
    within = np.arange(runs.sum()) - np.repeat(first_run, runs)
    starts = np.repeat(np.cumsum(sizes[some]) - sizes[some], runs) + 255 * within
    for bit in range(8):
        lanes = np.add.reduceat((every >> np.uint64(bit)) & np.uint64(_LANES), starts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_run, axis=0)
        ones = 2 * counts > sizes[some][:, None]
        out[some] |= (ones.astype(np.uint64) << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(bit))).sum(axis=1, dtype=np.uint64)
    return out


def with_fingerprint(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """``doc_id``, ``h`` (hash of the text) and ``fp`` (the fingerprint's bits as long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_slices(batch, "text", _SLICE):
                raw, ends = utf8(part.column("text"))
                data, ends = raw.tobytes(), ends.tolist()
                fp = fingerprints([_hashes(data[a:b], k) for a, b in zip(ends, ends[1:], strict=False)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("h"), pa.array(fp.view(np.int64))], names=["doc_id", "h", "fp"])

    wanted = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    return wanted.mapInArrow(run, "doc_id long, h long, fp long")


def _counts(fp: str) -> str:
    """SQL of the 32 segment counts of ``fp``, two bits each."""
    other = f"shiftrightunsigned({fp}, 1)"
    return f"((({fp} ^ {other}) & {_PAIRS}L) | shiftleft({fp} & {other} & {_PAIRS}L, 1))"


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(groups: list[int], keep: int) -> list[int]:
    """One mask per choice of ``keep`` of the groups."""
    return [_signed(sum(chosen)) for chosen in combinations(groups, keep)]


def _bits(first: int, width: int) -> int:
    return ((1 << width) - 1) << first


def _linked(one: np.uint64, many: np.ndarray, radius: int) -> np.ndarray:
    """Which of ``many`` differ from ``one`` in ``radius`` bits or fewer: Manhattan bound first, then exactly."""
    pairs, low = np.uint64(_PAIRS), np.uint64(1)
    # |difference| of two 2-bit counts, summed: a lower bound of the differing bits
    a = (one & pairs) + ((one >> low) & pairs)
    b = (many & pairs) + ((many >> low) & pairs)
    high, odd = np.uint64(0xAAAAAAAAAAAAAAAA), np.uint64(_PAIRS)
    x = a ^ b
    # counts 0,1,2 differ by 2 only as 0 against 2; 1 against 2 differs in both bits but by 1
    two = ((x & high) >> low) & ~x & odd
    at = np.flatnonzero(np.bitwise_count((x & odd) | (((x & high) >> low) & odd)) + np.bitwise_count(two) <= radius)
    return at[np.bitwise_count(many[at] ^ one) <= radius]


def forest(points: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges (point, root) of the components of different fingerprints within one cell."""
    rest, edges = np.sort(points), []
    while len(rest) > 1:
        root, rest, queue = rest[0], rest[1:], [rest[0]]
        while queue and len(rest):
            near = _linked(queue.pop(), rest, radius)
            if len(near):
                found = rest[near]
                rest = np.delete(rest, near)
                edges += [(int(p), int(root)) for p in found]
                queue += list(found)
    return edges


def _cells(dealt: DataFrame, radius: int, limit: int) -> DataFrame:
    """Edges of all cells of ``dealt`` (choice, cell, fp), and the members of cells over ``limit`` as
    rows with ``big`` set. Cells arrive sorted; only one is held, and none beyond the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(a: np.ndarray, b: np.ndarray, choice: int | None, cell: int | None) -> pa.RecordBatch:
            n, big = len(a), choice is not None
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([big] * n, pa.bool_()), pa.array([choice] * n, pa.int32()), pa.array([cell] * n, pa.int64())],
                names=["a", "b", "big", "choice", "cell"],
            )

        key, held, size = None, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            if 1 < size <= limit:
                edges = np.array(forest(np.concatenate(held).view(np.uint64), radius), np.uint64).reshape(-1, 2).view(np.int64)
                if len(edges):
                    yield result(edges[:, 0], edges[:, 1], None, None)

        for batch in batches:
            choice, cell = batch.column("choice").to_numpy(), batch.column("cell").to_numpy()
            fp = batch.column("fp").to_numpy()
            if not len(fp):
                continue
            cuts = np.flatnonzero((choice[1:] != choice[:-1]) | (cell[1:] != cell[:-1])) + 1
            starts, stops = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fp)]))
            # cells of one point inside the batch have no edge
            keep = (stops - starts > 1) | (starts == 0) | (stops == len(fp))
            for s, e in zip(starts[keep].tolist(), stops[keep].tolist(), strict=True):
                this = (int(choice[s]), int(cell[s]))
                if this != key:
                    yield from close()
                    key, held, size = this, [], 0
                if size <= limit < size + e - s:
                    for part in held:
                        yield result(part, part, *key)
                    held = []
                size += e - s
                if size > limit:
                    yield result(fp[s:e], fp[s:e], *key)
                else:
                    held.append(fp[s:e])
        yield from close()

    ordered = dealt.repartition("choice", "cell").sortWithinPartitions("choice", "cell")
    return cut_lineage(ordered.mapInArrow(run, "a long, b long, big boolean, choice int, cell long"), "simhash-cells")


def links(points: DataFrame, radius: int = RADIUS, limit: int = CELL, groups: int = GROUPS) -> DataFrame:
    """Edges (a, b) that connect all linked fingerprints of ``points`` (column ``fp``, all different).

    With a column ``band`` only the fingerprints of one band meet, and (band, fp) are all different. The fewer ``groups``
    there are beyond ``radius``, the fewer cells a point is dealt to.
    """
    bits = [_bits(64 * g // groups, 64 // groups) for g in range(groups)]
    masks = _masks(bits, groups - radius)
    n = len(masks)
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(masks)])
    choice = (F.col("band") * n + F.col("c.choice")).cast("int").alias("choice")
    named = points.select("fp", (F.col("band") if "band" in points.columns else F.lit(0)).alias("band"))
    dealt = named.select("fp", "band", F.expr(_counts("fp")).alias("counts"), F.explode(choices).alias("c")).select(
        choice, F.col("counts").bitwiseAND(F.col("c.mask")).alias("cell"), "fp"
    )
    found = _cells(dealt, radius, limit)
    edges = found.where("NOT big").select("a", "b")
    level = 0
    while level < 2 and found.where("big").limit(1).count():
        level += 1
        # finer cells for the crowded ones: bits instead of counts, first of the whole, then of what is open
        big = found.where("big").select("a", "choice").distinct()
        if level == 1:
            again = big.select(F.col("a").alias("fp"), F.expr(f"choice div {n}").alias("band")).distinct()
            fine = again.select("fp", "band", F.explode(choices).alias("c")).select(choice, F.col("fp").bitwiseAND(F.col("c.mask")).alias("cell"), "fp")
        else:
            rows = []
            for i, m in enumerate(masks):
                open_ = [b for b in range(64) if not (m >> b) & 1]
                small = [sum(1 << b for b in open_[g * len(open_) // groups : (g + 1) * len(open_) // groups]) for g in range(groups)]
                rows += [(i, j, _signed((m | s) & (1 << 64) - 1)) for j, s in enumerate(_masks(small, groups - radius))]
            finer = points.sparkSession.createDataFrame(rows, "coarse int, finer int, mask long")
            fine = big.join(F.broadcast(finer), F.expr(f"choice % {n} = coarse")).select(
                (F.col("choice") * n + F.col("finer")).alias("choice"), F.col("a").bitwiseAND(F.col("mask")).alias("cell"), F.col("a").alias("fp")
            )
        found = _cells(fine, radius, limit if level == 1 else 1 << 16)
        edges = edges.unionByName(found.where("NOT big").select("a", "b"))
    return edges.distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges``: the smallest node of its component.

    Alternating large-star and small-star contraction. Each round is two aggregations and two joins on
    written tables, so a hub is a skewed join side, which the adaptive planner splits.
    """
    now = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "simhash-edges")
    while True:
        # large star: every larger neighbour of u moves to the smallest neighbour of u
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "simhash-least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large, "simhash-large")
        # small star: u and its smaller neighbours move to the smallest of them
        least = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")), "simhash-least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        small = small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u != v").distinct()
        small = cut_lineage(small, "simhash-small")
        # done when every node has one edge and no node is both a root and a child
        many = small.groupBy("u").count().where("count > 1").limit(1).count()
        if not many and not small.join(small.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count():
            return small.select(F.col("u").alias("node"), F.col("v").alias("root"))
        now = small


def components(docs: DataFrame, k: int = WORDS, radius: int = RADIUS, limit: int = CELL) -> DataFrame:
    """``doc_id``, ``h``, ``fp``, ``root`` (a print of the component) and ``component_id`` (smallest id reachable) of every row."""
    printed = cut_lineage(with_fingerprint(docs, k), "simhash-fingerprints")
    points = cut_lineage(printed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-points")
    rooted = cut_lineage(roots(links(points.select("fp"), radius, limit)), "simhash-roots")
    grouped = points.join(rooted, points.fp == rooted.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    grouped = cut_lineage(grouped, "simhash-grouped")
    smallest = cut_lineage(grouped.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-smallest")
    by_print = cut_lineage(grouped.join(smallest, "root").select("fp", "root", "component_id"), "simhash-components")
    return printed.join(by_print, "fp")


def deduplicated(docs: DataFrame, k: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` is not the smallest of its component. Repeated rows of
    the smallest id come once; where no row of a component has an id, the smallest text hash stays."""
    chosen = components(docs, k, radius)
    stays = chosen.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
    stays = stays.agg(F.min(F.struct("doc_id", "h")).alias("s")).select("s.doc_id", "s.h")
    stays = cut_lineage(stays.select(*row_key("doc_id", "h")), "simhash-kept")
    keyed = packed(docs, *row_key("doc_id", F.xxhash64("text")))
    return keyed.join(stays, ["key", "no_id", "h"], "left_semi").dropDuplicates(["key", "no_id", "h"]).select("row.*")
