"""Near-duplicates by exact shingle similarity, found through SimHash prints per band of minima.

Two texts link when the sets of their ``k``-word shingles have a Jaccard similarity of ``SIMILAR`` or more.

* Texts with the same shingle set are merged first into one node, so exact copies cost nothing later.
* Candidates come from the grid join of ``simhash``: popcounts of a print's segments, cells, Manhattan bound, exact distance.
  Linked prints form classes, and the nodes of a class are candidates.
* The first print of a node is the SimHash of all its shingles. At ``RADIUS`` or fewer differing bits, as in ``simhash``, it
  finds the closest texts for certain, but at 0.8 two of them differ in ten of 64 bits.
* So there are ``BANDS`` more, each the SimHash of the minima of ``ROWS`` seeded orders of the shingles, which are compared at
  ``BAND_RADIUS``. Two nodes at similarity s have equal minima, and so equal prints, in a band with probability s^ROWS, in
  one band or more with 1 - (1 - s^ROWS)^BANDS: 0.9999 at 0.8. Other minima change a print by 12 bits or so.
* A class is no source of all its pairs: its most central node is compared with the others, then more nodes with what is
  left in other components, until each pair of a class was compared or is connected (``overlap_join.connected``).
* The nodes of classes that are open after the first round are dealt anew, by their rarest shared shingles (the prefix of
  ``overlap_join``), which linked nodes share for certain. So one passage in many different texts does not make them all meet.
* The exact similarity of the two shingle sets decides.

Defined cases: a text with fewer words than a shingle is one shingle; null, empty and blank texts have
no shingles and link with each other only; ``doc_id`` as in ``simhash``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.llm import overlap_join
from medlattice.llm.common import cut_lineage, in_slices, in_small_batches, packed, row_key, utf8
from medlattice.llm.simhash import fingerprints, links
from medlattice.session import broadcast_if_small

SIMILAR, ROWS, BANDS, BROADCAST_ROWS = 0.8, 5, 24, 200_000
#: bits that two prints of a band may differ in, and groups of segments of their grid: two cells for each print
BAND_RADIUS, BAND_GROUPS = 1, 2
_SLICE = 1 << 20
_ORDERS = np.random.default_rng(42).integers(0, 1 << 64, (2, ROWS * BANDS), np.uint64)
_ORDERS[1] |= np.uint64(1)


def band_prints(sets: list[np.ndarray]) -> np.ndarray:
    """``BANDS`` SimHash prints of each shingle set, as uint64; zero for an empty set."""
    out = np.zeros((len(sets), BANDS), np.uint64)
    some = [i for i, s in enumerate(sets) if len(s)]
    if not some:
        return out
    every = np.concatenate([sets[i] for i in some])
    sizes = np.array([len(sets[i]) for i in some])
    starts = np.cumsum(sizes) - sizes
    least = np.empty((len(some), ROWS * BANDS), np.uint64)
    for j, (flip, factor) in enumerate(_ORDERS.T):
        least[:, j] = np.minimum.reduceat((every ^ flip) * factor, starts)
    # the orders are scrambled again: minima have few high bits, and the print takes each bit by majority
    least = (least ^ (least >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    least ^= least >> np.uint64(32)
    out[some] = fingerprints(list(least.reshape(-1, ROWS))).reshape(len(some), BANDS)
    return out


def with_prints(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id``, ``h`` (hash of the text), ``node`` (hash of its shingle set), ``n`` (size of the set) and
    ``prints`` (of all shingles, then of the bands) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_slices(batch, "text", _SLICE):
                sets = overlap_join.shingle_sets(*utf8(part.column("text")), k)
                node = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                flat = pa.array(np.column_stack([fingerprints(sets), band_prints(sets)]).view(np.int64).ravel())
                prints = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (1 + BANDS)), flat)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("h"), pa.array(node), pa.array([len(s) for s in sets], pa.int64()), prints],
                    names=["doc_id", "h", "node", "n", "prints"],
                )

    wanted = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    return wanted.mapInArrow(run, "doc_id long, h long, node long, n long, prints array<long>")


def classes(dealt: DataFrame) -> DataFrame:
    """``token`` (the class of a print), ``node`` and ``n`` of every row of ``dealt`` (node, n, band, fp). A class holds the prints of one
    band that are connected by pairs within its radius: ``simhash.RADIUS`` in band 0, the whole texts, else ``BAND_RADIUS``."""
    points = cut_lineage(dealt.select("band", "fp").distinct(), "near-points")
    edges = links(points.where("band = 0")).unionByName(links(points.where("band > 0"), BAND_RADIUS, groups=BAND_GROUPS))
    rooted, _ = broadcast_if_small(overlap_join.component_roots(edges).withColumnRenamed("node", "fp"), "near-classes", BROADCAST_ROWS)
    return dealt.join(rooted, "fp", "left").select(F.expr("xxhash64(band, coalesce(root, fp))").alias("token"), "node", "n")


def _dealt_anew(lists: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """The nodes of open lists in the lists of their rarest shared shingles."""
    left = cut_lineage(lists.select("node").distinct(), "near-open")
    return overlap_join.prefix_lists(cut_lineage(whole.join(left, "node"), "near-rest"), percent)[1]


def components(docs: DataFrame, k: int, similar: float = SIMILAR) -> DataFrame:
    """``doc_id``, ``h``, ``root`` (a node of the component) and ``component_id`` (smallest id) of every row."""
    percent = round(100 * similar)
    printed = cut_lineage(with_prints(docs, k), "near-prints")
    lent = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("lent")
    nodes = printed.groupBy("node").agg(lent, F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("prints").alias("prints"))
    nodes = cut_lineage(nodes.select("node", "lent.doc_id", "lent.h", "first_id", "n", "prints"), "near-nodes")

    # classes of one node have no pair
    dealt = nodes.where("n > 0").select("node", "n", F.posexplode("prints").alias("band", "fp"))
    dealt = cut_lineage(classes(dealt), "near-tokens")
    sizes = dealt.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = cut_lineage(dealt.join(sizes, "token"), "near-met")
    central = cut_lineage(met.groupBy("node").agg(F.sum("m").cast("double").alias("score")), "near-central")
    lists = met.join(central, "node").select("token", "score", "node", "n", F.lit(True).alias("inner"))

    # the shingles of the nodes that meet another one
    wanted = nodes.join(central.select("node"), "node").select(*row_key("doc_id", "h"))
    lenders, _ = broadcast_if_small(wanted, "near-lenders", BROADCAST_ROWS)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    texts = named.select("doc_id", "text", *row_key("doc_id", "h")).join(lenders, ["key", "no_id", "h"], "left_semi").select("doc_id", "h", "text")
    whole = overlap_join._sets(texts, k, percent, True).where("tokens IS NOT NULL").select("node", "n", F.array_sort("tokens").alias("tokens"))
    whole = cut_lineage(whole.dropDuplicates(["node"]), "near-whole")

    rooted = overlap_join.connected(lists, whole, percent, lambda x: _dealt_anew(x, whole, percent))
    grouped = nodes.join(rooted, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    grouped = cut_lineage(grouped, "near-grouped")
    smallest = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_node = cut_lineage(grouped.join(smallest, "root").select("node", "root", "component_id"), "near-components")
    return printed.select("doc_id", "h", "node").join(by_node, "node")


def deduplicated(docs: DataFrame, k: int, similar: float = SIMILAR) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` is not the smallest of its component. Repeated rows of
    the smallest id come once; where no row of a component has an id, the smallest text hash stays."""
    chosen = components(docs, k, similar)
    stays = chosen.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
    stays = stays.agg(F.min(F.struct("doc_id", "h")).alias("s")).select("s.doc_id", "s.h")
    stays = cut_lineage(stays.select(*row_key("doc_id", "h")), "near-kept")
    keyed = packed(docs, *row_key("doc_id", F.xxhash64("text")))
    return keyed.join(stays, ["key", "no_id", "h"], "left_semi").dropDuplicates(["key", "no_id", "h"]).select("row.*")
