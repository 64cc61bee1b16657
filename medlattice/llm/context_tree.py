"""Language-model scores by context-tree weighting.

A text is its UTF-8 bytes and an end symbol; a byte is eight binary decisions. Every decision has a
tree of contexts, the 0 to ``DEPTH`` bytes before it. A node keeps a Krichevsky-Trofimov estimate;
weighting mixes the estimates of all depths, each node weighing its own estimate against its
children's by how well either has coded the training data. Texts are scored with the finished tree.

* Counting: each task counts the (context, byte) grams of its texts; Spark adds the counts.
* Weights: the grams are dealt by the two bytes next to the predicted one, so all nodes of depth 2 and
  more are finished where they lie; the two top levels have at most 65,536 nodes and are closed on the
  driver from sums.
* Scoring: grams and nodes are sent to the tasks in blocks of at most ``BLOCK`` grams, divided by the
  same two bytes; each block is one pass over the texts and adds the positions that belong to it. A
  larger model takes more passes, never more memory.
* Unigram base: the ``FREQUENT`` commonest tokens are sent to the tasks, all others are joined by hash.
  Tokens are told apart by 64-bit hashes.

Defined cases: null and empty texts consist of the end symbol; a null ``doc_id`` counts as the empty
text when documents are divided, so such rows are held out; repeated rows train and are scored each;
without training rows every decision has probability 1/2 and the base score is log10 of 1 per token;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import log, log10, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import cut_lineage, in_slices, in_small_batches, lower_words, remainder, row_key, utf8

DEPTH, BLOCK, FREQUENT, END = 4, 1_000_000, 500_000, 0xFF
#: bytes of text whose positions are held at once
_SLICE = 1 << 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: counted tokens a task holds before it passes them on
_HELD = 300_000
#: odd factor that spreads the two context bytes over the blocks
_DEAL = 40_503


# ---- bytes to grams ----------------------------------------------------------------------------


def grams(raw: np.ndarray, ends: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Key of every predicted symbol (context bytes above it, nearest lowest) and the texts' n+1 bounds."""
    n, sizes = len(ends) - 1, np.diff(ends)
    bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
    stream = np.full(len(raw) + n + depth * n, END, np.uint8)
    own = np.arange(len(raw)) + np.repeat(np.arange(n) * (1 + depth) + depth, sizes)
    stream[own] = raw
    at = np.arange(bounds[-1]) + np.repeat((np.arange(n) + 1) * depth, sizes + 1)
    keys = np.zeros(len(at), np.uint64)
    for back in range(depth, -1, -1):
        keys = (keys << np.uint64(8)) | stream[at - back]
    return keys, bounds


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def gram_counts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, n) over all texts of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in in_slices(batch, "text", _SLICE):
                found = np.sort(grams(*utf8(part.column("text")), depth)[0])
                first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
                fresh = np.diff(np.concatenate((first, [len(found)])))
                keys, counts = _merged(np.concatenate((keys, found[first])), np.concatenate((counts, fresh)))
                if len(keys) > 4 * _HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "n"])
                    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "n"])

    found = docs.select("text").mapInArrow(run, "key long, n long")
    return cut_lineage(found.groupBy("key").agg(F.sum("n").alias("n")), "context-grams")


# ---- the weighted tree -------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: eight steps up, then Stirling's series."""
    product = x.copy()
    for i in range(1, 8):
        product *= x + i
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * log(2 * pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(product)


def _kt_block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln probability of any sequence of a zeros and b ones."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - log(pi) - _log_gamma(a + b + 1.0)


class Level:
    """Nodes of one depth: ``ids`` (context above the bit prefix), ones' probability and own weight."""

    def __init__(self, ids: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray | None) -> None:
        own = _kt_block(a, b)
        self.ids, self.a, self.b = ids, a, b
        self.coded = own if below is None else np.logaddexp(own, below) - log(2)
        self.one = (b + 0.5) / (a + b + 1.0)
        self.own = np.ones(len(ids)) if below is None else np.exp(np.minimum(own - log(2) - self.coded, 0.0))


def _summed(ids: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.zeros(0, np.int64)
    return (ids[first], *[np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values])


def levels(keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> dict[int, Level]:
    """Levels ``depth`` down to ``top`` of the tree over complete groups of grams."""
    context, byte = keys >> np.uint64(8), (keys & np.uint64(255)).astype(np.int64)
    ids, zeros, ones = [], [], []
    for t in range(8):
        prefix, bit = (1 << t) | (byte >> (8 - t)), (byte >> (7 - t)) & 1
        ids.append((context << np.uint64(8)) | prefix.astype(np.uint64))
        zeros.append(np.where(bit == 0, counts, 0).astype(np.float64))
        ones.append(np.where(bit == 1, counts, 0).astype(np.float64))
    level = Level(*_summed(np.concatenate(ids), np.concatenate(zeros), np.concatenate(ones)), None)
    out = {depth: level}
    for d in range(depth - 1, top - 1, -1):
        up = level.ids & np.uint64((1 << 8 * (d + 1)) - 1)
        up, a, b, below = _summed(up, level.a, level.b, level.coded)
        level = out[d] = Level(up, a, b, below)
    return out


def _find(sorted_ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted id, -1 where there is none."""
    if not len(sorted_ids):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_ids, wanted), len(sorted_ids) - 1)
    return np.where(sorted_ids[at] == wanted, at, -1)


#: nodes of a depth as (ids, probability of a one, own weight)
Nodes = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def log_probability(keys: np.ndarray, nodes: Nodes, depth: int) -> np.ndarray:
    """log10 of the mixed probability of each gram's symbol, from the nodes on its path."""
    context, byte = keys >> np.uint64(8), (keys & np.uint64(255)).astype(np.int64)
    out = np.zeros(len(keys))
    for t in range(8):
        prefix, bit = (1 << t) | (byte >> (8 - t)), (byte >> (7 - t)) & 1
        p = np.full(len(keys), 0.5)
        for d in range(depth, -1, -1):
            ids, one, own = nodes[d]
            short = context & np.uint64((1 << 8 * d) - 1)
            at = _find(ids, (short << np.uint64(8)) | prefix.astype(np.uint64))
            mixed = own[at] * one[at] + (1.0 - own[at]) * p if len(ids) else p
            p = np.where(at >= 0, mixed, 0.5)
        out += np.log10(np.where(bit == 1, p, 1.0 - p))
    return out


def fit(counts: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, Nodes]:
    """The tree: (kind, id, one, own, n) rows for depths 2 and more, kind -1 being the grams with their log10
    probability as ``one``; and the nodes of depths 0 and 1."""
    low = F.col("key").bitwiseAND(F.lit(0xFFFF00).cast("long"))
    dealt = counts.withColumn("low", low).repartition("low").drop("low")

    def gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        held = list(batches)
        keys = np.concatenate([b.column("key").to_numpy() for b in held]) if held else np.zeros(0, np.int64)
        n = np.concatenate([b.column("n").to_numpy() for b in held]) if held else np.zeros(0, np.int64)
        return keys.view(np.uint64), n

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels(*gathered(batches), depth, 2)[2]
        ids, a, b, coded = _summed(level.ids & np.uint64(0xFFFF), level.a, level.b, level.coded)
        yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(a), pa.array(b), pa.array(coded)], names=["id", "a", "b", "coded"])

    near = dealt.mapInArrow(sums, "id long, a double, b double, coded double").groupBy("id").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("coded").alias("coded")
    ).orderBy("id").toPandas()
    one = Level(near["id"].to_numpy(np.int64).view(np.uint64), *[near[c].to_numpy(np.float64) for c in ("a", "b", "coded")])
    root = Level(*_summed(one.ids & np.uint64(255), one.a, one.b, one.coded))
    top: Nodes = {d: (x.ids, x.one, x.own) for d, x in ((0, root), (1, one))}

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = gathered(batches)
        found = levels(keys, n, depth, 2)
        nodes = top | {d: (x.ids, x.one, x.own) for d, x in found.items()}
        rows = [(-1, keys, log_probability(keys, nodes, depth), np.zeros(len(keys)))]
        rows += [(d, x.ids, x.one, x.own) for d, x in found.items()]
        for kind, ids, first, second in rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids.view(np.int64)), pa.array(first.astype(np.float32)), pa.array(second.astype(np.float32))],
                names=["kind", "id", "one", "own"],
            )

    return cut_lineage(dealt.mapInArrow(finished, "kind int, id long, one float, own float"), "context-tree"), top


class Lookup:
    """Values by 64-bit key: keys spread by a multiplication and sorted, with an index of their first bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        spread = keys * _SPREAD
        order = np.argsort(spread)
        self.keys, self.values = spread[order], values[order]
        self.bits = max(1, int(len(keys)).bit_length())
        marks = self.keys >> np.uint64(64 - self.bits)
        self.first = np.searchsorted(marks, np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is unknown."""
        spread = keys * _SPREAD
        mark = (spread >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.first[mark], self.first[mark + 1]
        out = np.full(len(keys), -1, np.int64)
        left = np.flatnonzero(at < stop)
        at, stop, wanted = at[left], stop[left], spread[left]
        while len(left):
            hit = self.keys[at] == wanted
            out[left[hit]] = at[hit]
            at = at + 1
            on = ~hit & (at < stop)
            left, at, stop, wanted = left[on], at[on], stop[on], wanted[on]
        return out


def _blocks_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Block of each gram: its two nearest context bytes, spread."""
    low = (keys >> np.uint64(8)) & np.uint64(0xFFFF)
    return ((low * np.uint64(_DEAL)) & np.uint64(0xFFFF)) % np.uint64(blocks)


def _block_model(rows: DataFrame, top: Nodes, depth: int) -> tuple[Lookup, Nodes]:
    def column(kind: int, *names: str) -> list[np.ndarray]:
        table = rows.where(F.col("kind") == kind).select(*names).toArrow()
        return [table.column(name).to_numpy() for name in names]

    nodes = dict(top)
    for d in range(2, depth + 1):
        ids, one, own = column(d, "id", "one", "own")
        order = np.argsort(ids)
        nodes[d] = (ids.view(np.uint64)[order], one[order], own[order])
    ids, one = column(-1, "id", "one")
    return Lookup(ids.view(np.uint64), one), nodes


# ---- the unigram base --------------------------------------------------------------------------


def _token_hashes(data: bytes) -> list[int]:
    """64-bit hashes of the tokens of one text; the end token is the hash of nothing."""
    return [*map(xxhash.xxh3_64_intdigest, lower_words(data)), xxhash.xxh3_64_intdigest(b"")]


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c) over all texts of ``docs``, a token being its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()

        def flush() -> pa.RecordBatch:
            tokens = np.fromiter(counts.keys(), np.uint64, len(counts)).view(np.int64)
            c = np.fromiter(counts.values(), np.int64, len(counts))
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(c)], names=["token", "c"])

        for batch in batches:
            for text in batch.column("text"):
                counts.update(_token_hashes((text.as_py() or "").encode()))
                if len(counts) > _HELD:
                    yield flush()
        yield flush()

    found = docs.select("text").mapInArrow(run, "token long, c long")
    return cut_lineage(found.groupBy("token").agg(F.sum("c").alias("c")), "token-counts")


def _frequent(counts: DataFrame) -> DataFrame:
    """The commonest tokens, at most ``FREQUENT``: those above a count that is read off the counts' histogram."""
    # there are at most as many different counts as the square root of twice their sum
    histogram = sorted(((r["c"], r["count"]) for r in counts.groupBy("c").count().collect()), reverse=True)
    total, least = 0, None
    for c, many in histogram:
        total += many
        if total > FREQUENT:
            break
        least = c
    return counts.where(F.col("c") >= least) if least is not None else counts.limit(0)


# ---- scores ------------------------------------------------------------------------------------

_SCORED = "row long, doc_id long, h long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long, rare array<long>"


def scores(docs: DataFrame, held_out_divisor: int = 10, depth: int = DEPTH) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10
    probability of the text) and ``bits_per_byte``."""
    spark = docs.sparkSession
    split = in_small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text", (remainder(F.col("doc_id"), held_out_divisor) == 0).alias("held_out")
    )
    training = split.where("NOT held_out")
    tokens = token_counts(training)
    n, v = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    scale = n + 0.1 * (v + 1)
    counted = gram_counts(training, depth)
    tree, top = fit(counted, depth)
    frequent = _frequent(tokens).toArrow()
    known = Lookup(frequent.column("token").to_numpy().view(np.uint64), frequent.column("c").to_numpy())
    blocks = max(1, -(-counted.count() // BLOCK))
    stored: list[DataFrame] = []
    for block in range(blocks):
        part = tree.where(F.expr(f"((id div 256) & 65535) * {_DEAL} % 65536 % {blocks}") == block) if blocks > 1 else tree
        model = spark.sparkContext.broadcast((*_block_model(part, top, depth), known if block == 0 else None))

        def run(batches: Iterator[pa.RecordBatch], model=model, block=block) -> Iterator[pa.RecordBatch]:
            table, nodes, known = model.value
            row = TaskContext.get().partitionId() << 33
            for batch in batches:
                for part in in_slices(batch, "text", _SLICE):
                    raw, ends = utf8(part.column("text"))
                    keys, bounds = grams(raw, ends, depth)
                    value = np.zeros(len(keys))
                    mine = np.flatnonzero(_blocks_of(keys, blocks) == block) if blocks > 1 else np.arange(len(keys))
                    if len(mine):
                        at = table.find(keys[mine])
                        seen = at >= 0
                        value[mine[seen]] = table.values[at[seen]]
                        fresh, back = np.unique(keys[mine[~seen]], return_inverse=True)
                        value[mine[~seen]] = log_probability(fresh, nodes, depth)[back]
                    score = np.add.reduceat(value, bounds[:-1])
                    columns = _base(raw.tobytes(), ends.tolist(), known, scale) if block == 0 else [[0] * len(score), [0] * len(score), [0.0] * len(score), [None] * len(score)]
                    n_tokens, n_known, base, rare = columns
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.arange(row, row + len(score))), part.column("doc_id"), part.column("h"), part.column("held_out"), pa.array(n_tokens, pa.int64()),
                            pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(score), pa.array(np.diff(ends)), pa.array(rare, pa.list_(pa.int64())),
                        ],
                        names=["row", "doc_id", "h", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes", "rare"],
                    )
                    row += len(score)

        stored.append(cut_lineage(split.mapInArrow(run, _SCORED), "context-scores"))
        model.destroy()
    # the row numbers of the first pass are stored; the others are found by id and text, and rows equal in both score alike
    main = stored[0]
    if len(stored) > 1:
        later = [x.select(*row_key("doc_id", "h"), F.lit(i).alias("block"), "score") for i, x in enumerate(stored[1:])]
        once = reduce(DataFrame.unionByName, later).groupBy("key", "no_id", "h", "block").agg(F.first("score").alias("score"))
        more = once.groupBy("key", "no_id", "h").agg(F.sum("score").alias("more"))
        main = main.select(*main.columns, *row_key("doc_id", "h")[:2]).join(more, ["key", "no_id", "h"]).withColumn("score", F.col("score") + F.col("more")).drop("more", "key", "no_id")
    rare = main.select("row", F.explode("rare").alias("token")).join(tokens, "token", "left")
    rare = rare.groupBy("row").agg(
        F.count("c").alias("rare_known"), F.sum(F.log10((F.coalesce("c", F.lit(0)) + 0.1) / F.lit(scale))).alias("rare_score")
    )
    return main.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        "score", (-F.col("score") * F.lit(1 / log10(2)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def _base(data: bytes, ends: list[int], known: Lookup, scale: float) -> list[list]:
    """Per text: tokens, known frequent tokens, their base score, and the hashes left to the join."""
    columns: list[list] = [[], [], [], []]
    for a, b in zip(ends, ends[1:], strict=False):
        hashes = np.array(_token_hashes(data[a:b]), np.uint64)
        at = known.find(hashes)
        c = known.values[at[at >= 0]]
        columns[0].append(len(hashes))
        columns[1].append(len(c))
        columns[2].append(float(np.log10((c + 0.1) / scale).sum()))
        columns[3].append(hashes[at < 0].view(np.int64).tolist())
    return columns
