"""Product codes of vectors by ball k-means.

Components become integers, a vector is cut into ``PARTS`` equal parts, and each part position has a codebook that
``ROUNDS`` rounds of k-means refine from the parts of the smallest ids. All arithmetic is exact.

* The members of an entry are its *ball*. Its radius, carried over the move of the entry, bounds how far a member
  lies from the moved entry; only entries within twice that radius are *neighbours*, no other can win a member.
* A ball is *stable* when neither its entry nor a neighbour moved: its members keep code and distance unseen.
* In other balls a member at distance r from its entry meets the neighbours within 2 r only. They are sorted by distance,
  so members fall into *annular rings* of growing candidate lists; the *core*, below half of the way to the nearest
  neighbour, has none. Entries at exactly 2 r may tie, so they are candidates and the lower index wins.
* The first round, without balls yet, compares with all entries.
* Every round is a narrow pass over a written table of integers, codes and distances, and partial sums per task that
  Spark adds up. Driver and tasks hold the codebooks only: at most 256 entries of one vector's width.

Defined cases: rows whose vector is null, empty or holds null or non-finite components are dropped, and so are vectors
of another length than that of the first entry; a null ``vec_id`` is kept and comes last; rows of equal id are ordered
by their components; with fewer than 256 rows there are as many entries as rows; equal labels share an error sum, nulls
together; an empty table gives an empty result; other columns are ignored. Components of 65,536 or more and lengths not
divisible by 4 are refused with an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import cut_lineage
from medlattice.session import broadcast_if_small

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: exact products need components below this; cells of vectors worked on at a time; labels broadcast at most
LIMIT, CELLS, BROADCAST_ROWS = 1 << 26, 1 << 20, 200_000
RINGS = 4
_STATE = "vec_id long, label {label}, v array<int>, code array<int>, dist array<long>"


def integers(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and the integer vector ``v`` of every usable row."""
    sound = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    whole = F.transform("embedding", lambda x: F.when(F.abs(x) * SCALE < LIMIT, F.floor(x.cast("double") * SCALE).cast("int")).otherwise(
        F.raise_error(F.lit("vector components of 65,536 or more are not supported")).cast("int")
    ))
    return embeddings.where(F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), "label", whole.alias("v"))


# ---- one round, on the driver ------------------------------------------------------------------


@dataclass
class Balls:
    """One part position: the entries, and per entry its neighbours by distance and whether its ball is stable."""

    centers: np.ndarray
    near: list[np.ndarray]
    apart: list[np.ndarray]
    stable: np.ndarray


def squared(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, entries) as int64; through floating point products where these are exact."""
    width = one.shape[1]
    most = max(int(np.abs(one).max(initial=0)), int(np.abs(many).max(initial=0)))
    if 4 * most * most * width < 1 << 53:
        a, b = one.astype(np.float64), many.astype(np.float64)
        return np.rint((a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.zeros((len(one), len(many)), np.int64)
    for j in range(width):
        gap = one[:, j, None] - many[None, :, j]
        out += gap * gap
    return out


def balls(centers: np.ndarray, before: np.ndarray, radius: np.ndarray) -> Balls:
    """Neighbours after entries moved from ``before`` to ``centers``; ``radius`` holds the largest squared distance of a
    member to its former entry, -1 for an entry without members."""
    apart = squared(centers, centers)
    gap = (centers - before).astype(np.float64)
    moved = (centers != before).any(axis=1)
    # rounded up generously: a larger ball only adds candidates
    reach = np.where(radius >= 0, (np.sqrt(np.maximum(radius, 0)) + np.sqrt((gap * gap).sum(axis=1))) * (1 + 1e-9) + 1e-6, 0.0)
    near, distances, stable = [], [], np.zeros(len(centers), bool)
    for i in range(len(centers)):
        others = np.flatnonzero(apart[i] <= (2 * reach[i]) ** 2 * (1 + 1e-9))
        others = others[others != i]
        others = others[np.argsort(apart[i, others], kind="stable")]
        near.append(others), distances.append(apart[i, others])
        stable[i] = not moved[i] and not moved[others].any()
    return Balls(centers, near, distances, stable)


# ---- one round, in a task ----------------------------------------------------------------------


def nearest(points: np.ndarray, centers: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the nearest of ``centers``, of the lowest name on a tie."""
    order = np.argsort(names)
    d = squared(points, centers[order])
    at = d.argmin(axis=1)
    return names[order][at], d[np.arange(len(points)), at]


def reassigned(points: np.ndarray, code: np.ndarray, dist: np.ndarray, space: Balls) -> tuple[np.ndarray, np.ndarray]:
    """New (code, distance) of the parts of some vectors that had ``code`` and ``dist``."""
    code, dist = code.copy(), dist.copy()
    order = np.argsort(code, kind="stable")
    cuts = np.flatnonzero(np.diff(code[order])) + 1
    for rows in np.split(order, cuts):
        if not len(rows):
            continue
        own = int(code[rows[0]])
        if space.stable[own]:
            continue
        r = squared(points[rows], space.centers[own : own + 1])[:, 0]
        dist[rows] = r
        # candidates: neighbours no further from the entry than twice the member
        ring = np.searchsorted(space.apart[own], 4 * r, side="right")
        outside = np.flatnonzero(ring)
        if not len(outside):
            continue
        outside = outside[np.argsort(ring[outside], kind="stable")]
        for part in np.array_split(outside, min(RINGS, len(outside))):
            names = np.append(space.near[own][: ring[part[-1]]], own)
            code[rows[part]], dist[rows[part]] = nearest(points[rows[part]], space.centers[names], names)
    return code, dist


def _vectors(batch: pa.RecordBatch | pa.Table, column: str, width: int, kind: type) -> np.ndarray:
    values = batch.column(column).combine_chunks() if isinstance(batch, pa.Table) else batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches joined to ``rows`` rows or more: a ball of a small batch has few members."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _assigned(state: DataFrame, spaces: list[Balls] | None, books: np.ndarray, width: int) -> DataFrame:
    """``state`` with the codes and distances of this round. Without ``spaces`` all entries are compared."""
    shared = state.sparkSession.sparkContext.broadcast((spaces, books))
    rows = max(256, CELLS // (PARTS * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces, books = shared.value
        every = np.arange(books.shape[1])
        for table in _gathered(batches, rows):
            v = _vectors(table, "v", PARTS * width, np.int64)
            code = np.zeros((len(v), PARTS), np.int64)
            dist = np.zeros((len(v), PARTS), np.int64)
            if spaces:
                old, far = _vectors(table, "code", PARTS, np.int64), _vectors(table, "dist", PARTS, np.int64)
            for p in range(PARTS):
                points = v[:, p * width : (p + 1) * width]
                code[:, p], dist[:, p] = reassigned(points, old[:, p], far[:, p], spaces[p]) if spaces else nearest(points, books[p], every)
            ends = pa.array(np.arange(len(v) + 1, dtype=np.int32) * PARTS)
            out = pa.Table.from_arrays(
                [table.column("vec_id"), table.column("label"), table.column("v"),
                 pa.ListArray.from_arrays(ends, pa.array(code.astype(np.int32).ravel())), pa.ListArray.from_arrays(ends, pa.array(dist.ravel()))],
                names=["vec_id", "label", "v", "code", "dist"],
            )
            yield from out.to_batches()

    return cut_lineage(state.mapInArrow(run, _STATE.format(label=dict(state.dtypes)["label"])), "ball-codes")


def _updated(state: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(new entries, radii): sums per task, added up by Spark; unused entries stay."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # per entry: the components' sums, then the members
        sums = np.zeros((parts, entries, width + 1), np.int64)
        radius = np.full((parts, entries), -1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v, code, dist = _vectors(batch, "v", parts * width, np.int64), _vectors(batch, "code", parts, np.int64), _vectors(batch, "dist", parts, np.int64)
            for p in range(parts):
                order = np.argsort(code[:, p], kind="stable")
                used, starts, n = np.unique(code[order, p], return_index=True, return_counts=True)
                sums[p, used, :width] += np.add.reduceat(v[order, p * width : (p + 1) * width], starts)
                sums[p, used, width] += n
                radius[p, used] = np.maximum(radius[p, used], np.maximum.reduceat(dist[order, p], starts))
        p, e = np.nonzero(sums[:, :, width])
        flat = pa.array(sums[p, e].ravel())
        ends = pa.array(np.arange(len(p) + 1, dtype=np.int32) * (width + 1))
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(radius[p, e]), pa.ListArray.from_arrays(ends, flat)], names=["part", "entry", "radius", "sums"])

    found = state.select("v", "code", "dist").mapInArrow(run, "part long, entry long, radius long, sums array<long>")
    slots = found.select("part", "entry", "radius", F.posexplode("sums").alias("at", "x"))
    totals = slots.groupBy("part", "entry", "at").agg(F.sum("x").alias("x"), F.max("radius").alias("radius")).collect()
    sums, radius = np.zeros((parts, entries, width + 1), np.int64), np.full((parts, entries), -1, np.int64)
    for part, entry, at, x, far in totals:
        sums[part, entry, at], radius[part, entry] = x, far
    count = sums[:, :, width:]
    return np.where(count > 0, sums[:, :, :width] // np.maximum(count, 1), books), radius


# ---- the operator ------------------------------------------------------------------------------


def fitted(embeddings: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(``vec_id``, ``label``, ``v``, ``code``, ``dist`` of every usable row, the codebooks (part, entry, component))."""
    kept = cut_lineage(integers(embeddings), "ball-integers")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return kept.withColumns({"code": F.lit(None).cast("array<int>"), "dist": F.lit(None).cast("array<long>")}), np.zeros((PARTS, 0, 0), np.int64)
    length = len(first[0]["v"])
    if length % PARTS:
        raise ValueError(f"vectors of {length} components cannot be cut into {PARTS} equal parts")
    kept = kept.where(F.size("v") == length)
    rows = [r["v"] for r in first if len(r["v"]) == length]
    if len(rows) < len(first):
        rows = [r["v"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()]
    width = length // PARTS
    books = np.array(rows, np.int64).reshape(len(rows), PARTS, width).transpose(1, 0, 2).copy()
    state = _assigned(kept, None, books, width)
    for _ in range(rounds):
        moved, radius = _updated(state, books)
        state = _assigned(state, [balls(moved[p], books[p], radius[p]) for p in range(PARTS)], moved, width)
        books = moved
    return state, books


def digest(books: np.ndarray) -> str:
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def codes(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable row."""
    state, books = fitted(embeddings)

    def shown(code: Column) -> Column:
        return F.array_join(F.transform(code, lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0"))), "")

    rows = state.select("vec_id", "label", shown(F.col("code")).alias("code"), F.aggregate("dist", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"))
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of_label")
    sums, _ = broadcast_if_small(sums, "ball-labels", BROADCAST_ROWS)
    joined = rows.join(sums, rows.label.eqNullSafe(sums.of_label))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
