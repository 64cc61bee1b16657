"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words; all its documents then have the same expected number of
copies, target / size. The whole part is taken at once. The fractional parts are rounded jointly:
two documents exchange expected words, in a random direction that keeps each expectation, until one
of the two fractions is 0 or 1. The sum of words never changes on the way, so a source ends within
one document of its target.

Documents are dealt to buckets of about ``BUCKET`` rows; every bucket leaves at most one fractional
document, and these residuals are combined ``FAN_IN`` buckets at a time by a reduction tree, so no
task ever sees a whole source. Only one row per source (name and size) reaches the driver. All
random numbers are hashes of the rows: reruns and retries agree.

Defined cases: null and empty texts have size 0 and take 0 words; a null source is a source of its
own, the last; a null ``doc_id`` is kept; repeated rows are rounded each; an empty table gives an
empty result; a source of size 0 has target 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import cut_lineage, n_words, packed, row_key

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BUCKET, FAN_IN, SEED = 2_000, 64, 7

_STATE = "doc_id long, h long, source string, size long, source_size long, target double, copies int, fraction double, bucket long"


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Words per source: the weights' shares of 150 % of all words, none above twice its size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    rest, out, open_ = SHARE * sum(sizes.values()), {}, list(order)
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > MOST * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        for s in full:
            out[s] = MOST * sizes[s]
            rest -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def draw(*parts: int) -> float:
    """A number in [0, 1) that depends on the parts alone; each use names other parts."""
    x = SEED
    for part in parts:
        x = (x + part + 0x9E3779B97F4A7C15) % 2**64
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
        x ^= x >> 31
    return x / 2**64


def pivot(size: list[int], h: list[int], fraction: list[float], level: int, last: bool) -> list[float]:
    """Round the open fractions of one bucket in the given order; at most one stays open unless ``last``."""
    fraction = list(fraction)
    held = None
    for i, f in enumerate(fraction):
        if not 0.0 < f < 1.0:
            continue
        if held is None:
            held = i
            continue
        a, ratio = fraction[held], size[i] / size[held]
        up, down = min(1.0 - a, f * ratio), min(a, (1.0 - f) * ratio)
        move = up if draw(level, h[held], h[i]) * (up + down) < down else -down
        # whichever bound was hit is set exactly
        if move > 0:
            a, f = (1.0, f - (1.0 - a) / ratio) if up == 1.0 - a else (a + move, 0.0)
        else:
            a, f = (0.0, f + a / ratio) if down == a else (a + move, 1.0)
        fraction[held], fraction[i] = a, f
        if a in (0.0, 1.0):
            held = i if 0.0 < f < 1.0 else None
    if last and held is not None:
        fraction[held] = float(draw(level, h[held]) < fraction[held])
    return fraction


def _rounding(level: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        # largest first, so that the last open document tends to be a small one
        rows = rows.sort_by([("size", "descending"), ("h", "ascending"), ("doc_id", "ascending")])
        rounded = pivot(*[rows.column(c).to_pylist() for c in ("size", "h", "fraction")], level, last)
        return rows.set_column(rows.column_names.index("fraction"), "fraction", pa.array(rounded, pa.float64()))

    return run


def mixed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``h`` (hash of the text), ``size``, ``source``, ``source_size``, ``target`` and ``copies`` of every row."""
    sized = cut_lineage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")), F.coalesce("doc_id", F.lit(-1))).alias("h"),
            "source", n_words(F.col("text")).alias("size"),
        ),
        "mix-sizes",
    )
    spark = docs.sparkSession
    per_source = {r["source"]: (r["size"], r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    target = targets({s: size for s, (size, _) in per_source.items()})
    plan = spark.createDataFrame(
        [(s, size, target[s], -(-n // BUCKET)) for s, (size, n) in per_source.items()],
        "name string, source_size long, target double, buckets long",
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("rate")
    dealt = (
        sized.join(F.broadcast(plan) if len(per_source) <= 100_000 else plan, F.col("source").eqNullSafe(F.col("name")))
        .withColumn("rate", rate)
        .select(
            "doc_id", "h", "source", "size", "source_size", "target", whole.cast("int").alias("copies"),
            F.when(F.col("size") > 0, F.col("rate") - whole).otherwise(F.lit(0.0)).alias("fraction"),
            F.expr("pmod(xxhash64(h), buckets)").alias("bucket"),
        )
    )
    open_, buckets, done = dealt, max([n for _, n in per_source.values()], default=0) // BUCKET + 1, []
    while True:
        last = buckets <= 1

        rounded = cut_lineage(open_.groupBy("source", "bucket").applyInArrow(_rounding(len(done), last), _STATE), "mix-level")
        settled = (F.col("fraction") == 0) | (F.col("fraction") == 1)
        done.append(rounded if last else rounded.where(settled))
        if last:
            break
        open_ = rounded.where(~settled).withColumn("bucket", F.expr(f"bucket div {FAN_IN}"))
        buckets = -(-buckets // FAN_IN)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(
        "doc_id", "h", "source", "size", "source_size", "target", (F.col("copies") + F.col("fraction").cast("int")).alias("copies")
    )


def with_copies(docs: DataFrame) -> DataFrame:
    """The documents the mix takes, with ``copies``; repeated rows come once with the sum of their copies.
    A column ``copies`` of ``docs`` is replaced."""
    taken = mixed(docs).groupBy("doc_id", "h").agg(F.sum("copies").cast("long").alias("copies")).where("copies > 0")
    taken = taken.select(*row_key("doc_id", "h"), F.col("copies").alias("taken_copies"))
    hashed = F.xxhash64(F.coalesce("text", F.lit("")), F.coalesce("doc_id", F.lit(-1)))
    keyed = packed(docs, *row_key("doc_id", hashed))
    once = keyed.join(taken, ["key", "no_id", "h"]).dropDuplicates(["key", "no_id", "h"])
    return once.select(*[f"row.`{c}`" for c in docs.columns if c != "copies"], F.col("taken_copies").alias("copies"))
