"""Quantiles of large columns: exact ones by brackets, approximate ones by a mergeable sketch.

Exact, without gathering or shuffling a column:

1. a sketch per (group, column) brackets every wanted rank between two values, a few ten-thousandths of the rows apart
   whatever the distribution is,
2. rows below and inside each bracket are counted, which proves that the rank lies inside (else the bracket is widened),
3. only the values inside move; equal values are merged before they do. As long as one bracket holds more than ``INSIDE``
   different values it is cut again, by a sketch of these values, and the part with the rank is kept.

So neither an outlier, nor an infinity, nor a value held by a third of all rows makes a crowded task.

Approximate: values are counted in cells of their leading bits (``approximate_quantiles``), one plain grouped count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlattice.session import broadcast_if_small, cut_lineage

#: rank error of the bracketing sketch is one in this many rows
ACCURACY = 10_000

#: different values of a bracket that one task may order
INSIDE = 200_000

#: parts a crowded bracket is cut into
PIECES = 64

#: (group, column) rows that are broadcast; more are joined
BROADCAST_ROWS = 20_000

#: leading bits of a value that name its cell, the sign and the exponent among them
CELL_BITS = 22


def values_long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(group, column, value) rows of the non-null, non-NaN values of numeric columns."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return (
        df.select(*by, F.explode(entries).alias("e"))
        .select(*by, "e.column", "e.value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def _bracketed(values: DataFrame, keys: Sequence[str], probs: Sequence[float], slack: float, small_keys: bool) -> tuple[DataFrame, bool]:
    """(keys, brackets) with an array of (p, position, lo, hi, below, inside) per key, and whether every rank lies
    inside its bracket."""
    shares = [min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)]
    sketch = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.min("value").alias("least"), F.max("value").alias("most"),
        F.percentile_approx("value", shares, ACCURACY).alias("q"),
    )
    marks = sketch.select(
        *keys, "total",
        F.array(*[F.when(F.lit(shares[2 * i] > 0), F.col("q")[2 * i]).otherwise(F.col("least")) for i in range(len(probs))]).alias("lo"),
        F.array(*[F.when(F.lit(shares[2 * i + 1] < 1), F.col("q")[2 * i + 1]).otherwise(F.col("most")) for i in range(len(probs))]).alias("hi"),
    )
    marks = broadcast_if_small(marks, "marks", BROADCAST_ROWS)[0] if small_keys else F.broadcast(cut_lineage(marks, "marks"))
    counts = []
    for i in range(len(probs)):
        counts += [F.count_if(F.col("value") < F.col("lo")[i]).alias(f"b{i}"), F.count_if((F.col("value") >= F.col("lo")[i]) & (F.col("value") <= F.col("hi")[i])).alias(f"n{i}")]
    placed = _join_null_safe(values, marks, keys)
    # the marks join again: kept by the aggregation, their arrays would have every value sorted for it
    counted = _join_null_safe(placed.groupBy(*keys).agg(*counts), marks, keys)
    brackets = F.array(*[
        F.struct(
            F.lit(float(p)).alias("p"), (F.lit(float(p)) * (F.col("total") - 1)).alias("position"), F.col("lo")[i].alias("lo"), F.col("hi")[i].alias("hi"),
            F.col(f"b{i}").alias("below"), F.col(f"n{i}").alias("inside"),
        )
        for i, p in enumerate(probs)
    ])
    found = cut_lineage(counted.select(*keys, brackets.alias("brackets")), "brackets")
    outside = F.exists("brackets", lambda b: (b["below"] > F.floor(b["position"])) | (F.ceil(b["position"]) >= b["below"] + b["inside"]))
    return found, not found.filter(outside).limit(1).count()


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles: one row per (group, column, p) with ``quantile``.

    The joins are with one row per (group, column). Without groups that is bounded by the number of columns and is
    broadcast; with groups the number is checked first.
    """
    keys = [*by, "column"]
    values = values_long(df, columns, by)
    slack = 2.0 / ACCURACY
    while True:
        brackets, proven = _bracketed(values, keys, probs, slack, bool(by))
        if proven or slack >= 1:
            break
        slack *= 8
    joined = broadcast_if_small(brackets, "brackets", BROADCAST_ROWS)[0] if by else F.broadcast(brackets)
    inside = _join_null_safe(values, joined, keys).select(
        *keys, "value", F.explode(F.filter("brackets", lambda b: (F.col("value") >= b["lo"]) & (F.col("value") <= b["hi"]))).alias("b")
    )
    merged = inside.groupBy(*keys, F.col("b.p").alias("p"), "value").agg(
        F.count(F.lit(1)).alias("n"), F.first("b.below").alias("before"), F.first("b.position").alias("position")
    )
    merged = _refined(cut_lineage(merged, "bracket-values"), [*keys, "p"])

    # the two ranks around the position and their weights
    upto = Window.partitionBy(*keys, "p").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    low = F.floor("position")
    share = F.col("position") - low
    hits = merged.withColumn("end", F.col("before") + F.sum("n").over(upto)).withColumn("start", F.col("end") - F.col("n"))

    def weight(rank: Column, w: Column) -> Column:
        return F.when((rank >= F.col("start")) & (rank < F.col("end")), w).otherwise(0.0)

    hits = hits.withColumn("w", weight(low, F.lit(1.0) - share) + weight(low + 1, share)).filter("w > 0")
    return hits.groupBy(*keys, "p").agg(F.sum(F.col("value") * F.col("w")).alias("quantile"))


def _refined(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``merged`` (keys, value, n, before, position) with at most ``INSIDE`` values per key, all that the position needs."""
    while True:
        crowded = merged.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), F.percentile_approx("value", [i / PIECES for i in range(1, PIECES)], ACCURACY).alias("cuts"))
        crowded = cut_lineage(crowded.filter(F.col("m") > INSIDE).select(*keys, "cuts"), "crowded")
        if not crowded.limit(1).count():
            return merged
        # cells are parted by values of the sketch, so each holds about one in PIECES of the values
        placed = _join_null_safe(merged, crowded, keys, "left").withColumn(
            "cell", F.when(F.col("cuts").isNull(), F.lit(-1)).otherwise(F.size(F.filter("cuts", lambda c: c < F.col("value"))))
        )
        placed = cut_lineage(placed.drop("cuts"), "cells")
        per_key = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        sums = placed.groupBy(*keys, "cell").agg(F.sum("n").alias("cell_n"), F.first("before").alias("from"), F.first("position").alias("at"))
        sums = sums.withColumn("ahead", F.col("from") + F.coalesce(F.sum("cell_n").over(per_key), F.lit(0)))
        wanted = sums.filter((F.col("ahead") <= F.ceil("at")) & (F.col("ahead") + F.col("cell_n") > F.floor("at"))).select(*keys, "cell", "ahead")
        # both ranks of a position lie in neighbouring cells at worst; what stands before the first is counted once
        kept = _join_null_safe(placed, cut_lineage(wanted, "wanted-cells"), [*keys, "cell"])
        first = Window.partitionBy(*keys)
        lead = cut_lineage(wanted.withColumn("start", F.min("ahead").over(first)).select(*keys, "start").distinct(), "cell-starts")
        merged = cut_lineage(
            _join_null_safe(kept.drop("before", "ahead"), lead, keys).select(*keys, "value", "n", F.col("start").alias("before"), "position"), "bracket-values"
        )


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


# --- the sketch -----------------------------------------------------------------------------


def sketch_cells(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The mergeable sketch of ``value`` per key: (keys, cell, n, least, most), one row per cell that occurs.

    A cell is a sign, a power of two and a step of its mantissa, so it is about a thousandth of its values wide. Cells are plain
    counts: sketches of two tables add up, the partitioning changes nothing, and a stream keeps them as a grouped count.
    """
    size = F.abs("value")
    power = F.when(size == 0, F.lit(-2000)).when(size == float("inf"), F.lit(2000)).otherwise(F.floor(F.log2(size)))
    step = 1 << (CELL_BITS - 12)
    within = F.when(power.between(-1022, 1023), F.floor((size / F.pow(F.lit(2.0), power) - 1) * step)).otherwise(F.lit(0))
    cell = (power.cast("long") + 3000) * (step * 4) + within.cast("long") + 1
    signed = F.when(F.col("value") < 0, -cell).when(F.col("value") == 0, F.lit(0).cast("long")).otherwise(cell)
    return values.groupBy(*keys, signed.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


def from_cells(cells: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys, p, quantile, rank_error) of a sketch. The value lies in the cell of the wanted rank; ``rank_error`` is the share of
    rows that this cell holds, the most by which the rank of the value can be off."""
    per_key = Window.partitionBy(*keys)
    upto = per_key.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumn("end", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(per_key))
    asked = placed.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    rank = F.floor(F.col("p") * (F.col("total") - 1))
    hits = asked.filter((rank < F.col("end")) & (rank >= F.col("end") - F.col("n")))
    inside = (rank - F.col("end") + F.col("n") + 0.5) / F.col("n")
    value = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(F.col("least") + (F.col("most") - F.col("least")) * inside)
    return hits.select(*keys, "p", value.alias("quantile"), F.when(F.col("least") == F.col("most"), 0.0).otherwise(F.col("n") / F.col("total")).alias("rank_error"))


def approximate_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Like ``exact_quantiles`` in one scan, off by at most the ``rank_error`` of each row."""
    keys = [*by, "column"]
    return from_cells(sketch_cells(values_long(df, columns, by), keys), keys, probs)


def quantile_values(df: DataFrame, columns: Sequence[str], p: float = 0.5, approx: bool = False) -> dict[str, float]:
    """Quantile per column as a dict: one number per column reaches the driver."""
    found = approximate_quantiles(df, columns, [p]) if approx else exact_quantiles(df, columns, [p])
    return {r["column"]: r["quantile"] for r in found.collect()}
