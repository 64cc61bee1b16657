"""Counts, group profiles, histograms, correlation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medlattice.functions.scalar import rounded
from medlattice.operators.quantiles import BROADCAST_ROWS, exact_quantiles, values_long
from medlattice.session import broadcast_if_small


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values per column; partial distincts run before the shuffle."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    distinct = df.select(F.explode(entries).alias("e")).select("e.column", "e.value").distinct()
    return distinct.groupBy("column").agg(F.count("value").alias("distinct_count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage of every value, most frequent first, ties by value."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.select(
        "value", "n", rounded(F.lit(100.0) * F.col("n") / total, 4).alias("percent")
    ).orderBy(F.col("n").desc(), "value")


def column_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``value_counts`` of several text columns in one pass: (column, value, n, percent)."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    counts = (
        df.select(F.explode(entries).alias("e"))
        .groupBy("e.column", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Every column has one entry per row, so the row total is the sum divided by the columns.
    total = counts.agg((F.sum("n") / len(columns)).alias("t")).scalar()
    return counts.select(
        "column", "value", "n", rounded(F.lit(100.0) * F.col("n") / total, 4).alias("percent")
    )


def group_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(by)


def group_means(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(by).agg(*[rounded(F.avg(c)).alias(f"avg_{c}") for c in columns]).orderBy(by)


def contingency(df: DataFrame, by: str, column: str, values: Sequence[str]) -> DataFrame:
    """One row per group, one count column per value, 0 where absent, and ``_other`` for the rows whose
    value is none of them (or null), so the counts of a group always add up to its rows.

    The values are given, so no extra job looks for them and the pivot is one aggregation.
    """
    known = F.when(F.col(column).isin(list(values)), F.col(column).cast("string")).otherwise(F.lit("_other"))
    counted = df.select(by, known.alias("_value")).groupBy(by).pivot("_value", [*map(str, values), "_other"])
    return counted.agg(F.count(F.lit(1))).na.fill(0)


def top_per_group(df: DataFrame, by: str, column: str, n: int = 3) -> DataFrame:
    """The ``n`` most frequent values of each group, ties by value.

    Ranking runs on the counted values, with the row limit applied before the shuffle too.
    """
    counts = df.groupBy(by, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(by).orderBy(F.col("n").desc(), F.col("value"))
    return counts.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= n)


def group_profile(df: DataFrame, by: str, measures: Sequence[str], column: str, n: int = 3) -> DataFrame:
    """Size, means and top values of each group, from one scan.

    Rows are pre-aggregated by (group, value); group totals and the ranking both read that.
    """
    sums = [F.sum(m).alias(f"s_{m}") for m in measures] + [F.count(m).alias(f"c_{m}") for m in measures]
    cells = df.groupBy(by, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"), *sums)
    totals = cells.groupBy(by).agg(
        F.sum("n").alias("n"), *[rounded(F.sum(f"s_{m}") / F.sum(f"c_{m}")).alias(f"avg_{m}") for m in measures]
    )
    order = Window.partitionBy(by).orderBy(F.col("n").desc(), F.col("value"))
    best = cells.select(by, "value", F.row_number().over(order).alias("rank")).filter(F.col("rank") <= n)
    tops = best.groupBy(F.col(by).alias("_by")).agg(
        *[F.max(F.when(F.col("rank") == i + 1, F.col("value"))).alias(f"top_{i + 1}") for i in range(n)]
    )
    joined = totals.join(tops, F.col(by).eqNullSafe(F.col("_by")))
    return joined.drop("_by").orderBy(by)


def box_summary(df: DataFrame, by: str, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Five-number summary per (group, column); whiskers are the extreme values within
    ``reach`` interquartile ranges of the box."""
    names = ("q1", "median", "q3")
    quartiles = (
        exact_quantiles(df, columns, (0.25, 0.5, 0.75), [by])
        .groupBy(F.col(by).alias("_by"), F.col("column").alias("_column"))
        .agg(*[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(n) for p, n in zip((0.25, 0.5, 0.75), names, strict=True)])
    )
    quartiles, _ = broadcast_if_small(quartiles, "quartiles", BROADCAST_ROWS)
    spread = F.col("q3") - F.col("q1")
    inside = F.col("value").between(F.col("q1") - reach * spread, F.col("q3") + reach * spread)
    values = values_long(df, columns, [by])
    joined = values.join(quartiles, F.col(by).eqNullSafe(F.col("_by")) & (F.col("column") == F.col("_column")))
    whiskers = joined.filter(inside).groupBy(by, "column", *names).agg(
        F.min("value").alias("whisker_low"), F.max("value").alias("whisker_high")
    )
    return whiskers.select(by, "column", *[rounded(c).alias(c) for c in (*names, "whisker_low", "whisker_high")])


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over the column's own range; empty bins are kept."""
    value = F.col(column).cast("double")
    data = df.select(value.alias("value")).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    span = data.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")).alias("s")).scalar()
    lo, hi = span["lo"], span["hi"]
    width = (hi - lo) / bins
    place = F.when(hi > lo, F.least(F.floor((F.col("value") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = data.groupBy(place.cast("int").alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, frame["bin"] == counts["_bin"], "left").select(
        "bin",
        rounded(lo + F.col("bin") * width).alias("low"),
        rounded(lo + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair in long form, one aggregation.

    Pairs are complete-case per pair; the matrix is symmetric, so each pair is computed once.
    """
    names = list(columns)
    pairs = list(combinations(range(len(names)), 2))
    one = df.agg(
        *[F.corr(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(names)],
    )
    cells = []
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            if i == j:
                value = F.when(F.col(f"s{i}") > 0, F.lit(1.0))
            else:
                value = F.col(f"c{min(i, j)}_{max(i, j)}")
            cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), rounded(value).alias("corr")))
    return one.select(F.explode(F.array(*cells)).alias("e")).select("e.*")
