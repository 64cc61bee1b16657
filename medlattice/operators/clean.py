"""Checking and cleaning: required columns, null profile, imputation, domain rules.

Fitted values (medians, means, modes) are one number per column. They are computed in one
aggregation over all columns and then applied as literals, so applying them is a narrow step
that also works on a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice import schema as S
from medlattice.functions.hashing import key_hash
from medlattice.functions.scalar import rounded
from medlattice.operators.quantiles import quantile_values


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise ``ValueError`` naming every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def require_rows(df: DataFrame, what: str = "input") -> None:
    """Raise ``ValueError`` when the table is empty; reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require_columns(df, columns)
    return df.select(*columns)


def _missing(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    test = F.col(column).isNull()
    return test | F.isnan(column) if kind in ("double", "float") else test


def _complete(df: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(and_, [~_missing(df, c) for c in columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null, so one notion of missing holds everywhere."""
    floats = [c for c, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def _spread(one_row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """A one-row table of per-column numbers as (column, value) rows."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(value)) for c in columns])
    return one_row.select(F.explode(entries).alias("e")).select("e.*")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per column, in one pass."""
    counts = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in columns])
    return _spread(counts, columns, "null_count")


def drop_critical_nulls(df: DataFrame, columns: Sequence[str] = S.CRITICAL) -> DataFrame:
    """Rows with all of the columns present. Plain null tests reach the Parquet reader, which
    ``dropna`` does not."""
    return df.filter(_complete(df, columns))


def retention_report(df: DataFrame, critical: Sequence[str] = S.CRITICAL, minimum: int = 1000) -> DataFrame:
    """Rows before and after dropping incomplete rows, percent kept, small-result flag."""
    report = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(_complete(df, critical)).alias("rows_after"))
    share = F.when(F.col("rows_before") > 0, F.lit(100.0) * F.col("rows_after") / F.col("rows_before"))
    return report.select(
        "rows_before", "rows_after",
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        rounded(share, 4).alias("percent_kept"),
        (F.col("rows_after") < minimum).alias("below_minimum"),
    )


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percentage of non-missing cells over the given columns, in one pass."""
    filled = sum(((~_missing(df, c)).cast("int") for c in columns), F.lit(0))
    sums = df.agg(F.sum(filled).alias("filled"), F.count(F.lit(1)).alias("n"))
    share = F.when(F.col("n") > 0, F.lit(100.0) * F.col("filled") / (F.col("n") * len(columns)))
    return sums.select(F.col("filled").alias("filled_cells"), rounded(share, 4).alias("completeness_pct"))


@dataclass(frozen=True)
class FillModel:
    """Fitted replacement values; ``transform`` is a projection."""

    values: Mapping[str, float | str] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        present = {c: v for c, v in self.values.items() if c in df.columns and v is not None}
        return df.withColumns(
            {c: F.when(_missing(df, c), F.lit(v)).otherwise(F.col(c)) for c, v in present.items()}
        )

    def merged(self, other: FillModel) -> FillModel:
        return FillModel({**self.values, **other.values})


def fit_median(df: DataFrame, columns: Sequence[str] = S.MEDIAN_FILLED, approx: bool = False) -> FillModel:
    """Exact medians (mean of the middle two for an even count), or those of one scan within a stated rank error."""
    return FillModel(quantile_values(df, columns, 0.5, approx))


def fit_mean(df: DataFrame, columns: Sequence[str] = S.NUMERIC) -> FillModel:
    means = df.agg(*[F.avg(F.when(~_missing(df, c), F.col(c))).alias(c) for c in columns]).first()
    return FillModel(means.asDict())


def fit_mode(df: DataFrame, columns: Sequence[str] = S.MODE_FILLED) -> FillModel:
    """Most frequent non-null value per column, ties by value; one pass for all columns."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    counts = (
        df.select(F.explode(entries).alias("e"))
        .filter(F.col("e.value").isNotNull())
        .groupBy("e.column", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("best"))
    return FillModel({r["column"]: r["best"]["value"] for r in best.collect()})


def cast_numeric(df: DataFrame, columns: Sequence[str] = S.NUMERIC) -> DataFrame:
    """Numeric columns as double; text that is no number becomes null and is counted in
    ``cast_failures``."""
    failed = sum(
        ((F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).cast("int") for c in columns), F.lit(0)
    )
    return df.withColumn("cast_failures", failed).withColumns(
        {c: F.col(c).try_cast("double") for c in columns}
    )


def domain_failures(
    ranges: Mapping[str, tuple[float, float]] = S.INTAKE_RANGES,
    choices: Mapping[str, Sequence[str]] = S.INTAKE_CHOICES,
) -> Column:
    """Names of the columns that break their range or choice list; missing counts as broken."""
    checks = [(c, F.coalesce(F.col(c).between(low, high), F.lit(False))) for c, (low, high) in ranges.items()]
    checks += [(c, F.coalesce(F.col(c).isin(*levels), F.lit(False))) for c, levels in choices.items()]
    return F.array_compact(F.array(*[F.when(~ok, F.lit(c)) for c, ok in checks]))


def domain_check(df: DataFrame) -> DataFrame:
    """Append ``failed_rules`` (array of column names) and ``verdict`` accepted / rejected."""
    checked = df.withColumn("failed_rules", domain_failures())
    return checked.withColumn(
        "verdict", F.when(F.size("failed_rules") == 0, "accepted").otherwise("rejected")
    )


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with their failed rules)."""
    checked = domain_check(df)
    clean = checked.filter(F.col("verdict") == "accepted").drop("failed_rules", "verdict")
    return clean, checked.filter(F.col("verdict") == "rejected").drop("verdict")


def sample_rows(df: DataFrame, n: int, key: str = "patient_id", seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones for any partitioning: the ``n`` smallest
    hashes. Every task keeps its own best ``n`` before anything moves."""
    return df.orderBy(key_hash(key, seed), key).limit(n)


def preview(df: DataFrame, n: int, key: str = "patient_id") -> DataFrame:
    """First ``n`` rows in key order."""
    return df.orderBy(key).limit(n)


def clean_patients(df: DataFrame) -> tuple[DataFrame, FillModel]:
    """The cleaning chain: required columns, critical nulls, casts, median and mode fill."""
    keep = [c for c in ("patient_id",) if c in df.columns] + list(S.REQUIRED)
    base = nan_to_null(cast_numeric(project(df, keep)).drop("cast_failures"))
    base = drop_critical_nulls(base)
    fill = fit_median(base).merged(fit_mode(base))
    return fill.transform(base), fill
