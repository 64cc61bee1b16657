"""Explanation records, global importance and explanation text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice import schema as S
from medlattice.functions.scalar import as_column, rounded
from medlattice.operators.attribution import named, tree_shap
from medlattice.operators.models import Trained
from medlattice.operators.ranking import confidence, top_classes, top_contributions


def linear_attribution(df: DataFrame, coefficients: Mapping[str, float], keys: Sequence[str] = ("patient_id",)) -> DataFrame:
    """coefficient * (value - mean) per feature: the exact Shapley values of a linear model.

    Means come from one aggregation of ``df`` and are applied as a scalar value.
    """
    names = list(coefficients)
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in names]).alias("m")).scalar()
    values = F.array(*[F.lit(float(coefficients[c])) * (F.col(c) - F.col(f"_means.{c}")) for c in names])
    return df.withColumn("_means", means).select(*keys, named(values, names).alias("contributions"))


def global_importance(df: DataFrame, by: Sequence[str] = (), contributions: str = "contributions") -> DataFrame:
    """Mean magnitude and rank-ready share per feature, optionally per class.

    Entries are averaged with map-side partial sums; one row per feature is shuffled.
    """
    entries = df.select(*by, F.explode(contributions).alias("e")).select(*by, "e.*")
    return long_importance(entries, by)


def long_importance(entries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same from (feature, value) rows."""
    return entries.groupBy(*by, "feature").agg(rounded(F.avg(F.abs("value"))).alias("importance"))


def explanation_text(contributions: Column | str, n: int = 5, labels: Mapping[str, str] = S.FEATURE_LABELS) -> Column:
    """One line per top contribution: label, direction and size of the effect."""

    def line(entry: Column) -> Column:
        label = entry["feature"]
        chain = F
        for name, text in labels.items():
            chain = chain.when(label == name, F.lit(text))
        direction = F.when(entry["value"] > 0, F.lit("increases")).otherwise(F.lit("decreases"))
        return F.concat(
            F.lit("• "), chain.otherwise(label), F.lit(" "), direction, F.lit(" risk (impact: "),
            F.format_string("%.3f", F.abs(entry["value"])), F.lit(")"),
        )

    return F.array_join(F.transform(top_contributions(as_column(contributions), n), line), "\n")


def explain(
    trained: Trained, df: DataFrame, names: Sequence[str] = S.ORDINAL_FEATURES, keys: Sequence[str] = ("patient_id",),
    n: int = 5,
) -> DataFrame:
    """Explanation record per row: prediction, confidence, top classes, ordered contributions
    and text. A single patient is a one-row table."""
    shap = tree_shap(trained, df, names, keys)
    return shap.select(
        *keys, "prediction", confidence("probability", "class").alias("confidence"), "probability",
        top_classes("probability", 3).alias("top_classes"), "base_value", "explained_value",
        top_contributions("contributions", None).alias("contributions"),
        explanation_text("contributions", n).alias("explanation"),
    )
