"""Classification and clustering quality.

Everything derives from one confusion-matrix aggregation: scored rows are counted per
(label, prediction) with map-side partial sums, and only that small table is read afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.functions.scalar import rounded


def confusion_matrix(df: DataFrame, label="label", prediction="prediction", by: Sequence[str] = ()) -> DataFrame:
    """Rows per (label, prediction), optionally per group; null labels are left out."""
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _per_class(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """tp, support and predicted count of every class seen on either side."""
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0)).alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("tp")),
    )
    return (
        cells.select(*by, F.explode(sides).alias("side"))
        .select(*by, "side.*")
        .filter(F.col("class").isNotNull())
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    )


def _with_scores(classes: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    tp = F.col("tp").cast("double")
    return classes.withColumns(
        {
            "precision": F.when(F.col("predicted") > 0, tp / F.col("predicted")).otherwise(zero),
            "recall": F.when(F.col("support") > 0, tp / F.col("support")).otherwise(zero),
            "f1_score": F.when(
                F.col("predicted") + F.col("support") > 0,
                F.lit(2.0) * tp / (F.col("predicted") + F.col("support")),
            ).otherwise(zero),
        }
    )


def class_report(df: DataFrame, label="label", prediction="prediction", by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class (0 where undefined)."""
    classes = _with_scores(_per_class(confusion_matrix(df, label, prediction, by), by))
    return classes.select(
        *by, "class", "support", "predicted", "tp",
        *[rounded(c).alias(c) for c in ("precision", "recall", "f1_score")],
    )


def classification_metrics(df: DataFrame, label="label", prediction="prediction", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, one row per group."""
    return metrics_from_cells(confusion_matrix(df, label, prediction, by), by)


def metrics_from_cells(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The metrics of already counted (group, label, prediction, n) cells."""
    classes = _with_scores(_per_class(cells, by))
    support = F.col("support").cast("double")
    total = F.sum(support)
    return classes.groupBy(*by).agg(
        F.sum("support").alias("n"),
        (F.sum("tp") / total).alias("accuracy"),
        *[(F.sum(support * F.col(c)) / total).alias(c) for c in ("precision", "recall", "f1_score")],
        F.count_if(F.col("support") > 0).alias("num_classes"),
    )


def accuracy(df: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """Share of labelled rows predicted right; a missing prediction counts as wrong."""
    hit = F.coalesce((F.col(label) == F.col(prediction)).cast("int"), F.lit(0))
    return df.filter(F.col(label).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy")
    )


def target_band(results: DataFrame, goal: float = 0.85, close: float = 0.75) -> DataFrame:
    """Mean accuracy over tasks and whether it meets the goal, is close, or is below."""
    mean = F.avg("accuracy")
    return results.agg(mean.alias("mean_accuracy")).withColumn(
        "band",
        F.when(F.col("mean_accuracy") >= goal, "achieved")
        .when(F.col("mean_accuracy") >= close, "close")
        .otherwise("below"),
    )


def sample_counts(df: DataFrame, targets: Sequence[str], is_train: str = "is_train") -> DataFrame:
    """Train, test and total rows and the number of distinct classes per target."""
    train = F.col(is_train)
    return df.agg(
        F.count_if(train).alias("train_samples"),
        F.count_if(~train).alias("test_samples"),
        F.count(F.lit(1)).alias("total_samples"),
        *[F.count_distinct(t).alias(f"{t}_classes") for t in targets],
    )


def silhouette(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean simplified silhouette under squared Euclidean distance.

    A point's mean squared distance to a cluster follows from the cluster's size, coordinate
    sums and sum of squared norms, so two linear passes replace all pairwise distances. The
    per-cluster statistics are one row per cluster and travel as a single scalar value.
    """
    dims = list(features)
    norm = sum((F.col(c) * F.col(c) for c in dims), F.lit(0.0))
    data = df.select(F.col(cluster).alias("cluster"), *dims).dropna()
    stats = data.groupBy("cluster").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.array(*[F.sum(c) for c in dims]).alias("sums"),
        F.sum(norm).alias("norms"),
    )
    packed = stats.agg(F.collect_list(F.struct("cluster", "n", "sums", "norms")).alias("s"))
    point = F.array(*[F.col(c) for c in dims])

    def distance(entry):
        dot = F.aggregate(
            F.zip_with(point, entry["sums"], lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v
        )
        return norm + (entry["norms"] - F.lit(2.0) * dot) / entry["n"]

    own = F.filter("d", lambda e: e["cluster"] == F.col("cluster"))[0]
    others = F.array_min(
        F.transform(F.filter("d", lambda e: e["cluster"] != F.col("cluster")), lambda e: e["dist"])
    )
    scored = (
        data.withColumn("stats", packed.scalar())
        .withColumn(
            "d",
            F.transform(
                "stats",
                lambda e: F.struct(
                    e["cluster"].alias("cluster"), e["n"].alias("n"), distance(e).alias("dist")
                ),
            ),
        )
        .select(own.alias("own"), others.alias("b"))
    )
    n = F.col("own.n")
    a = F.when(n > 1, F.col("own.dist") * n / (n - 1)).otherwise(F.lit(0.0))
    value = F.when(n == 1, F.lit(0.0)).otherwise(
        F.when(F.greatest(a, F.col("b")) == 0, F.lit(0.0)).otherwise(
            (F.col("b") - a) / F.greatest(a, F.col("b"))
        )
    )
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("silhouette"))
