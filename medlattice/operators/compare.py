"""Comparing algorithms over tasks.

Inputs are ``model_results`` tables: one row per (task, algorithm), so at most a few hundred
rows, whatever the size of the scored data they summarise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medlattice.operators.evaluate import metrics_from_cells
from medlattice.schema import TARGETS

METRICS = ("accuracy", "f1_score", "precision", "recall")
TASKS = tuple(TARGETS)


def results_from_predictions(scored: DataFrame) -> DataFrame:
    """``model_results`` of a scored table (task, algorithm, label, prediction, cost_ms).

    Costs are summed in the same cells as the confusion matrix, so the scored rows are read
    and shuffled once for all tasks and algorithms.
    """
    keys = ["task", "algorithm"]
    cells = scored.groupBy(*keys, "label", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cost_ms").alias("cost_ms")
    )
    metrics = metrics_from_cells(cells.drop("cost_ms"), keys)
    cost = cells.groupBy(*keys).agg(F.sum("cost_ms").alias("cost_ms"))
    return metrics.join(cost, keys).select(
        *keys, *METRICS, (F.col("cost_ms") / F.lit(1000.0)).alias("training_time_seconds"),
        F.col("num_classes").cast("int").alias("num_classes"),
    )


def stack_results(parts: Sequence[DataFrame]) -> DataFrame:
    """One long table from per-task tables; columns a part lacks become null."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first


def task_frame(df: DataFrame, tasks: Sequence[str] = TASKS) -> DataFrame:
    return df.sparkSession.createDataFrame([(t,) for t in tasks], "task string")


def all_tasks(results: DataFrame, tasks: Sequence[str]) -> DataFrame:
    """The listed tasks and every other one that has results (one row per model: small)."""
    return task_frame(results, tasks).unionByName(results.select("task")).where("task IS NOT NULL").distinct()


def require_listed(results: DataFrame, tasks: Sequence[str]) -> None:
    """A matrix has a column per listed task, so results of another one are an error, not a loss."""
    strange = results.where(~F.col("task").isin(list(tasks))).select("task").limit(1).collect()
    if strange:
        raise ValueError(f"results of a task that is not listed: {strange[0]['task']}")


def default_zero(results: DataFrame, tasks: Sequence[str] = TASKS) -> DataFrame:
    """One row per task; metrics are 0 for a task without results."""
    return all_tasks(results, tasks).join(results, "task", "left").select(
        "task", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in METRICS]
    )


def rank_models(results: DataFrame) -> DataFrame:
    """1-based rank by accuracy inside each task, ties by algorithm name."""
    order = Window.partitionBy("task").orderBy(F.col("accuracy").desc(), F.col("algorithm"))
    return results.withColumn("rank", F.row_number().over(order).cast("bigint"))


def best_models(results: DataFrame, tasks: Sequence[str] = TASKS) -> DataFrame:
    """Best algorithm per task; ``N/A`` and zeros for a task without results."""
    fields = ["accuracy", "f1_score", "training_time_seconds"]
    best = results.groupBy("task").agg(
        F.min(F.struct((-F.col("accuracy")).alias("neg"), "algorithm", *fields)).alias("best")
    )
    return all_tasks(results, tasks).join(best, "task", "left").select(
        "task",
        F.coalesce("best.algorithm", F.lit("N/A")).alias("algorithm"),
        *[F.coalesce(f"best.{c}", F.lit(0.0)).alias(c) for c in fields],
    )


def algorithms(results: DataFrame) -> DataFrame:
    return results.select("algorithm").distinct().orderBy("algorithm")


def metric_matrix(results: DataFrame, metric: str = "accuracy", tasks: Sequence[str] = TASKS) -> DataFrame:
    """Algorithm by task matrix of one metric, 0 where an algorithm was not run."""
    require_listed(results, tasks)
    return (
        results.groupBy("algorithm").pivot("task", list(tasks)).agg(F.first(metric)).na.fill(0.0).orderBy("algorithm")
    )


def metric_grid(results: DataFrame, tasks: Sequence[str] = TASKS) -> DataFrame:
    """(metric, algorithm, task, value) with 0 for combinations that were not run.

    The pivoted matrix already holds every (algorithm, task) cell, so it is unpivoted instead
    of building all combinations.
    """
    require_listed(results, tasks)
    wide = results.groupBy("algorithm").pivot("task", list(tasks)).agg(
        *[F.first(m).alias(m) for m in METRICS]
    )
    cells = [
        F.struct(
            F.lit(m).alias("metric"), F.lit(t).alias("task"), F.coalesce(f"{t}_{m}", F.lit(0.0)).alias("value")
        )
        for t in tasks for m in METRICS
    ]
    return wide.select("algorithm", F.explode(F.array(*cells)).alias("c")).select("c.metric", "algorithm", "c.task", "c.value")


def efficiency(results: DataFrame) -> DataFrame:
    """Training time against accuracy with the task's mean accuracy."""
    return results.select(
        "task", "algorithm", "training_time_seconds", "accuracy",
        F.avg("accuracy").over(Window.partitionBy("task")).alias("task_mean_accuracy"),
    )


def summary_table(results: DataFrame) -> DataFrame:
    """Rows in rank order per task; the task name shows on its best row only."""
    ranked = rank_models(results)
    best = F.col("rank") == 1
    return ranked.select(
        "task", "rank", F.when(best, F.initcap("task")).alias("task_label"), best.alias("is_best"), "algorithm",
        *METRICS, "training_time_seconds",
    ).orderBy("task", "rank")

