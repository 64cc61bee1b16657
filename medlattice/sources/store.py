"""Saving and loading fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from medlattice.operators.models import Trained


def save_model(trained: Trained, path: str) -> None:
    """Encoders, scaler, classifier and decoder as one unit, replacing what was there."""
    trained.model.write().overwrite().save(path)


def model_exists(spark: SparkSession, path: str) -> bool:
    """Whether a pipeline is stored at the path, on any file system Spark can reach."""
    jvm = spark.sparkContext._jvm
    metadata = jvm.org.apache.hadoop.fs.Path(f"{path}/metadata")
    return metadata.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(metadata)


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    return PipelineModel.load(path) if model_exists(spark, path) else None


def load_trained(spark: SparkSession, path: str, task: str, algorithm: str) -> Trained:
    """A stored pipeline with the class names its decoder holds."""
    model = load_model(spark, path)
    if model is None:
        raise FileNotFoundError(path)
    return Trained(task, algorithm, model, tuple(model.stages[-1].getLabels()), 0.0)


def apply_saved(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """A stored pipeline applied to new rows."""
    model = load_model(spark, path)
    if model is None:
        raise FileNotFoundError(path)
    return model.transform(df)
