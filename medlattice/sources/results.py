"""Metrics documents: writing and reading the JSON shapes that training runs leave behind.

* flat: ``{algorithm: {accuracy, precision, recall, f1, training_time}}``, one file per task
* nested: ``{task: {num_classes, models: {algorithm: {...}}}, metadata: {...}}``
* production: ``{task: {accuracy, f1, precision, recall}, train_samples, ...}``

A document holds one entry per algorithm, so building one gathers a few rows only.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medlattice.operators.compare import METRICS
from medlattice.schema import MODEL_RESULTS, RUN_METADATA, TARGETS

_MANIFEST = "version long, folder string"
_FLAT = "map<string,struct<accuracy:double,precision:double,recall:double,f1:double,training_time:double>>"
_NESTED_MODEL = (
    "struct<accuracy:double,precision:double,recall:double,f1_score:double,cv_accuracy_mean:double,"
    "cv_accuracy_std:double,training_time_seconds:double,num_classes:int>"
)
_NESTED = "struct<" + ",".join(
    f"{t}:struct<num_classes:int,models:map<string,{_NESTED_MODEL}>>" for t in TARGETS
) + ",metadata:struct<train_samples:bigint,test_samples:bigint,total_samples:bigint,features:int,timestamp:string>>"
_PRODUCTION = "struct<" + ",".join(
    f"{t}:struct<accuracy:double,f1:double,precision:double,recall:double>" for t in TARGETS
) + ",train_samples:bigint,test_samples:bigint,total_samples:bigint,algorithm:string>"


def write_results(results: DataFrame, path: str) -> None:
    """The long table as JSON lines."""
    results.write.mode("overwrite").json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_RESULTS).json(path)


def _models(entry: Column) -> Column:
    return F.map_from_entries(F.collect_list(F.struct(F.col("algorithm"), entry)))


def flat_document(results: DataFrame, task: str) -> DataFrame:
    """One-row ``value`` text column: the flat document of a task."""
    entry = F.struct(
        "accuracy", "precision", "recall", F.col("f1_score").alias("f1"),
        F.col("training_time_seconds").alias("training_time"),
    )
    return results.filter(F.col("task") == task).agg(F.to_json(_models(entry)).alias("value"))


def nested_document(results: DataFrame, tasks=tuple(TARGETS), metadata: DataFrame | None = None) -> DataFrame:
    """One-row ``value`` text column: the nested document of the given tasks, with the run's metadata if given."""
    fields = [c for c in MODEL_RESULTS.names if c in results.columns and c not in ("task", "algorithm")]
    per_task = results.filter(F.col("task").isin(*tasks)).groupBy("task").agg(
        F.struct(F.max("num_classes").alias("num_classes"), _models(F.struct(*fields)).alias("models")).alias("body")
    )
    kept = [F.first(F.when(F.col("task") == t, F.col("body")), ignorenulls=True).alias(t) for t in tasks]
    if metadata is not None:
        row = metadata.first()
        kept.append(F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in RUN_METADATA if f.name in metadata.columns]).alias("metadata"))
    return per_task.agg(F.to_json(F.struct(*kept)).alias("value"))


def run_metadata(train: DataFrame, test: DataFrame, features: int, algorithm: str | None = None, timestamp: str | None = None) -> DataFrame:
    """One ``RUN_METADATA`` row of a training run."""
    counts = train.select(F.lit(1).alias("train"), F.lit(0).alias("test")).unionByName(test.select(F.lit(0).alias("train"), F.lit(1).alias("test")))
    n = counts.agg(F.coalesce(F.sum("train"), F.lit(0)), F.coalesce(F.sum("test"), F.lit(0))).first()
    when = timestamp or time.strftime("%Y-%m-%d %H:%M:%S")
    return train.sparkSession.createDataFrame([(n[0], n[1], n[0] + n[1], features, algorithm, when)], RUN_METADATA)


def write_run(document: DataFrame, metadata: DataFrame, root: str) -> int:
    """Document and metadata as the next version under ``root``; returns its number.

    Each run writes to a folder of its own and its manifest last, so a run that stops half way is never read.
    """
    spark = document.sparkSession
    known = _manifests(spark, root)
    version = 1 + max((r["version"] for r in known), default=0)
    folder = f"run-{version:06d}-{uuid.uuid4().hex}"
    write_document(document, f"{root}/{folder}/document")
    metadata.coalesce(1).write.json(f"{root}/{folder}/metadata")
    spark.createDataFrame([(version, folder)], _MANIFEST).coalesce(1).write.json(f"{root}/{folder}/manifest")
    return version


def _manifests(spark: SparkSession, root: str) -> list:
    pattern = f"{root}/*/manifest"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    done = [str(s.getPath()) for s in found or () if _complete(spark, f"{s.getPath()}/_SUCCESS")]
    return spark.read.schema(_MANIFEST).json(done).collect() if done else []


def _complete(spark: SparkSession, mark: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(mark)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def last_run(spark: SparkSession, root: str) -> tuple[str, DataFrame]:
    """(path of the document, metadata row) of the last complete run under ``root``."""
    known = _manifests(spark, root)
    if not known:
        raise FileNotFoundError(f"no complete run under {root}")
    # two runs that took the same number are told apart by their folders, alike for every reader
    last = max(known, key=lambda r: (r["version"], r["folder"]))
    return f"{root}/{last['folder']}/document", spark.read.schema(RUN_METADATA).json(f"{root}/{last['folder']}/metadata")


def write_document(document: DataFrame, path: str) -> None:
    document.coalesce(1).write.mode("overwrite").text(path)


def _texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def read_flat(spark: SparkSession, path: str, task: str) -> DataFrame:
    """Flat documents as ``model_results`` rows of one task."""
    parsed = _texts(spark, path).select(F.explode(F.from_json("value", _FLAT)).alias("algorithm", "m"))
    return parsed.select(
        F.lit(task).alias("task"), "algorithm", "m.accuracy", F.col("m.f1").alias("f1_score"), "m.precision",
        "m.recall", F.col("m.training_time").alias("training_time_seconds"),
    )


def read_nested(spark: SparkSession, path: str, tasks=tuple(TARGETS)) -> DataFrame:
    """Nested documents as ``model_results`` rows; tasks without models yield no rows."""
    parsed = _texts(spark, path).select(F.from_json("value", _NESTED).alias("d"))
    pairs = F.array(*[F.struct(F.lit(t).alias("task"), F.col(f"d.{t}.models").alias("models")) for t in tasks])
    return (
        parsed.select(F.explode(pairs).alias("p"))
        .select("p.task", F.explode("p.models").alias("algorithm", "m"))
        .select("task", "algorithm", *[f"m.{c}" for c in MODEL_RESULTS.names if c not in ("task", "algorithm")])
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Run metadata of nested documents."""
    return _texts(spark, path).select(F.from_json("value", _NESTED).alias("d")).select("d.metadata.*")


def production_document(results: DataFrame, metadata: DataFrame | None = None, algorithm: str = "RandomForest") -> DataFrame:
    """One-row ``value`` text column: metrics of one algorithm per task."""
    chosen = results.filter(F.col("algorithm") == algorithm)
    body = F.struct("accuracy", F.col("f1_score").alias("f1"), "precision", "recall")
    one = chosen.agg(*[F.max(F.when(F.col("task") == t, body)).alias(t) for t in TARGETS])
    extra = [F.lit(algorithm).alias("algorithm")]
    if metadata is not None:
        row = metadata.first()
        extra += [F.lit(row[c]).alias(c) for c in ("train_samples", "test_samples", "total_samples")]
    return one.select(F.to_json(F.struct(*TARGETS, *extra)).alias("value"))


def read_production(spark: SparkSession, path: str) -> DataFrame:
    """Production documents as one row per task; zeros for a task the document lacks."""
    parsed = _texts(spark, path).select(F.from_json("value", _PRODUCTION).alias("d"))
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("task"),
                *[F.coalesce(F.col(f"d.{t}.{'f1' if m == 'f1_score' else m}"), F.lit(0.0)).alias(m) for m in METRICS],
            )
            for t in TARGETS
        ]
    )
    return parsed.select(F.explode(rows).alias("r")).select("r.*")
