"""Model presets and training.

One generic ``train`` serves every task and algorithm. A fitted model is a single
``PipelineModel`` holding the encoders, the scaler, the classifier and the class decoder, so it
can be saved, loaded and applied to a batch or a stream as one unit.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from statistics import mean, pstdev

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from medlattice import schema as S
from medlattice.functions.hashing import key_hash
from medlattice.functions.scalar import literal_array
from medlattice.operators import boosting, encode, forest, machines, perceptron, softmax
from medlattice.operators.evaluate import classification_metrics
from medlattice.operators.kernel import RandomFourierFeatures, scale_gamma
from medlattice.operators.split import stratified_folds

ALGORITHMS = ("LogisticRegression", "SVM", "XGBoost", "LightGBM", "NeuralNetwork", "RandomForest")

# The study's parameters per task.
STUDY = {
    "LogisticRegression": {"disease": {"maxIter": 1000}, "diet": {"maxIter": 1000}, "lifestyle": {"maxIter": 1000}},
    "SVM": {"disease": {"maxIter": 100}, "diet": {"maxIter": 100}, "lifestyle": {"maxIter": 100}},
    "XGBoost": {
        "disease": {"rounds": 100, "depth": 10, "rate": 0.1},
        "diet": {"rounds": 150, "depth": 12, "rate": 0.1},
        "lifestyle": {"rounds": 150, "depth": 10, "rate": 0.1},
    },
    "LightGBM": {
        "disease": {"rounds": 100, "depth": 10, "rate": 0.1},
        "diet": {"rounds": 150, "depth": 12, "rate": 0.1},
        "lifestyle": {"rounds": 150, "depth": 12, "rate": 0.1},
    },
    "NeuralNetwork": {
        "disease": {"hidden": (128, 64, 32), "epochs": 500},
        "diet": {"hidden": (256, 128, 64), "epochs": 300},
        "lifestyle": {"hidden": (256, 128, 64), "epochs": 300},
    },
    "RandomForest": {
        "disease": {"numTrees": 120, "maxDepth": 15},
        "diet": {"numTrees": 200, "maxDepth": 20},
        "lifestyle": {"numTrees": 200, "maxDepth": 18},
    },
}

# What the two boosting presets grow by where the study names no value.
DEPTH_WISE = {"penalty": 1.0, "least_hessian": 1.0, "least_rows": 1, "hessian": 2.0}
LEAF_WISE = {"leaves": 31, "penalty": 0.0, "least_hessian": 1e-3, "least_rows": 20, "prior": True}

# The production forests.
PRODUCTION_FOREST = {
    "disease": {"numTrees": 120, "maxDepth": 15},
    "diet": {"numTrees": 120, "maxDepth": 12},
    "lifestyle": {"numTrees": 120, "maxDepth": 12},
}
PRODUCTION_FOREST_COMMON = {
    "minInstancesPerNode": 5, "maxBins": 64, "subsamplingRate": 0.8, "featureSubsetStrategy": "sqrt",
}
SURROGATE_FOREST = {"numTrees": 150, "maxDepth": 15}

#: rows of a partition that iterative fits read again and again
SPREAD_ROWS = 100_000

#: share of the training rows that early stopping holds out
HELD_OUT = 0.1

#: quick settings for tests: the same estimators, fewer iterations; no registered query uses them
QUICK = {
    "LogisticRegression": {"maxIter": 20},
    "SVM": {"maxIter": 5, "components": 48},
    "XGBoost": {"rounds": 6, "depth": 4, "rate": 0.3},
    "LightGBM": {"rounds": 6, "depth": 8, "rate": 0.3, "leaves": 12},
    "NeuralNetwork": {"hidden": (16,), "epochs": 20, "rate": 0.01},
    "RandomForest": {"numTrees": 20, "maxDepth": 5},
}

def study_params(task: str, algorithm: str) -> dict:
    return dict(STUDY[algorithm][task])


def quick_params(task: str, algorithm: str) -> dict:
    return dict(QUICK[algorithm])


@dataclass(frozen=True)
class Trained:
    """A fitted pipeline with the class names of its predictions and its training time."""

    task: str
    algorithm: str
    model: PipelineModel
    classes: tuple[str, ...]
    seconds: float
    cv_mean: float | None = None
    cv_std: float | None = None

    def predict(self, df: DataFrame) -> DataFrame:
        """Append ``prediction``, ``predicted_class`` and a ``probability`` array."""
        return with_probability(self.model.transform(df))


def logistic(classes: int, rows: int, **params) -> softmax.SoftmaxRegression:
    """Multinomial logistic regression with unit inverse regularisation on ``rows`` rows."""
    return softmax.SoftmaxRegression(classes, softmax.Fitting(penalty=1.0 / max(rows, 1), **params))


def growth(algorithm: str, classes: int, **params) -> boosting.Growth:
    """How the trees of a boosting preset grow: level by level, or the leaf of the largest gain next."""
    preset = DEPTH_WISE if algorithm == "XGBoost" else {**LEAF_WISE, "hessian": classes / (classes - 1)}
    return boosting.Growth(**{**preset, **params})


def boosted(algorithm: str, classes: int, **params) -> boosting.SoftmaxBooster:
    """Boosted trees on the softmax loss, one tree per class and round."""
    return boosting.SoftmaxBooster(classes, growth(algorithm, classes, **params))


def kernel_machine(classes: int, gamma: float, rows: int, components: int = 256, **params) -> list:
    """RBF kernel classifier: random Fourier features and one linear machine per class (C = 1)."""
    return [
        RandomFourierFeatures(components=components, gamma=gamma, seed=42),
        machines.LinearMachines(classes, machines.Fitting(penalty=1.0 / max(rows, 1), **params), "kernel_features"),
    ]


def feature_stages(task: str, train: DataFrame, kind: str | None = None) -> list:
    """The feature set of a task: coded for disease, one-hot for the plans, unless named."""
    kind = kind or ("coded" if task == "disease" else "one_hot")
    builders: dict[str, Callable] = {
        "production": lambda: encode.production_features(),
        "coded": lambda: encode.coded_features(train),
        "one_hot": lambda: encode.one_hot_features(train),
        "ordinal": lambda: encode.ordinal_features(train),
    }
    return builders[kind]()


def _classifier(algorithm: str, encoded: DataFrame, classes: int, params: dict, key: str) -> list:
    params = dict(params)
    if algorithm == "RandomForest":
        return [forest.BaggedForest(classes, forest.Growth(**params), key)]
    if algorithm == "LogisticRegression":
        return [logistic(classes, encoded.count(), **params)]
    if algorithm in ("XGBoost", "LightGBM"):
        return [boosted(algorithm, classes, **params)]
    if algorithm == "NeuralNetwork":
        return [perceptron.MiniBatchPerceptron(classes, perceptron.Training(**params), key, HELD_OUT)]
    if algorithm == "SVM":
        return kernel_machine(classes, scale_gamma(encoded), encoded.count(), **params)
    raise ValueError(f"unknown algorithm {algorithm}")


def spread(rows: DataFrame, key: str = "patient_id", partitions: int | None = None) -> DataFrame:
    """Rows dealt by their key, a partition for each core and for each ``SPREAD_ROWS`` rows unless stated, at most as
    many as the session shuffles to.

    A fit reads its cached rows many times: a table of few files would keep few cores busy each time, and hundreds of
    small partitions cost more to start than their rows to read.
    """
    if key not in rows.columns:
        return rows
    if partitions is None:
        spark = rows.sparkSession
        wanted = max(spark.sparkContext.defaultParallelism, -(-rows.count() // SPREAD_ROWS))
        partitions = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted))
    return rows.repartition(partitions, key)


def encode_training(
    train: DataFrame, task: str, kind: str | None = None, keep: Sequence[str] = (), key: str = "patient_id"
) -> tuple[PipelineModel, DataFrame]:
    """Fitted feature stages and the encoded training table (label, features, kept columns)."""
    target = S.TARGETS[task]
    rows = train.filter(F.col(target).isNotNull())
    features = encode.fit_features(feature_stages(task, rows, kind), rows)
    labelled = encode.label_indexer(target, S.CLASSES[task]).transform(features.transform(spread(rows, key)))
    return features, labelled.select("label", "features", *[c for c in dict.fromkeys([key, *keep]) if c in labelled.columns])


def train(
    df: DataFrame, task: str, algorithm: str, params: dict | None = None, kind: str | None = None,
    folds: int = 0, key: str = "patient_id",
) -> Trained:
    """Fit one algorithm on one task. ``folds`` > 1 adds stratified cross-validation.

    The encoded rows are cached for the iterative fit only; losing a cached block means
    re-reading its input, nothing else.
    """
    started = time.perf_counter()
    features, encoded = encode_training(df, task, kind, key=key)
    encoded = encoded.persist()
    try:
        fitted = fit_encoded(features, encoded, task, algorithm, params, started, key)
    finally:
        encoded.unpersist()
    if folds < 2:
        return fitted
    scores = cross_validate(df, task, algorithm, params, kind, folds, key)
    return replace(fitted, seconds=time.perf_counter() - started, cv_mean=mean(scores), cv_std=pstdev(scores))


def cross_validate(
    df: DataFrame, task: str, algorithm: str, params: dict | None = None, kind: str | None = None, folds: int = 3,
    key: str = "patient_id",
) -> list[float]:
    """Accuracy on each stratified fold of a model, encoders and scaler included, that never saw it."""
    target = S.TARGETS[task]
    dealt = stratified_folds(df.filter(F.col(target).isNotNull()), target, folds, key)
    scores = []
    for fold in range(folds):
        fitted = train(dealt.filter(F.col("fold") != fold).drop("fold"), task, algorithm, params, kind, key=key)
        held_out = fitted.model.transform(dealt.filter(F.col("fold") == fold).drop("fold"))
        right = F.avg((F.col("predicted_class") == F.col(target)).cast("double"))
        scores.append(held_out.agg(right).first()[0])
    return scores


def fit_encoded(
    features: PipelineModel, encoded: DataFrame, task: str, algorithm: str, params: dict | None = None,
    started: float | None = None, key: str = "patient_id",
) -> Trained:
    """Fit one algorithm on rows that are encoded (and cached) already."""
    started = time.perf_counter() if started is None else started
    params = study_params(task, algorithm) if params is None else params
    classes = S.CLASSES[task]
    if algorithm == "SVM":
        encoded, classes = _present_classes(encoded, classes)
    fitted = Pipeline(stages=_classifier(algorithm, encoded, len(classes), params, key)).fit(encoded).stages
    model = PipelineModel(stages=[*features.stages, *fitted, encode.label_decoder(classes)])
    return Trained(task, algorithm, model, classes, time.perf_counter() - started)


def _present_classes(encoded: DataFrame, classes: tuple[str, ...]) -> tuple[DataFrame, tuple[str, ...]]:
    """Codes closed up over the classes that occur: a linear machine needs rows on both sides.

    The model then predicts, and its decoder names, the occurring classes only.
    """
    codes = sorted(r[0] for r in encoded.select("label").distinct().collect())
    if len(codes) == len(classes):
        return encoded, classes
    position = F.array_position(literal_array(codes), F.col("label")) - 1
    return encoded.withColumn("label", position.cast("double")), tuple(classes[int(c)] for c in codes)


def with_probability(scored: DataFrame) -> DataFrame:
    """``probability`` as an array. Models without one get the softmax of their margins."""
    if "probability" in scored.columns:
        return scored.withColumn("probability", vector_to_array("probability"))
    margins = vector_to_array("rawPrediction")
    top = F.array_max(margins)
    powers = F.transform(margins, lambda m: F.exp(m - top))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, v: acc + v)
    return scored.withColumn("probability", F.transform(powers, lambda v: v / total))


def evaluate(trained: Trained, test: DataFrame) -> Row:
    """Metrics of one model on labelled rows, from one pass over its predictions."""
    return _metrics(trained.model.transform(test), S.TARGETS[trained.task])


def _metrics(scored: DataFrame, target: str) -> Row:
    pairs = scored.select(F.col(target).alias("label"), F.col("predicted_class").alias("prediction"))
    return classification_metrics(pairs).first()


def result_row(trained: Trained, scored: DataFrame, target: str | None = None) -> tuple:
    """A ``model_results`` row from scored test rows."""
    m = _metrics(scored, target or S.TARGETS[trained.task])
    return (
        trained.task, trained.algorithm, m["accuracy"], m["f1_score"], m["precision"], m["recall"],
        trained.seconds, trained.cv_mean, trained.cv_std, int(m["num_classes"]),
    )


def train_grid(
    train_df: DataFrame, test_df: DataFrame, tasks: Sequence[str] = tuple(S.TARGETS),
    algorithms: Sequence[str] = ALGORITHMS, params: Callable[[str, str], dict] = study_params,
    folds: int = 0, parallelism: int = 2, key: str = "patient_id",
) -> DataFrame:
    """Every algorithm on every task as a ``model_results`` table.

    A task's rows are encoded and cached once for all of its algorithms, and its test rows are
    encoded once for all models. A few fits are submitted side by side, so one model's short
    stages fill the gaps another leaves; every fit itself runs on the cluster.
    """
    rows: list[tuple] = []
    for task in tasks:
        features, encoded = encode_training(train_df, task, key=key)
        encoded = encoded.persist()
        target = S.TARGETS[task]
        held_out = features.transform(test_df).select("features", F.col(target).alias("truth")).persist()

        def run(algorithm: str, task=task, features=features, encoded=encoded, held_out=held_out) -> tuple:
            fitted = fit_encoded(features, encoded, task, algorithm, params(task, algorithm), key=key)
            if folds > 1:
                scores = cross_validate(train_df, task, algorithm, params(task, algorithm), folds=folds, key=key)
                fitted = replace(fitted, cv_mean=mean(scores), cv_std=pstdev(scores))
            classifier = PipelineModel(stages=fitted.model.stages[len(features.stages) :])
            return result_row(fitted, classifier.transform(held_out), "truth")

        try:
            encoded.count()
            with ThreadPoolExecutor(parallelism) as pool:
                rows += pool.map(run, algorithms)
        finally:
            encoded.unpersist()
            held_out.unpersist()
    return train_df.sparkSession.createDataFrame(rows, S.MODEL_RESULTS)


def train_forest(df: DataFrame, task: str, params: dict | None = None, kind: str = "production") -> Trained:
    """The production forest of a task."""
    chosen = {**PRODUCTION_FOREST_COMMON, **PRODUCTION_FOREST[task]} if params is None else params
    return train(df, task, "RandomForest", chosen, kind)


def train_surrogate(df: DataFrame, params: dict | None = None, task: str = "disease") -> Trained:
    """The forest that explanations are made for: ordinal codes, mean fill, population scaling."""
    return train(df, task, "RandomForest", params or SURROGATE_FOREST, "ordinal")


def forest_of(model: PipelineModel):
    """The tree ensemble inside a fitted pipeline."""
    return next(stage for stage in model.stages if hasattr(stage, "featureImportances"))


def feature_importances(trained: Trained, sample: DataFrame, top: int | None = None) -> DataFrame:
    """Importance per source column (one-hot slots summed back), largest first.

    ``sample`` only supplies the schema; no row of it is read.
    """
    encoded = PipelineModel(stages=trained.model.stages[:-2]).transform(sample)
    names = encode.slot_names(encoded, "features") or encode.slot_names(encoded, "features_raw")
    values = forest_of(trained.model).featureImportances.toArray()
    totals: dict[str, float] = {}
    for name, value in zip(names, values, strict=True):
        source = name.split("_encoded")[0].removesuffix("_scaled")
        totals[source] = totals.get(source, 0.0) + float(value)
    ordered = sorted(totals.items(), key=lambda item: (-item[1], item[0]))[:top]
    rows = [(trained.task, i + 1, name, value) for i, (name, value) in enumerate(ordered)]
    return sample.sparkSession.createDataFrame(rows, "task string, rank int, feature string, importance double")


def fit_perceptron_early_stopping(
    df: DataFrame, task: str, params: dict | None = None, validation_share: float = HELD_OUT, kind: str | None = None, key: str = "patient_id",
) -> tuple[Trained, list[tuple[float, float | None]]]:
    """Perceptron that stops when a held-out share of the training rows no longer improves, with the best weights.
    Returns the model and (training loss, held-out accuracy) of each epoch."""
    started = time.perf_counter()
    features, encoded = encode_training(df, task, kind, key=key)
    how = perceptron.Training(**(study_params(task, "NeuralNetwork") if params is None else params))
    fitted, history = perceptron.fit(encoded, len(S.CLASSES[task]), how, key, validation_share)
    model = PipelineModel(stages=[*features.stages, fitted, encode.label_decoder(S.CLASSES[task])])
    return Trained(task, "NeuralNetwork", model, S.CLASSES[task], time.perf_counter() - started), history


def fit_booster_early_stopping(
    df: DataFrame, task: str, algorithm: str = "LightGBM", patience: int = 10, validation_share: float = 0.1,
    kind: str | None = None, key: str = "patient_id", **params,
) -> tuple[Trained, list[tuple[float, float | None]]]:
    """Boosted trees of all classes that stop when the loss of a held-out share of the training rows has not improved for
    ``patience`` rounds; the trees of the best round are kept. Returns the model and both losses after each round."""
    started = time.perf_counter()
    features, encoded = encode_training(df, task, kind, [key])
    encoded = encoded.withColumn("held_out", key_hash(key, 7) % 10000 < round(validation_share * 10000)).persist()
    classes = S.CLASSES[task]
    try:
        fitted, history = boosting.fit(encoded, len(classes), growth(algorithm, len(classes), **params), "held_out", patience)
    finally:
        encoded.unpersist()
    model = PipelineModel(stages=[*features.stages, fitted, encode.label_decoder(classes)])
    return Trained(task, algorithm, model, classes, time.perf_counter() - started), history


# --- clustering -----------------------------------------------------------------------------


def fit_clusters(df: DataFrame, k: int = 5, seed: int = 42, features: str = "features") -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)


def sweep_clusters(df: DataFrame, ks: Sequence[int] = range(3, 11), seed: int = 42, features: str = "features") -> DataFrame:
    """(k, silhouette) for every k; the vectors are cached once for all fits."""
    vectors = df.select(features).persist()
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol="cluster", metricName="silhouette")
    try:
        rows = [
            (k, float(evaluator.evaluate(fit_clusters(vectors, k, seed, features).transform(vectors)))) for k in ks
        ]
    finally:
        vectors.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


def choose_k(sweep: DataFrame, pick: str = "fixed", fixed: int = 5) -> int:
    """The fixed k, or the k with the best silhouette (the smaller one on a tie)."""
    if pick == "fixed":
        return fixed
    return sweep.orderBy(F.col("silhouette").desc(), "k").first()["k"]


def nearest_centroid(df: DataFrame, columns: Sequence[str], centroids: Sequence[Sequence[float]]) -> DataFrame:
    """Append ``cluster`` and ``distance_sq`` for given centroids; ties go to the smaller id."""
    entries = [
        F.struct(
            sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(columns, point, strict=True)), F.lit(0.0)).alias("d"),
            F.lit(i).alias("cluster"),
        )
        for i, point in enumerate(centroids)
    ]
    best = F.array_min(F.array(*entries))
    return df.withColumn("_best", best).withColumns(
        {"cluster": F.col("_best.cluster"), "distance_sq": F.col("_best.d")}
    ).drop("_best")
