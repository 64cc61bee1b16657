"""The registered queries: one per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlattice import schema as S
from medlattice.functions import rules
from medlattice.functions.hashing import draw
from medlattice.functions.scalar import clip, decode, pick, rounded
from medlattice.operators import attribution, clean, compare, encode, evaluate, explain, models, profile, ranking, split
from medlattice.operators.quantiles import approximate_quantiles, exact_quantiles, values_long
from medlattice.plans import dataset
from medlattice.plans.oracles import CENTROIDS, LINEAR_COEFFICIENTS, LINEITEM_MEASURES
from medlattice.plans.profiles import PROFILES, SLOTS
from medlattice.session import read_table, scratch_path, tuned
from medlattice.sources import files, store
from medlattice.sources import results as documents
from medlattice.streaming import patient_stream as streams
from medlattice.streaming import run_log

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}
_PREVIEW = ("age", "sex", "bmi", "bp_systolic", "glucose", "cholesterol", "disease", "diet_plan", "lifestyle_plan")
_MEASURES = S.NUMERIC[:5]


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return {name: _on_tuned_session(function) for name, function in _REGISTRY.items()}


def _on_tuned_session(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, d: str) -> DataFrame:
        return function(tuned(spark), d)

    return run


def _results(spark: SparkSession, d: str) -> DataFrame:
    return compare.results_from_predictions(dataset.grid_predictions(spark, d))


def _tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the double columns of a report; times keep milliseconds."""
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: rounded(c, 3 if c == "training_time_seconds" else digits) for c in doubles})


def _slots(df: DataFrame, vector: str, names: list[str], keys: list[str], kind: str) -> DataFrame:
    """Vector slots as scalar columns."""
    arrays = df.select(*keys, vector_to_array(vector).alias("v"))
    return arrays.select(*keys, *[F.col("v")[i].cast(kind).alias(n) for i, n in enumerate(names)])


# --- sources and sinks ----------------------------------------------------------------------


@query
def csv_roundtrip(spark, d):
    path = scratch_path(spark, "patients-csv")
    files.write_patients_csv(dataset.patients(spark, d), path)
    return files.read_patients_csv(spark, path, S.PATIENT_WITH_ID)


@query
def parquet_roundtrip(spark, d):
    path = scratch_path(spark, "patients-parquet")
    files.write_patients(dataset.patients(spark, d), path)
    return files.read_patients(spark, path)


@query
def results_long(spark, d):
    table = _results(spark, d)
    root = scratch_path(spark, "metrics")
    documents.write_document(documents.nested_document(table, ["disease"]), f"{root}/disease")
    parts = [documents.read_nested(spark, f"{root}/disease", ["disease"])]
    for task in ("diet", "lifestyle"):
        documents.write_document(documents.flat_document(table, task), f"{root}/{task}")
        parts.append(documents.read_flat(spark, f"{root}/{task}", task))
    columns = ["task", "algorithm", *compare.METRICS, "training_time_seconds"]
    return _tidy(compare.stack_results(parts).select(*columns))


@query
def results_default_zero(spark, d):
    table = _results(spark, d).filter(F.col("task") != "diet")
    path = scratch_path(spark, "production-metrics")
    documents.write_document(documents.production_document(table), path)
    return _tidy(documents.read_production(spark, path))


@query
def results_document(spark, d):
    """Long results as JSON lines, written and read back."""
    path = scratch_path(spark, "results-json")
    documents.write_results(_results(spark, d), path)
    return _tidy(documents.read_results(spark, path))


@query
def model_reload(spark, d):
    """Rows whose prediction changes when the saved pipeline is loaded again (expected 0)."""
    data = _spread_patients(spark, d)
    fitted = models.train_forest(data, "diet")
    path = scratch_path(spark, "model")
    store.save_model(fitted, path)
    before = fitted.model.transform(data).select("patient_id", F.col("predicted_class").alias("before"))
    after = store.apply_saved(spark, path, data).select("patient_id", F.col("predicted_class").alias("after"))
    return before.join(after, "patient_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("changed")
    )


# --- projection and cleaning ----------------------------------------------------------------


@query
def project_patients(spark, d):
    return clean.project(dataset.patients(spark, d), _PREVIEW)


@query
def null_profile(spark, d):
    return clean.null_profile(dataset.dirty_patients(spark, d), S.REQUIRED)


@query
def drop_critical_nulls(spark, d):
    return clean.drop_critical_nulls(dataset.dirty_patients(spark, d))


@query
def impute_median(spark, d):
    dirty = dataset.dirty_patients(spark, d)
    return _tidy(clean.fit_median(dirty).transform(dirty).select("patient_id", *S.MEDIAN_FILLED))


@query
def median_at_volume(spark, d):
    found = exact_quantiles(read_table(spark, d, "lineitem"), LINEITEM_MEASURES, [0.5])
    return found.select("column", rounded("quantile").alias("median"))


@query
def impute_mean(spark, d):
    dirty = dataset.dirty_patients(spark, d)
    return _tidy(clean.fit_mean(dirty).transform(dirty).select("patient_id", *S.NUMERIC))


@query
def impute_mode(spark, d):
    dirty = dataset.dirty_patients(spark, d)
    return clean.fit_mode(dirty).transform(dirty).select("patient_id", *S.MODE_FILLED)


@query
def cast_numeric(spark, d):
    text = dataset.dirty_patients(spark, d).select(
        "patient_id", F.col("age").cast("string").alias("age"),
        F.when((F.col("patient_id") % 53 == 0) & F.col("bmi").isNotNull(), "n/a").otherwise(F.col("bmi").cast("string")).alias("bmi"),
    )
    return clean.cast_numeric(text, ["age", "bmi"]).select("patient_id", "age", "bmi", "cast_failures")


@query
def retention_report(spark, d):
    return clean.retention_report(dataset.dirty_patients(spark, d))


@query
def completeness(spark, d):
    return clean.completeness(dataset.dirty_patients(spark, d), S.REQUIRED)


@query
def seeded_shuffle(spark, d):
    return split.seeded_shuffle(dataset.patients(spark, d).select("patient_id", "disease"))


@query
def sample_n(spark, d):
    return clean.sample_rows(dataset.patients(spark, d).select("patient_id", "age", "disease"), 1000)


@query
def preview_n(spark, d):
    return clean.preview(dataset.patients(spark, d).select("patient_id", *_PREVIEW), 100)


@query
def clip_bounds(spark, d):
    return dataset.dirty_patients(spark, d).select(
        "patient_id", clip("bmi", 18.5, 35.0).alias("bmi"), clip("alcohol_units", 1.0, 10.0).alias("alcohol_units")
    )


@query
def round_values(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 0.7310585, 1).alias("price_1dp"))


@query
def domain_check(spark, d):
    checked = clean.domain_check(dataset.dirty_patients(spark, d))
    return checked.select("patient_id", F.array_join("failed_rules", ",").alias("failed_rules"), "verdict")


@query
def clean_chain(spark, d):
    """The whole cleaning chain over the dirty table."""
    return clean.clean_patients(dataset.dirty_patients(spark, d))[0]


# --- clinical rules -------------------------------------------------------------------------


@query
def metabolic_risk(spark, d):
    return dataset.patients(spark, d).select("patient_id", rules.metabolic_risk().alias("metabolic_risk"))


@query
def cardio_risk(spark, d):
    return dataset.patients(spark, d).select("patient_id", rules.cardio_risk().alias("cardio_risk"))


@query
def lifestyle_burden(spark, d):
    return dataset.patients(spark, d).select("patient_id", rules.lifestyle_burden().alias("lifestyle_burden"))


@query
def diet_plan(spark, d):
    data = rules.with_scores(dataset.patients(spark, d))
    plan = rules.diet_plan(F.col("metabolic_risk"), F.col("cardio_risk"))
    return data.select("patient_id", plan.alias("diet_plan"))


@query
def lifestyle_plan(spark, d):
    data = rules.with_scores(dataset.patients(spark, d))
    plan = rules.lifestyle_plan(F.col("metabolic_risk"), F.col("lifestyle_burden"))
    return data.select("patient_id", plan.alias("lifestyle_plan"))


def _index(spark: SparkSession, d: str) -> DataFrame:
    risks = dataset.probabilities(spark, d).select(
        "patient_id", (F.lit(1.0) - F.get("probability", F.lit(0))).alias("disease"),
        rules.score_as_risk("metabolic_risk").alias("diet"), rules.score_as_risk("lifestyle_burden").alias("lifestyle"),
    )
    return risks.select("patient_id", rules.health_risk_index("disease", "diet", "lifestyle").alias("hri"))


@query
def health_risk_index(spark, d):
    return _index(spark, d).select("patient_id", rounded("hri", 10).alias("health_risk_index"))


@query
def risk_band(spark, d):
    return _index(spark, d).select(
        "patient_id", rules.risk_band("hri").alias("risk_band"), rounded(rules.risk_percent("hri"), 8).alias("risk_percent"),
        rules.risk_alert("hri").alias("alert"),
    )


@query
def ordinal_encode(spark, d):
    return rules.with_ordinals(dataset.dirty_patients(spark, d)).select("patient_id", *[c for c, _ in S.ORDINAL.values()])


@query
def decode_labels(spark, d):
    data = dataset.patients(spark, d)
    labels = encode.alphabetical_indexer(["disease"]).fit(data).labelsArray[0]
    return data.select("patient_id", decode(labels, F.col("patient_id") % 13).alias("class_name"))


# --- encoding -------------------------------------------------------------------------------


@query
def string_index(spark, d):
    dirty = dataset.dirty_patients(spark, d)
    fitted = encode.frequency_indexer(S.CATEGORICAL).fit(dirty)
    return fitted.transform(dirty).select("patient_id", *[f"{c}_index" for c in S.CATEGORICAL])


@query
def label_encode_alpha(spark, d):
    columns = [*S.CATEGORICAL, *S.TARGETS.values()]
    data = dataset.patients(spark, d)
    return encode.alphabetical_indexer(columns).fit(data).transform(data).select("patient_id", *[f"{c}_code" for c in columns])


def _one_hot(train: DataFrame, df: DataFrame, drop_last: bool) -> DataFrame:
    fitted = encode.fit_features(
        [encode.frequency_indexer(S.CATEGORICAL), encode.one_hot(S.CATEGORICAL, drop_last),
         encode.assembler([f"{c}_encoded" for c in S.CATEGORICAL], "slots")], train,
    )
    encoded = fitted.transform(df)
    names = [n.replace("_encoded_", "_") for n in encode.slot_names(encoded, "slots")]
    out = _slots(encoded, "slots", names, ["patient_id"], "int")
    levels = [f"{c}_{level}" for c in S.CATEGORICAL for level in sorted(S.LEVELS[c])]
    return out.select("patient_id", *levels)


@query
def one_hot(spark, d):
    data = dataset.patients(spark, d)
    return _one_hot(data, data, drop_last=False)


@query
def one_hot_ignore_unknown(spark, d):
    """Fitted on clean rows, applied to rows with unseen and missing levels."""
    return _one_hot(dataset.patients(spark, d), dataset.dirty_patients(spark, d), drop_last=True)


@query
def assemble_skip(spark, d):
    names = list(S.NUMERIC)
    assembled = encode.assembler(names, "v").transform(dataset.dirty_patients(spark, d))
    return _slots(assembled, "v", names, ["patient_id"], "double")


@query
def standard_scale(spark, d):
    data = dataset.patients(spark, d)
    fitted = encode.fit_features([encode.assembler(S.NUMERIC), encode.scaler()], data)
    return _tidy(_slots(fitted.transform(data), "features", [f"{c}_scaled" for c in S.NUMERIC], ["patient_id"], "double"))


@query
def scaler_reload(spark, d):
    """A scaler that was fitted, saved and loaded, applied to the rows."""
    data = dataset.patients(spark, d)
    path = scratch_path(spark, "scaler")
    encode.fit_features([encode.assembler(S.NUMERIC), encode.scaler()], data).write().save(path)
    scaled = store.apply_saved(spark, path, data)
    return _tidy(_slots(scaled, "features", [f"{c}_scaled" for c in S.NUMERIC], ["patient_id"], "double"))


@query
def standard_scale_pop(spark, d):
    data = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LINEITEM_MEASURES)
    scaled = encode.fit_population_scaler(data, LINEITEM_MEASURES).transform(data)
    return scaled.select("l_orderkey", "l_linenumber", *[rounded(f"{c}_scaled").alias(f"{c}_scaled") for c in LINEITEM_MEASURES])


@query
def fit_on_train_only(spark, d):
    """Mean and deviation of every scaled numeric on the rows the scaler was fitted on."""
    train = split.hash_split(dataset.patients(spark, d)).filter("is_train")
    scaled = encode.fit_population_scaler(train, S.NUMERIC).transform(train)
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("sd")) for c in S.NUMERIC]
    one = scaled.agg(*[F.avg(f"{c}_scaled").alias(f"m_{c}") for c in S.NUMERIC],
                     *[F.stddev_pop(f"{c}_scaled").alias(f"s_{c}") for c in S.NUMERIC])
    return _tidy(one.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))


# --- splits ---------------------------------------------------------------------------------


@query
def hash_split(spark, d):
    return split.hash_split(dataset.patients(spark, d).select("patient_id"))


@query
def stratified_split(spark, d):
    return split.stratified_split(dataset.patients(spark, d).select("patient_id", "disease"), "disease")


@query
def kfold_assign(spark, d):
    return split.stratified_folds(dataset.patients(spark, d).select("patient_id", "disease"), "disease")


# --- models: settings of study and production, whole tables ---------------------------------------------------


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    data = split.hash_split(dataset.patients(spark, d))
    return data.filter("is_train").drop("is_train"), data.filter("not is_train").drop("is_train")


def _report(spark: SparkSession, fitted: models.Trained, test: DataFrame) -> DataFrame:
    return spark.createDataFrame([models.result_row(fitted, fitted.model.transform(models.spread(test)))], S.MODEL_RESULTS)


def _forest_query(task: str) -> Query:
    def run(spark, d):
        train, test = _split(spark, d)
        return _report(spark, models.train_forest(train, task), test)

    return run


def _study_query(algorithm: str, task: str) -> Query:
    def run(spark, d):
        train, test = _split(spark, d)
        return _report(spark, models.train(train, task, algorithm), test)

    return run


for _task in S.TARGETS:
    _REGISTRY[f"rf_{_task}"] = _forest_query(_task)
for _name, _algorithm, _task in (
    ("study_forest", "RandomForest", "lifestyle"), ("logistic_regression", "LogisticRegression", "disease"),
    ("kernel_svm", "SVM", "lifestyle"), ("boosted_depthwise", "XGBoost", "diet"), ("boosted_leafwise", "LightGBM", "lifestyle"),
    ("perceptron", "NeuralNetwork", "diet"),
):
    _REGISTRY[_name] = _study_query(_algorithm, _task)


@query
def cross_validation(spark, d):
    """Stratified three-fold accuracy next to the test metrics."""
    train, test = _split(spark, d)
    return _report(spark, models.train(train, "diet", "LogisticRegression", folds=3), test)


@query
def early_stopping(spark, d):
    """Loss and held-out accuracy of each epoch of the study's perceptron, which stops early."""
    train, _ = _split(spark, d)
    _, history = models.fit_perceptron_early_stopping(train, "lifestyle")
    rows = [(i, cost, score) for i, (cost, score) in enumerate(history, 1)]
    return spark.createDataFrame(rows, "epoch int, loss double, held_out_accuracy double")


@query
def early_stopping_boosting(spark, d):
    """Both losses over all classes after each round of leaf-wise boosting that stops early."""
    train, _ = _split(spark, d)
    _, history = models.fit_booster_early_stopping(train, "disease", **models.study_params("disease", "LightGBM"))
    rows = [(i, cost, held) for i, (cost, held) in enumerate(history, 1)]
    return spark.createDataFrame(rows, "round int, loss double, held_out_loss double")


@query
def model_grid(spark, d):
    """The study's six algorithms on its three tasks."""
    train, test = _split(spark, d)
    return models.train_grid(train, test, parallelism=3)


_FITTED: dict[tuple, object] = {}


def _surrogate(spark: SparkSession, d: str) -> models.Trained:
    """One surrogate per session and folder, shared by the explanation queries."""
    key = ("surrogate", spark.sparkContext.applicationId, d)
    if key not in _FITTED:
        data = dataset.patients(spark, d)
        _FITTED[key] = models.train_surrogate(data)
    return _FITTED[key]


@query
def surrogate_forest(spark, d):
    """The explained forest scored on its own training rows."""
    return _report(spark, _surrogate(spark, d), dataset.patients(spark, d))


@query
def batch_predict(spark, d):
    scored = _surrogate(spark, d).predict(_spread_patients(spark, d))
    return scored.select("patient_id", "disease", "predicted_class", rounded(ranking.confidence("probability", "prediction")).alias("confidence"))


@query
def class_probabilities(spark, d):
    scored = _surrogate(spark, d).predict(_spread_patients(spark, d))
    return scored.select("patient_id", *[F.get("probability", F.lit(i)).alias(f"p_{c}") for i, c in enumerate(S.DISEASES)])


@query
def feature_importances(spark, d):
    return models.feature_importances(_surrogate(spark, d), dataset.patients(spark, d), top=5)


@query
def probability_check(spark, d):
    """Per patient: one probability per class, all between 0 and 1 and adding up to 1."""
    scored = _surrogate(spark, d).predict(_spread_patients(spark, d))
    total = F.aggregate("probability", F.lit(0.0), lambda acc, v: acc + v)
    within = F.forall("probability", lambda v: (v >= 0) & (v <= 1))
    return scored.select(
        "patient_id", F.size("probability").alias("n_classes"), (F.abs(total - 1) < 1e-9).alias("adds_up"), within.alias("within")
    )


@query
def importance_check(spark, d):
    """The importances of all features of the surrogate add up to 1."""
    found = models.feature_importances(_surrogate(spark, d), dataset.patients(spark, d), top=None)
    return found.agg(rounded(F.sum("importance")).alias("total")).select(F.lit("disease").alias("task"), "total")


@query
def attribution_check(spark, d):
    """Per patient: base value and contributions add up to the probability of the predicted class."""
    values = attribution.tree_shap(_surrogate(spark, d), _spread_patients(spark, d), S.ORDINAL_FEATURES)
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, e: acc + e["value"])
    gap = F.abs(F.col("base_value") + total - F.get("probability", F.col("class")))
    return values.select("patient_id", (gap < 1e-9).alias("adds_up"))


@query
def labelled_scoring(spark, d):
    """A labelled table scored with the stored pipeline: the label is kept, and the risk index is the one
    made of the model's own probability of ``Healthy``."""
    fitted, data = _surrogate(spark, d), _spread_patients(spark, d)
    scored = streams.score_patients(data.drop("diet_plan", "lifestyle_plan"), fitted.model)
    healthy = F.get("probability", F.lit(fitted.classes.index("Healthy")))
    own = fitted.predict(data).select("patient_id", (1 - healthy).alias("risk"))
    index = rules.health_risk_index("risk", "diet_risk", "lifestyle_risk")
    return scored.join(own, "patient_id").select("patient_id", "true_disease", (F.abs(index - F.col("health_risk_index")) < 1e-9).alias("index_agrees"))


@query
def cluster_check(spark, d):
    """Every patient is in one of the five fitted clusters."""
    data = _cluster_input(spark, d)
    sizes = models.fit_clusters(data).transform(data).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("clusters"))


def _cluster_input(spark: SparkSession, d: str) -> DataFrame:
    data = dataset.patients(spark, d)
    # the seeds of k-means depend on partitions, so these follow from the rows alone, not from the cores
    partitions = -(-data.count() // models.SPREAD_ROWS)
    if partitions > 1:
        data = models.spread(data, partitions=partitions)
    return encode.fit_features(encode.production_features(), data).transform(data)


@query
def kmeans(spark, d):
    """Profile of five fitted clusters."""
    data = _cluster_input(spark, d)
    clustered = models.fit_clusters(data).transform(data)
    return profile.group_profile(clustered, "cluster", _MEASURES, "disease")


@query
def k_sweep(spark, d):
    return models.sweep_clusters(_cluster_input(spark, d))


@query
def kmeans_embeddings(spark, d):
    """Clusters of the embedding vectors against their labels."""
    data = read_table(spark, d, "embeddings").select(
        "label", array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("features")
    )
    return models.fit_clusters(data).transform(data).groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))


@query
def nearest_centroid(spark, d):
    placed = models.nearest_centroid(dataset.patients(spark, d), ("age", "bmi", "glucose"), CENTROIDS)
    return placed.select("patient_id", "cluster", rounded("distance_sq", 4).alias("distance_sq"))


@query
def confidence(spark, d):
    scored = dataset.probabilities(spark, d).withColumn("prediction", ranking.arg_max("probability"))
    return scored.select(
        "patient_id", F.col("prediction").cast("int").alias("prediction"),
        rounded(ranking.confidence("probability", "prediction")).alias("confidence"),
    )


# --- evaluation -----------------------------------------------------------------------------


@query
def confusion_matrix(spark, d):
    return evaluate.confusion_matrix(dataset.predictions(spark, d))


@query
def class_report(spark, d):
    return evaluate.class_report(dataset.predictions(spark, d))


@query
def accuracy(spark, d):
    return _tidy(evaluate.accuracy(dataset.predictions(spark, d)))


@query
def weighted_prf(spark, d):
    return _tidy(evaluate.classification_metrics(dataset.predictions(spark, d)))


@query
def binary_report(spark, d):
    labels = read_table(spark, d, "labels")
    return _tidy(evaluate.classification_metrics(labels, "quality", "toxic"))


@query
def silhouette(spark, d):
    return _tidy(evaluate.silhouette(dataset.grouped(spark, d), ("age", "bmi", "glucose")))


@query
def target_band(spark, d):
    return _tidy(evaluate.target_band(_results(spark, d).filter(F.col("algorithm") == "RandomForest")))


@query
def sample_counts(spark, d):
    return evaluate.sample_counts(split.hash_split(dataset.patients(spark, d)), list(S.TARGETS.values()))


# --- profiling ------------------------------------------------------------------------------


@query
def row_count(spark, d):
    return profile.row_count(read_table(spark, d, "lineitem"))


@query
def distinct_counts(spark, d):
    return profile.distinct_counts(dataset.patients(spark, d), [*S.CATEGORICAL, *S.TARGETS.values()])


@query
def value_counts(spark, d):
    return profile.value_counts(dataset.patients(spark, d), "disease")


@query
def value_counts_events(spark, d):
    return profile.value_counts(read_table(spark, d, "events"), "event_type")


@query
def diet_plan_share(spark, d):
    """How many patients each diet plan is recommended to, with percentages."""
    return profile.value_counts(dataset.derive_patients(spark, d), "diet_plan")


@query
def label_summary(spark, d):
    return dataset.label_summary(dataset.patients(spark, d))


@query
def group_counts(spark, d):
    return profile.group_counts(dataset.grouped(spark, d), "cluster")


@query
def group_means(spark, d):
    return profile.group_means(dataset.grouped(spark, d), "cluster", _MEASURES)


@query
def contingency(spark, d):
    return profile.contingency(dataset.grouped(spark, d), "cluster", "disease", S.DISEASES)


@query
def contingency_orders(spark, d):
    return profile.contingency(read_table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ("F", "O", "P"))


@query
def contingency_unlisted(spark, d):
    """Order states that are not listed are counted together."""
    return profile.contingency(read_table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ("F",))


@query
def box_summary(spark, d):
    return profile.box_summary(dataset.grouped(spark, d), "cluster", _MEASURES)


@query
def box_summary_orders(spark, d):
    return profile.box_summary(read_table(spark, d, "orders"), "o_orderpriority", ["o_totalprice"])


@query
def top_per_group(spark, d):
    return profile.top_per_group(dataset.grouped(spark, d), "cluster", "disease")


@query
def group_profile(spark, d):
    return profile.group_profile(dataset.grouped(spark, d), "cluster", _MEASURES, "disease")


@query
def histogram(spark, d):
    return profile.histogram(read_table(spark, d, "lineitem"), "l_extendedprice")


@query
def histogram_age(spark, d):
    return profile.histogram(dataset.patients(spark, d), "age")


@query
def corr_matrix(spark, d):
    return profile.corr_matrix(dataset.patients(spark, d), S.NUMERIC)


@query
def corr_matrix_lineitem(spark, d):
    return profile.corr_matrix(read_table(spark, d, "lineitem"), LINEITEM_MEASURES)


# --- ranking and comparison -----------------------------------------------------------------


@query
def top_classes(spark, d):
    best = dataset.probabilities(spark, d).withColumn("top", ranking.top_classes("probability", 3))
    return _tidy(ranking.explode_ranked(best, ["patient_id"], "top"))


@query
def top_contributions(spark, d):
    best = dataset.contributions(spark, d).withColumn("top", ranking.top_contributions("contributions", 5))
    return ranking.explode_ranked(best, ["patient_id"], "top")


@query
def rank_models(spark, d):
    return _tidy(compare.rank_models(_results(spark, d)).select("task", "algorithm", "accuracy", "rank"))


@query
def best_models(spark, d):
    """One task is left without results and shows the defaults."""
    return _tidy(compare.best_models(_results(spark, d).filter(F.col("task") != "lifestyle")))


def _results_with_gap(spark: SparkSession, d: str) -> DataFrame:
    return _results(spark, d).filter(~((F.col("task") == "diet") & (F.col("algorithm") == "SVM")))


@query
def accuracy_matrix(spark, d):
    return _tidy(compare.metric_matrix(_results_with_gap(spark, d), "accuracy"))


@query
def f1_matrix(spark, d):
    return _tidy(compare.metric_matrix(_results_with_gap(spark, d), "f1_score"))


@query
def algorithm_list(spark, d):
    return compare.algorithms(_results(spark, d))


@query
def metric_grid(spark, d):
    return _tidy(compare.metric_grid(_results_with_gap(spark, d)))


@query
def efficiency(spark, d):
    return _tidy(compare.efficiency(_results(spark, d)))


@query
def summary_table(spark, d):
    return _tidy(compare.summary_table(_results(spark, d)))


@query
def metric_overview(spark, d):
    chosen = _results(spark, d).filter(F.col("algorithm") == "RandomForest")
    return _tidy(compare.default_zero(chosen))


# --- explanation ----------------------------------------------------------------------------


@query
def linear_attribution(spark, d):
    parts = explain.linear_attribution(dataset.patients(spark, d), LINEAR_COEFFICIENTS)
    return _tidy(parts.select("patient_id", F.explode("contributions").alias("e")).select("patient_id", "e.*"))


@query
def global_importance(spark, d):
    return explain.global_importance(dataset.contributions(spark, d))


@query
def explanation_text(spark, d):
    return dataset.contributions(spark, d).select("patient_id", explain.explanation_text("contributions").alias("explanation"))


def _spread_patients(spark: SparkSession, d: str) -> DataFrame:
    """The patients dealt by their key: scoring by forests and attribution are bound by the processor, and the table is one file."""
    return models.spread(dataset.patients(spark, d))


@query
def tree_shap(spark, d):
    """Contributions of every patient's predicted class; ``gap`` is base + contributions - probability."""
    values = attribution.tree_shap(_surrogate(spark, d), _spread_patients(spark, d), S.ORDINAL_FEATURES)
    total = F.aggregate("contributions", F.lit(0.0), lambda acc, e: acc + e["value"])
    return values.select(
        "patient_id", "prediction", rounded("base_value").alias("base_value"), rounded("explained_value").alias("explained_value"),
        rounded(F.col("base_value") + total - F.get("probability", F.col("class"))).alias("gap"),
        *[rounded(F.col("contributions")[i]["value"]).alias(n) for i, n in enumerate(S.ORDINAL_FEATURES)],
    )


@query
def tree_shap_importance(spark, d):
    """Mean magnitude of the contributions per class and feature."""
    values = attribution.tree_shap_all_classes(_surrogate(spark, d), _spread_patients(spark, d), S.ORDINAL_FEATURES)
    named = values.withColumn("class", decode(S.DISEASES, "class"))
    return explain.long_importance(named, ["class"])


@query
def tree_shap_two_features(spark, d):
    """A two-feature tree whose row counts come from the data: has a closed form in SQL."""
    data = dataset.patients(spark, d)
    healthy = F.col("disease") == "Healthy"
    low, mid = F.col("bmi") <= 30, F.col("glucose") <= 120
    leaves = {3: low & mid, 4: low & ~mid, 2: ~low}
    row = data.agg(
        *[F.count_if(cond).cast("double").alias(f"n{i}") for i, cond in leaves.items()],
        *[F.count_if(cond & healthy).cast("double").alias(f"h{i}") for i, cond in leaves.items()],
    ).first()
    stats = {i: np.array([row[f"n{i}"] - row[f"h{i}"], row[f"h{i}"]]) for i in leaves}
    stats[1] = stats[3] + stats[4]
    stats[0] = stats[1] + stats[2]
    shape = {0: (1, 2, 0, 30.0), 1: (3, 4, 1, 120.0), 2: (-1, -1, -1, None), 3: (-1, -1, -1, None), 4: (-1, -1, -1, None)}
    nodes = pd.DataFrame(
        [(0, i, *shape[i], stats[i]) for i in sorted(shape)],
        columns=["tree", "id", "left", "right", "feature", "threshold", "stats"],
    )
    table = attribution.tree_table(nodes, features=2, trees=1)
    rows = data.select("patient_id", F.lit(1).alias("class"), F.array("bmi", "glucose").alias("vector"))
    out = attribution.add_contributions(rows, [[table]])
    return out.select(
        "patient_id", rounded(F.col("base")[0]).alias("base_value"), rounded(F.col("explained")[0]).alias("explained_value"),
        rounded(F.col("phi")[0]).alias("bmi"), rounded(F.col("phi")[1]).alias("glucose"),
    )


@query
def explanation_record(spark, d):
    record = explain.explain(_surrogate(spark, d), _spread_patients(spark, d))
    return record.select("patient_id", "prediction", rounded("confidence").alias("confidence"), rounded("base_value").alias("base_value"), "explanation")


# --- streaming ------------------------------------------------------------------------------

#: rows per CSV file of the stream fixture, so the number of files grows with the data
_STREAM_FILE_ROWS = 1000
_FILES_PER_BATCH = 64


def _stream_files(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "stream-in")
    rows = dataset.patients(spark, d).select(F.col("patient_id").cast("string").alias("patient_id"), *S.STREAM.names[1:])
    files.write_patients_csv(rows, path, _STREAM_FILE_ROWS)
    return path


@query
def stream_passthrough(spark, d):
    source = _stream_files(spark, d)
    sink, log = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-log")
    stream = streams.read_patient_stream(spark, source, _FILES_PER_BATCH)
    streams.write_stream(stream, sink, log).awaitTermination()
    return spark.read.schema(S.STREAM).parquet(sink)


def _rule_scores(df: DataFrame) -> DataFrame:
    return df.select(
        "patient_id", "metabolic_risk", "lifestyle_burden", "diet_risk", "lifestyle_risk", "verdict",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


@query
def stream_scoring(spark, d):
    source = _stream_files(spark, d)
    sink, log = scratch_path(spark, "scored-out"), scratch_path(spark, "scored-log")
    streams.score_stream(spark, source, sink, log, files_per_trigger=_FILES_PER_BATCH).awaitTermination()
    return _rule_scores(spark.read.parquet(sink))


@query
def stream_batch_scoring(spark, d):
    return _rule_scores(streams.score_accumulated(spark, _stream_files(spark, d)))


@query
def stream_model_scoring(spark, d):
    """A stored disease model on the stream against the batch: rows and differences."""
    source = _stream_files(spark, d)
    model = scratch_path(spark, "stream-model")
    store.save_model(_surrogate(spark, d), model)
    sink, log = scratch_path(spark, "modelled-out"), scratch_path(spark, "modelled-log")
    streams.score_stream(spark, source, sink, log, model, _FILES_PER_BATCH).awaitTermination()
    compared = ["disease", "diet_plan", "lifestyle_plan", "risk_band", "health_risk_index", "verdict"]
    streamed = spark.read.parquet(sink).select("patient_id", F.struct(*compared).alias("streamed"))
    batch = streams.score_accumulated(spark, source, model).select("patient_id", F.struct(*compared).alias("batch"))
    return streamed.join(batch, "patient_id", "full").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("streamed").eqNullSafe(F.col("batch"))).alias("different")
    )


@query
def csv_quarantine(spark, d):
    """Lines of a file with broken cells, short and long lines: all, those that fit, and the others."""
    good, bad = files.read_patients_csv_checked(spark, _broken_lines(spark, d), S.STREAM)
    both = good.select(F.lit(True).alias("fits")).unionByName(bad.select(F.lit(False).alias("fits")))
    return both.agg(F.count(F.lit(1)).alias("lines"), F.count_if("fits").alias("good"), F.count_if(~F.col("fits")).alias("bad"))


@query
def stream_quarantine(spark, d):
    """Rows per verdict of a scored stream whose malformed lines have a partition of their own."""
    sink, log = scratch_path(spark, "quarantine-out"), scratch_path(spark, "quarantine-log")
    streams.score_stream(spark, _broken_lines(spark, d), sink, log, files_per_trigger=_FILES_PER_BATCH, quarantine=True).awaitTermination()
    malformed = F.col("verdict") == "malformed"
    return spark.read.parquet(sink).agg(F.count(F.lit(1)).alias("lines"), F.count_if(~malformed).alias("good"), F.count_if(malformed).alias("bad"))


def _broken_lines(spark: SparkSession, d: str) -> str:
    """Patient lines, of which every 53rd has a word for its age, every 59th a cell too few and every 61st one too many."""
    path = scratch_path(spark, "broken-lines")
    k = F.col("patient_id")
    cells = [F.when(k % 53 == 0, "n/a").otherwise(F.col(c).cast("string")) if c == "age" else F.col(c).cast("string") for c in S.STREAM.names[:-1]]
    line = F.concat_ws(",", *cells, F.when(k % 59 != 0, F.col(S.STREAM.names[-1]).cast("string")), F.when(k % 61 == 0, "more"))
    lines = dataset.patients(spark, d).select(line.alias(",".join(S.STREAM.names)))
    # no cell holds a separator, so lines are written as they are
    lines.write.option("header", True).option("quote", "").option("escape", "").option("sep", "\x01").option("maxRecordsPerFile", _STREAM_FILE_ROWS).csv(path)
    return path


@query
def stream_batches(spark, d):
    """What the batch log of a stream adds up to: one batch for each file, and all rows."""
    source = _stream_files(spark, d)
    # a file of a header alone makes a batch without rows, which the log leaves out
    count = files.read_patients_csv(spark, source, S.STREAM).select(F.input_file_name()).distinct().count()
    log = run_log.BatchLog(spark).start()
    try:
        stream = streams.read_patient_stream(spark, source, 1)
        log.wait(streams.write_stream(stream, scratch_path(spark, "logged-out"), scratch_path(spark, "logged-log")))
    finally:
        log.stop()
    return log.table().agg((F.count(F.lit(1)) == count).alias("batch_per_file"), F.sum("rows").alias("rows"))


@query
def run_document(spark, d):
    """Metadata of the last complete of two runs; one that stopped before its manifest is not read."""
    train, test = _split(spark, d)
    results, root = _results(spark, d), scratch_path(spark, "runs")
    metadata = documents.run_metadata(train, test, len(S.NUMERIC) + len(S.CATEGORICAL), timestamp="2000-01-01 00:00:00")
    for _ in range(2):
        documents.write_run(documents.nested_document(results, ["disease"], metadata), metadata, root)
    documents.write_document(documents.nested_document(results, ["diet"]), f"{root}/run-000009-stopped/document")
    path, stored = documents.last_run(spark, root)
    inside = documents.read_metadata(spark, path)
    models_read = documents.read_nested(spark, path, ["disease"]).count()
    same = stored.select("train_samples", "test_samples", "total_samples", "features").join(
        inside.select("train_samples", "test_samples", "total_samples", "features"), ["train_samples", "test_samples", "total_samples", "features"]
    )
    return same.withColumn("models", F.lit(models_read).cast("long"))


@query
def approximate_median(spark, d):
    """Per measure: whether the exact median is within the stated rank error of the sketch's."""
    data = read_table(spark, d, "lineitem")
    near = approximate_quantiles(data, LINEITEM_MEASURES, [0.5]).select("column", "quantile", "rank_error")
    ranks = values_long(data, LINEITEM_MEASURES).join(F.broadcast(near), "column").groupBy("column").agg(
        F.count_if(F.col("value") < F.col("quantile")).alias("below"), F.count_if(F.col("value") <= F.col("quantile")).alias("upto"),
        F.count(F.lit(1)).alias("n"), F.first("rank_error").alias("rank_error"),
    )
    off = F.greatest(F.col("below") - F.col("n") / 2, F.col("n") / 2 - F.col("upto"), F.lit(0.0))
    return ranks.select("column", (off <= F.col("rank_error") * F.col("n") + 1).alias("within"))


# --- dataset builder ------------------------------------------------------------------------


@query
def weighted_assign(spark, d):
    keys = read_table(spark, d, "customer").select(F.col("c_custkey").cast("bigint").alias("patient_id"))
    slot = pick(SLOTS, draw("patient_id", *dataset.DRAWS["disease"]) % 100)
    return keys.select("patient_id", pick([p.disease for p in PROFILES], slot).alias("disease"))


@query
def patients(spark, d):
    """The derivation itself, not the stored table."""
    return dataset.derive_patients(spark, d).select(
        "patient_id", *S.REQUIRED, "metabolic_risk", "cardio_risk", "lifestyle_burden"
    )
