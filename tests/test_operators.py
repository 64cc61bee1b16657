from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from medlattice import schema as S
from medlattice.operators import clean, compare, encode, evaluate, profile, ranking, split
from medlattice.operators.quantiles import exact_quantiles
from medlattice.plans import dataset
from medlattice.session import checkpoint_root, cut_lineage

from conftest import MEDIUM


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- cleaning -------------------------------------------------------------------------------


def test_required_columns_and_rows(spark):
    df = spark.range(0).withColumn("age", F.lit(1.0))
    with pytest.raises(ValueError, match="bmi"):
        clean.require_columns(df, ["age", "bmi"])
    with pytest.raises(ValueError, match="no rows"):
        clean.require_rows(df)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (None, None), (1.0, "b")], "x double, y string")
    assert {r["column"]: r["null_count"] for r in clean.null_profile(df, ["x", "y"]).collect()} == {"x": 2, "y": 1}
    assert clean.fit_mean(df, ["x"]).values == {"x": 1.0}
    assert clean.nan_to_null(df).filter("x is null").count() == 2


def test_mode_ignores_nulls_and_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), ("b",), ("a",), ("b",), ("a",)], "c string")
    assert clean.fit_mode(df, ["c"]).values == {"c": "a"}


def test_cast_failures_are_counted(spark):
    df = spark.createDataFrame([("1.5", "x"), (None, "2"), ("3", "4")], "a string, b string")
    got = [tuple(r) for r in clean.cast_numeric(df, ["a", "b"]).select("a", "b", "cast_failures").collect()]
    assert got == [(1.5, None, 1), (None, 2.0, 0), (3.0, 4.0, 0)]


def test_clean_chain_is_independent_of_partitioning(spark):
    dirty = dataset.dirty_patients(spark, MEDIUM)
    one, fill_one = clean.clean_patients(dirty.repartition(1))
    many, fill_many = clean.clean_patients(dirty.repartition(16))
    assert fill_one == fill_many
    assert one.exceptAll(many).count() == 0 and one.count() == many.count() == 1485
    assert clean.null_profile(one, S.REQUIRED).filter("null_count > 0").count() == 0


def test_quarantine_keeps_every_row(spark):
    dirty = dataset.dirty_patients(spark, MEDIUM)
    good, bad = clean.quarantine(dirty)
    assert good.count() + bad.count() == 1500
    assert bad.filter(F.size("failed_rules") == 0).count() == 0


def test_sample_is_exact_and_bounded(spark, patients):
    first = clean.sample_rows(patients, 100)
    again = clean.sample_rows(patients.repartition(13), 100)
    assert first.count() == 100 and first.exceptAll(again).count() == 0
    assert clean.sample_rows(patients, 10_000).count() == 1500


# --- quantiles ------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 10, 501])
def test_quantiles_match_sorting(spark, n):
    rng = random.Random(n)
    hot = [7.0] * (n // 3)
    values = hot + [rng.choice([rng.gauss(0, 1), 10 ** rng.uniform(-3, 9), -(10 ** rng.uniform(0, 6))]) for _ in range(n - len(hot))]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(7)
    got = {r["p"]: r["quantile"] for r in exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    ordered = sorted(values)
    for p, value in got.items():
        position = p * (n - 1)
        low = int(position)
        expected = ordered[low] + (ordered[min(low + 1, n - 1)] - ordered[low]) * (position - low)
        assert value == pytest.approx(expected, rel=1e-12, abs=1e-12)
    assert got[0.5] == pytest.approx(statistics.median(values), rel=1e-12, abs=1e-12)


def test_outliers_and_infinities_crowd_no_task(spark, monkeypatch):
    """Equal-width cells would hold all of these rows but one in a single cell."""
    from medlattice.operators import quantiles

    rng = random.Random(3)
    rows = [rng.gauss(0, 1) for _ in range(4000)] + [1e9, -1e300, float("inf"), float("inf"), float("-inf")] + [0.25] * 2000
    df = spark.createDataFrame([(v,) for v in rows], "x double").repartition(6)
    want = sorted(rows)

    def exact(p):
        at = p * (len(want) - 1)
        low = int(at)
        return want[low] if at == low else want[low] * (1 - at + low) + want[low + 1] * (at - low)

    probs = [0.0, 0.01, 0.3, 0.5, 0.77, 1.0]
    for inside, accuracy in ((quantiles.INSIDE, quantiles.ACCURACY), (40, 50)):
        monkeypatch.setattr(quantiles, "INSIDE", inside)
        monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
        got = {r["p"]: r["quantile"] for r in exact_quantiles(df, ["x"], probs).collect()}
        assert got == pytest.approx({p: exact(p) for p in probs})


def test_approximate_quantiles_keep_their_rank_error(spark):
    from bisect import bisect_left, bisect_right

    from medlattice.operators.quantiles import approximate_quantiles, from_cells, sketch_cells, values_long

    rng = random.Random(4)
    rows = [rng.lognormvariate(0, 3) * rng.choice((-1, 1)) for _ in range(5000)] + [0.0, -0.0, float("inf"), 5e-324, 1e308] + [7.5] * 500
    want = sorted(rows)
    df = spark.createDataFrame([(v,) for v in rows], "x double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    one, many = ({r["p"]: (r["quantile"], r["rank_error"]) for r in approximate_quantiles(df.repartition(n), ["x"], probs).collect()} for n in (1, 16))
    assert one == many
    for p, (value, error) in one.items():
        low, high = bisect_left(want, value), bisect_right(want, value)
        assert low - error * len(want) - 1 <= p * (len(want) - 1) <= high + error * len(want) + 1 and error < 0.01
    # sketches of parts add up to the sketch of the whole
    parts = [sketch_cells(values_long(part, ["x"]), ["column"]) for part in df.randomSplit([0.3, 0.7], 1)]
    added = parts[0].unionByName(parts[1]).groupBy("column", "cell").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    assert {r["p"]: (r["quantile"], r["rank_error"]) for r in from_cells(added, ["column"], probs).collect()} == one


def test_sketch_of_a_stream(spark, tmp_path):
    """The same cells as a running count of a stream."""
    from medlattice.operators.quantiles import from_cells, sketch_cells, values_long

    df = spark.range(1000).select((F.col("id") * 1.5 - 300).alias("x"))
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("x double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = sketch_cells(values_long(stream, ["x"]), ["column"]).writeStream.outputMode("complete").format("memory").queryName("cells").start()
    query.processAllAvailable()
    query.stop()
    batch = sketch_cells(values_long(df, ["x"]), ["column"])
    assert sorted(map(tuple, spark.table("cells").collect())) == sorted(map(tuple, batch.collect()))
    assert abs(from_cells(spark.table("cells"), ["column"], [0.5]).first()["quantile"] - 449.25) < 2


def test_grouped_quantiles_with_null_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, None), ("b", float("nan"))], "g string, x double")
    got = {r["g"]: r["quantile"] for r in exact_quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == {"a": 2.0, None: 5.0}


def test_many_groups_are_joined(spark, monkeypatch):
    from medlattice.operators import quantiles

    monkeypatch.setattr(quantiles, "BROADCAST_ROWS", 5)
    df = spark.range(3000).select((F.col("id") % 100).alias("g"), F.col("id").cast("double").alias("x"))
    got = {r["g"]: r["quantile"] for r in exact_quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == {g: 1450.0 + g for g in range(100)}


# --- splits ---------------------------------------------------------------------------------


def test_split_is_stratified_and_stable(spark, patients):
    small = patients.select("patient_id", "disease")
    one = split.stratified_split(small.repartition(1), "disease")
    many = split.stratified_split(small.repartition(16), "disease")
    assert one.exceptAll(many).count() == 0
    shares = one.groupBy("disease").agg(F.count_if("is_train").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    assert all(r["t"] == int(r["n"] * 0.8) for r in shares)


def test_split_moves_no_rows(patients):
    text = plan(split.stratified_split(patients, "disease"))
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_split_of_tiny_and_null_labels(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y"), (4, None), (5, None)], "patient_id long, label string")
    got = {r["patient_id"]: r["is_train"] for r in split.stratified_split(df, "label").collect()}
    assert len(got) == 5 and got[1] is False
    assert sum(got[i] for i in (2, 3)) == 1 and sum(got[i] for i in (4, 5)) == 1


def test_split_with_many_labels_uses_a_join(spark, monkeypatch):
    monkeypatch.setattr(split, "BROADCAST_LABELS", 3)
    df = spark.range(1000).select(F.col("id").alias("patient_id"), (F.col("id") % 10).cast("string").alias("label"))
    cuts = split.fit_cuts(df, "label", lambda n: [F.floor(n / 2)])
    assert not cuts.small
    assert cuts.transform(df).groupBy("label", "part").count().filter("count != 50").count() == 0


def test_folds_are_even(patients):
    folds = split.stratified_folds(patients.select("patient_id", "disease"), "disease", 4)
    sizes = folds.groupBy("disease").pivot("fold", [0, 1, 2, 3]).count().na.fill(0).collect()
    assert all(max(r[1:]) - min(r[1:]) <= 1 for r in map(tuple, sizes))


def test_split_covers_hot_labels(spark):
    """A third of all rows share a label; negative keys are keys too."""
    df = spark.range(-500, 2500).select(
        F.col("id").alias("patient_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("label")
    )
    out = split.stratified_split(df, "label")
    assert out.count() == 3000
    hot = out.filter("label = 'hot'").agg(F.count_if("is_train").alias("t"), F.count(F.lit(1)).alias("n")).first()
    assert hot["t"] == int(hot["n"] * 0.8)


def test_shuffle_positions_are_complete(patients):
    out = split.seeded_shuffle(patients.select("patient_id"))
    row = out.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()
    assert tuple(row) == (1, 1500, 1500)


# --- encoding -------------------------------------------------------------------------------


@pytest.mark.parametrize(("kind", "width"), [("production", 28), ("coded", 12), ("one_hot", 23), ("ordinal", 11)])
def test_feature_widths(patients, kind, width):
    from medlattice.operators.models import feature_stages

    fitted = encode.fit_features(feature_stages("disease", patients, kind), patients)
    assert len(fitted.transform(patients).first()["features"]) == width


def test_unseen_levels(spark, patients):
    odd = patients.limit(5).withColumn("smoking", F.lit("Pipe"))
    fitted = encode.fit_features(encode.one_hot_features(patients), patients)
    vector = fitted.transform(odd).first()["features"].toArray()
    assert vector[-3:].tolist() == [0.0, 0.0, 0.0]


def test_unknown_target_raises(patients):
    odd = patients.limit(1).withColumn("disease", F.lit("Gout"))
    with pytest.raises(Exception, match="Unseen label|Gout"):
        encode.label_indexer("disease", S.DISEASES).transform(odd).collect()


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double")
    scale = encode.fit_population_scaler(df, ["a", "b"])
    assert [tuple(r) for r in scale.transform(df).select("a_scaled", "b_scaled").collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    staged = scale.as_stage().transform(df).select("a_scaled", "b_scaled")
    assert [tuple(r) for r in staged.collect()] == [(-1.0, 0.0), (1.0, 0.0)]


# --- evaluation -----------------------------------------------------------------------------


def test_metrics_match_spark_evaluator(spark, patients):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = patients.select((F.col("patient_id") % 5).cast("double").alias("label"), (F.col("patient_id") % 7 % 4).cast("double").alias("prediction"))
    row = evaluate.classification_metrics(df).first()
    for ours, theirs in (("accuracy", "accuracy"), ("f1_score", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")):
        assert row[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df), abs=1e-12)


def test_silhouette_matches_spark_evaluator(spark, patients):
    from pyspark.ml.evaluation import ClusteringEvaluator

    data = dataset.grouped(spark, MEDIUM)
    ours = evaluate.silhouette(data, ["age", "bmi"]).first()["silhouette"]
    vectors = encode.assembler(["age", "bmi"], "features").transform(data)
    theirs = ClusteringEvaluator(predictionCol="cluster").evaluate(vectors)
    assert ours == pytest.approx(theirs, abs=1e-10)


def test_silhouette_of_singletons_is_zero(spark):
    df = spark.createDataFrame([(0.0, 0), (9.0, 1), (10.0, 1)], "x double, cluster int")
    row = evaluate.silhouette(df, ["x"]).first()
    b1, b2 = 81.0, 100.0
    assert row["silhouette"] == pytest.approx((0.0 + (b1 - 1.0) / b1 + (b2 - 1.0) / b2) / 3)


@pytest.mark.parametrize(("value", "band"), [(0.85, "achieved"), (0.8499, "close"), (0.75, "close"), (0.7499, "below")])
def test_target_band(spark, value, band):
    df = spark.createDataFrame([(value,)], "accuracy double")
    assert evaluate.target_band(df).first()["band"] == band


# --- profiling ------------------------------------------------------------------------------


def test_constant_histogram(spark):
    got = profile.histogram(spark.createDataFrame([(4.0,), (4.0,), (None,)], "x double"), "x", 3).orderBy("bin").collect()
    assert [r["n"] for r in got] == [2, 0, 0]


def test_profile_reads_each_column_once(patients):
    text = plan(profile.group_means(dataset.grouped(patients.sparkSession, MEDIUM), "cluster", ["age"]))
    assert "ReadSchema: struct<patient_id:bigint,age:double>" in text


def test_critical_filter_reaches_the_files(spark):
    text = plan(clean.drop_critical_nulls(dataset.patients(spark, MEDIUM)).select("age"))
    assert "PushedFilters: [IsNotNull(age), IsNotNull(sex)" in text


# --- ranking and comparison -----------------------------------------------------------------

# The published result table.
PUBLISHED = [
    ("disease", "XGBoost", 0.9567, 0.9566, 0.9567, 0.9567, 16.68), ("disease", "RandomForest", 0.9498, 0.9495, 0.9499, 0.9498, 19.61),
    ("disease", "LightGBM", 0.9497, 0.9496, 0.9497, 0.9497, 8.47), ("disease", "NeuralNetwork", 0.9366, 0.9364, 0.9367, 0.9366, 257.43),
    ("disease", "LogisticRegression", 0.8924, 0.8912, 0.8908, 0.8924, 10.62), ("disease", "SVM", 0.7463, 0.7556, 0.7946, 0.7463, 2847.86),
    ("diet", "LightGBM", 0.9790, 0.9790, 0.9790, 0.9790, 25.39), ("diet", "XGBoost", 0.9778, 0.9778, 0.9778, 0.9778, 27.62),
    ("lifestyle", "RandomForest", 0.9768, 0.9767, 0.9777, 0.9768, 32.60), ("lifestyle", "NeuralNetwork", 0.9768, 0.9767, 0.9768, 0.9768, 369.01),
    ("lifestyle", "XGBoost", 0.9860, 0.9860, 0.9860, 0.9860, 23.96),
]


@pytest.fixture(scope="module")
def published(spark):
    return spark.createDataFrame(
        PUBLISHED, "task string, algorithm string, accuracy double, f1_score double, precision double, recall double, training_time_seconds double"
    )


def test_best_and_rank(published):
    best = {r["task"]: r["algorithm"] for r in compare.best_models(published).collect()}
    assert best == {"disease": "XGBoost", "diet": "LightGBM", "lifestyle": "XGBoost"}
    ranked = [(r["algorithm"], r["rank"]) for r in compare.rank_models(published).filter("task = 'lifestyle'").orderBy("rank").collect()]
    assert ranked == [("XGBoost", 1), ("NeuralNetwork", 2), ("RandomForest", 3)]


def test_missing_combinations_are_zero(published):
    matrix = {r["algorithm"]: r for r in compare.metric_matrix(published).collect()}
    assert matrix["SVM"]["diet"] == 0.0 and matrix["XGBoost"]["diet"] == 0.9778
    assert compare.metric_grid(published).count() == 4 * 6 * 3
    empty = compare.best_models(published.filter("task = 'diet'")).filter("task = 'disease'").first()
    assert (empty["algorithm"], empty["accuracy"]) == ("N/A", 0.0)


def test_summary_marks_best_row(published):
    rows = compare.summary_table(published).filter("task = 'disease'").collect()
    assert [r["is_best"] for r in rows] == [True] + [False] * 5
    assert [r["task_label"] for r in rows] == ["Disease"] + [None] * 5


def test_top_entries(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.2, 0.1],)], "p array<double>")
    top = df.select(ranking.top_classes("p", 3).alias("t"), ranking.arg_max("p").alias("a")).first()
    assert [e["class"] for e in top["t"]] == [1, 0, 2] and top["a"] == 1.0


# --- session --------------------------------------------------------------------------------


def test_scratch_follows_the_session_setting(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    cut = cut_lineage(spark.range(3), "probe")
    assert spark.conf.get("spark.checkpoint.dir") in cut.inputFiles()[0] and cut.count() == 3


def test_builder_is_independent_of_partitioning(spark):
    one, many = (dataset.build_patients(spark, 2000, partitions=n) for n in (1, 9))
    assert one.exceptAll(many).count() == 0
    bounds = one.agg(F.min("age"), F.max("age"), F.max("alcohol_units")).first()
    assert bounds[0] >= 18 and bounds[1] <= 85 and bounds[2] <= 30
    assert clean.domain_check(one).filter("verdict = 'rejected'").count() == 0
    assert one.drop("patient_id").exceptAll(dataset.build_patients(spark, 2000, seed=7).drop("patient_id")).count() > 1900
