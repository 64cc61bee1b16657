from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from medlattice import schema as S
from medlattice.operators import compare
from medlattice.session import scratch_path
from medlattice.sources import files, results, store
from medlattice.streaming import patient_stream as streams
from test_operators import PUBLISHED


def write_feed(patients, path, parts, drop_ids=()):
    rows = patients.filter(~F.col("patient_id").isin(*drop_ids)) if drop_ids else patients
    rows = rows.select(F.col("patient_id").cast("string").alias("patient_id"), *S.STREAM.names[1:])
    files.write_patients_csv(rows.repartition(parts), path)


def test_missing_file_and_columns(spark, patients):
    with pytest.raises(AnalysisException):
        files.read_patients(spark, scratch_path(spark, "nothing"))
    path = scratch_path(spark, "partial")
    files.write_patients(patients.drop("disease"), path)
    with pytest.raises(ValueError, match="disease"):
        files.read_patients(spark, path)


def test_csv_header_must_match(spark, patients):
    path = scratch_path(spark, "csv")
    files.write_patients_csv(patients.select("sex", "age"), path)
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.read_patients_csv(spark, path).collect()


def test_documents_round_trip(spark):
    table = spark.createDataFrame(
        PUBLISHED, "task string, algorithm string, accuracy double, f1_score double, precision double, recall double, training_time_seconds double"
    ).withColumn("num_classes", F.lit(8))
    root = scratch_path(spark, "documents")
    results.write_document(results.nested_document(table), f"{root}/nested")
    results.write_document(results.flat_document(table, "diet"), f"{root}/flat")
    nested = results.read_nested(spark, f"{root}/nested").select(table.columns)
    assert nested.exceptAll(table).count() == 0 and nested.count() == table.count()
    flat = results.read_flat(spark, f"{root}/flat", "diet")
    assert flat.exceptAll(table.filter("task = 'diet'").drop("num_classes")).count() == 0 and flat.count() == 2
    assert compare.stack_results([nested, flat]).count() == len(PUBLISHED) + 2


def test_foreign_documents(spark, tmp_path):
    """Hand-written files in the published shapes."""
    body = {"accuracy": 0.9, "precision": 0.8, "recall": 0.7, "f1_score": 0.6, "cv_accuracy_mean": 0.5, "cv_accuracy_std": 0.1,
            "training_time_seconds": 2.5, "num_classes": 11}
    meta = {"train_samples": 80, "test_samples": 20, "total_samples": 100, "features": 12, "timestamp": "2024-01-01 00:00:00"}
    (tmp_path / "n.json").write_text(json.dumps({"disease": {"num_classes": 11, "models": {"SVM": body}}, "metadata": meta}, indent=4))
    row = results.read_nested(spark, str(tmp_path / "n.json")).first()
    assert (row["task"], row["algorithm"], row["f1_score"], row["num_classes"]) == ("disease", "SVM", 0.6, 11)
    assert results.read_metadata(spark, str(tmp_path / "n.json")).first()["total_samples"] == 100
    one = {"accuracy": 0.9, "f1": 0.8, "precision": 0.7, "recall": 0.6}
    (tmp_path / "p.json").write_text(json.dumps({"disease": one, "lifestyle": one, "train_samples": 8, "algorithm": "RandomForest"}))
    got = {r["task"]: (r["accuracy"], r["f1_score"]) for r in results.read_production(spark, str(tmp_path / "p.json")).collect()}
    assert got == {"disease": (0.9, 0.8), "diet": (0.0, 0.0), "lifestyle": (0.9, 0.8)}


def test_one_file_per_batch(spark, patients):
    source, sink, log = (scratch_path(spark, n) for n in ("feed", "out", "log"))
    write_feed(patients, source, 5)
    query = streams.write_stream(streams.read_patient_stream(spark, source, 1), sink, log)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 5
    assert spark.read.parquet(sink).count() == 1500


def test_stream_equals_batch_and_restarts_without_duplicates(spark, patients, surrogate):
    source, sink, log, model = (scratch_path(spark, n) for n in ("feed", "out", "log", "model"))
    store.save_model(surrogate, model)
    early = [r[0] for r in patients.filter("patient_id % 4 = 0").select("patient_id").collect()]
    write_feed(patients, source, 3, drop_ids=early)
    streams.score_stream(spark, source, sink, log, model, 2).awaitTermination()
    late = patients.filter("patient_id % 4 = 0").select(F.col("patient_id").cast("string").alias("patient_id"), *S.STREAM.names[1:])
    late.coalesce(1).write.mode("append").option("header", True).csv(source)
    streams.score_stream(spark, source, sink, log, model, 2).awaitTermination()
    streams.score_stream(spark, source, sink, log, model, 2).awaitTermination()
    batch = streams.score_accumulated(spark, source, model)
    streamed = spark.read.parquet(sink).select(batch.columns)
    assert streamed.count() == batch.count() == 1500
    keys = [c for c in batch.columns if c not in ("failed_rules",)]
    assert streamed.select(keys).exceptAll(batch.select(keys)).count() == 0
    assert batch.filter("verdict = 'accepted' and disease is null").count() == 0


def test_rejected_rows_stay_with_null_scores(spark, surrogate):
    model = scratch_path(spark, "model")
    store.save_model(surrogate, model)
    good = ("1", 50.0, "Male", 25.0, 120.0, 100.0, 200.0, 7.0, "Low", "Light", "Asian", "Never", 2.0)
    bad = ("2", 50.0, "Male", None, 120.0, 100.0, 200.0, 7.0, "Low", "Light", "Asian", "Pipe", 2.0)
    df = spark.createDataFrame([good, bad], S.STREAM)
    out = {r["patient_id"]: r for r in streams.score_patients(df, store.load_model(spark, model)).collect()}
    assert out["1"]["verdict"] == "accepted" and out["1"]["disease"] in S.DISEASES and 0 <= out["1"]["health_risk_index"] <= 1
    assert out["2"]["verdict"] == "rejected" and sorted(out["2"]["failed_rules"]) == ["bmi", "smoking"]
    assert out["2"]["disease"] is None and out["2"]["bmi"] is None and out["2"]["risk_band"] is None


def test_fallback_without_model(spark, patients):
    source = scratch_path(spark, "feed")
    write_feed(patients, source, 2)
    scored = streams.score_accumulated(spark, source, scratch_path(spark, "no-model"))
    row = scored.agg(F.count("disease"), F.count("metabolic_risk"), F.count(F.lit(1))).first()
    assert tuple(row) == (0, 1500, 1500)


def test_interval_trigger(spark, patients):
    source, sink, log = (scratch_path(spark, n) for n in ("feed", "out", "log"))
    write_feed(patients, source, 2)
    query = streams.write_stream(streams.read_patient_stream(spark, source, None), sink, log, once=False, every="1 second")
    query.processAllAvailable()
    assert streams.run_for(query, 0.1) is False
    assert spark.read.parquet(sink).count() == 1500


def test_console_and_timed_run(spark, patients, capfd):
    source = scratch_path(spark, "feed")
    write_feed(patients.limit(5), source, 1)
    query = streams.write_console(streams.read_patient_stream(spark, source), every=None)
    query.processAllAvailable()
    assert streams.run_for(query, 0.1) is False
    assert not query.isActive


def test_labelled_rows_keep_their_label(spark, patients, surrogate):
    scored = streams.score_patients(patients, surrogate.model)
    assert {"true_disease", "disease", "true_diet_plan", "true_lifestyle_plan"} <= set(scored.columns)
    assert scored.filter("true_disease IS NULL").count() == 0


def test_risk_reads_the_class_order_from_the_model(spark, patients):
    from medlattice.operators import models

    train = patients.filter("disease != 'Cancer'")
    fitted = models.train(train, "disease", "SVM", {"maxIter": 3, "components": 32})
    healthy = fitted.model.stages[-1].getLabels().index("Healthy")
    own = fitted.predict(patients).select("patient_id", F.get("probability", F.lit(healthy)).alias("p"))
    scored = streams.score_patients(patients.select(*[f.name for f in S.STREAM.fields]), fitted.model).join(own, "patient_id")
    index = 0.5 * (1 - F.col("p")) + 0.3 * F.col("lifestyle_risk") + 0.2 * F.col("diet_risk")
    assert scored.filter(F.abs(F.col("health_risk_index") - index) > 1e-3).count() == 0


def test_a_reordered_header_fails_in_a_stream_too(spark, tmp_path):
    names = [f.name for f in S.STREAM.fields]
    swapped = [*names[:2], names[3], names[2], *names[4:]]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(",".join(swapped) + "\n" + ",".join("1" for _ in names) + "\n")
    query = streams.write_stream(streams.read_patient_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "log"))
    with pytest.raises(Exception, match="(?i)header"):
        query.awaitTermination()


def test_readers_turn_nan_into_null(spark, tmp_path):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, "y")], "age double, gender string")
    df.write.parquet(str(tmp_path / "p"))
    assert files.read_patients(spark, str(tmp_path / "p"), required=("age",)).filter("age IS NULL").count() == 1


def test_unlisted_values_and_tasks_are_not_lost(spark):
    from medlattice.operators import compare, encode, profile

    df = spark.createDataFrame([("a", "F"), ("a", "Z"), ("a", None), ("b", "O")], "g string, s string")
    assert sorted(map(tuple, profile.contingency(df, "g", "s", ("F", "O")).collect())) == [("a", 1, 0, 2), ("b", 0, 1, 0)]
    results = spark.createDataFrame([("sleep", "X", 0.5, 0.5, 0.5, 0.5, 1.0)], "task string, algorithm string, accuracy double, f1_score double, precision double, recall double, training_time_seconds double")
    assert compare.default_zero(results).filter("task = 'sleep' AND accuracy = 0.5").count() == 1
    assert compare.best_models(results).filter("task = 'sleep' AND algorithm = 'X'").count() == 1
    with pytest.raises(ValueError, match="sleep"):
        compare.metric_matrix(results)
    with pytest.raises(ValueError, match="age"):
        encode.fill_stage({"age": None})
