"""Labelled patient tables: derived from a customer key, or built at any size.

Both are one narrow stage: profile lookups are literal arrays, so no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlattice import schema as S
from medlattice.functions.hashing import draw, key_hash, normal, uniform
from medlattice.functions.rules import with_plans
from medlattice.functions.scalar import clip, cumulative_pick, pick
from medlattice.operators.profile import column_value_counts
from medlattice.plans.profiles import DIET_TYPE_PERCENT, PROFILES, SLOTS
from medlattice.session import read_table, scratch_path

# Multiplier and offset of every fixture draw.
DRAWS = {
    "disease": (611953, 11),
    "age": (7919, 17),
    "sex": (104729, 3),
    "bmi": (15485863, 29),
    "bp_systolic": (32452843, 31),
    "glucose": (49979687, 37),
    "cholesterol": (67867967, 41),
    "sleep_hours": (86028121, 43),
    "stress_level": (122949823, 47),
    "activity_level": (141650939, 53),
    "diet_type": (160481183, 59),
    "smoking": (179424673, 61),
    "alcohol_units": (198491317, 67),
}

#: decimals stored per measure: drawn as whole numbers of tenths, then divided once
_TENTHS = {"bmi", "glucose", "cholesterol", "sleep_hours"}
_MEASURES = ("age", "bmi", "bp_systolic", "glucose", "cholesterol", "sleep_hours")


def profile_index(percent: Column) -> Column:
    """Weighted class assignment: profile position for a percent draw (0-99)."""
    return pick(SLOTS, percent)


def _by_profile(values, index: Column) -> Column:
    return pick(list(values), index)


def _fixture_columns(key: Column) -> dict[str, Column]:
    index = F.col("_profile")
    out: dict[str, Column] = {}
    for name in _MEASURES:
        scale = 10 if name in _TENTHS else 1
        bounds = [getattr(p, name) for p in PROFILES]
        low = _by_profile([round(b.low * scale) for b in bounds], index)
        width = _by_profile([round((b.high - b.low) * scale) + 1 for b in bounds], index)
        value = (low + draw(key, *DRAWS[name]) % width).cast("double")
        out[name] = value / F.lit(float(scale)) if scale > 1 else value
    out["sex"] = F.when(draw(key, *DRAWS["sex"]) % 2 == 0, "Male").otherwise("Female")
    for name, levels, shares in (
        ("stress_level", S.STRESS, [p.stress for p in PROFILES]),
        ("activity_level", S.ACTIVITY, [p.activity for p in PROFILES]),
        ("smoking", S.SMOKING, [p.smoking for p in PROFILES]),
    ):
        weights = [_by_profile([s[i] for s in shares], index) for i in range(len(levels))]
        out[name] = cumulative_pick(draw(key, *DRAWS[name]) % 100, levels, weights)
    out["diet_type"] = cumulative_pick(
        draw(key, *DRAWS["diet_type"]) % 100, S.DIET_TYPE, list(DIET_TYPE_PERCENT)
    )
    span = _by_profile([round(p.alcohol[0] * 40) + 1 for p in PROFILES], index)
    out["alcohol_units"] = (draw(key, *DRAWS["alcohol_units"]) % span).cast("double") / F.lit(10.0)
    out["disease"] = _by_profile([p.disease for p in PROFILES], index)
    return out


def features_from_keys(keys: DataFrame, key: str) -> DataFrame:
    """Patient measures (no plans) drawn from an integer key column."""
    base = keys.select(
        F.col(key).cast("bigint").alias("patient_id"),
        profile_index(draw(F.col(key), *DRAWS["disease"]) % 100).alias("_profile"),
    )
    columns = _fixture_columns(F.col("patient_id"))
    order = [c for c in S.REQUIRED if c in columns]
    return base.select("patient_id", *[columns[c].alias(c) for c in order])


def derive_patients(spark: SparkSession, folder: str) -> DataFrame:
    """Patients with the three scores and both plans, one per customer: scan and project."""
    keys = read_table(spark, folder, "customer").select("c_custkey")
    return with_plans(features_from_keys(keys, "c_custkey"))


_STORED: dict[tuple[str, str], tuple[str, T.StructType]] = {}


def scored_patients(spark: SparkSession, folder: str) -> DataFrame:
    """The derived patients as a stored table, written once per session and folder.

    Everything downstream scans Parquet, so column pruning and filters reach the files instead
    of re-running the derivation, and a lost executor re-reads its split.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORED:
        path = scratch_path(spark, "patients")
        derived = derive_patients(spark, folder)
        derived.write.parquet(path)
        _STORED[key] = (path, derived.schema)
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def patients(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled patients derived from the customer table."""
    return scored_patients(spark, folder).select("patient_id", *S.REQUIRED)


def dirty_patients(spark: SparkSession, folder: str) -> DataFrame:
    """The same patients with nulls, an impossible value and an unseen level mixed in."""
    k = F.col("patient_id")
    null = F.lit(None)
    return patients(spark, folder).withColumns(
        {
            "sleep_hours": F.when(k % 37 == 0, null).otherwise(F.col("sleep_hours")),
            "alcohol_units": F.when(k % 41 == 0, null).otherwise(F.col("alcohol_units")),
            "stress_level": F.when(k % 43 == 0, null).otherwise(F.col("stress_level")),
            "bmi": F.when(k % 101 == 0, null).when(k % 97 == 0, -1.0).otherwise(F.col("bmi")),
            "smoking": F.when(k % 89 == 0, "Unknown").otherwise(F.col("smoking")),
        }
    )


def build_patients(spark: SparkSession, rows: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """Labelled patients of any size, numbered from 0."""
    ids = spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)
    return patients_from_profiles(ids, seed)


def patients_from_profiles(ids: DataFrame, seed: int = 42) -> DataFrame:
    """One labelled patient per ``id``: clipped normal draws around the disease profiles.

    Every draw hashes (id, seed), so the table is the same for any partitioning and a lost
    task rebuilds identical rows. Measures are rounded before they are labelled.
    """
    index = F.col("_profile")
    base = ids.select(
        F.col("id").alias("patient_id"),
        profile_index(F.floor(uniform("id", seed, 100) * 100)).alias("_profile"),
    )
    key = F.col("patient_id")
    out: dict[str, Column] = {}
    for stream, name in enumerate(_MEASURES):
        bounds = [getattr(p, name) for p in PROFILES]
        mean, sd, low, high = (
            _by_profile([float(getattr(b, part)) for b in bounds], index)
            for part in ("mean", "sd", "low", "high")
        )
        value = clip(mean + sd * normal(key, seed, stream), low, high)
        out[name] = F.round(value, 1) if name in _TENTHS else F.floor(value).cast("double")
    mean, sd = (_by_profile([float(p.alcohol[i]) for p in PROFILES], index) for i in (0, 1))
    out["alcohol_units"] = F.round(clip(mean + sd * normal(key, seed, 20), 0.0, 30.0), 1)
    out["sex"] = F.when(uniform(key, seed, 101) < 0.5, "Male").otherwise("Female")
    for stream, name, levels, shares in (
        (102, "stress_level", S.STRESS, [p.stress for p in PROFILES]),
        (103, "activity_level", S.ACTIVITY, [p.activity for p in PROFILES]),
        (104, "smoking", S.SMOKING, [p.smoking for p in PROFILES]),
    ):
        weights = [_by_profile([s[i] for s in shares], index) for i in range(len(levels))]
        out[name] = cumulative_pick(F.floor(uniform(key, seed, stream) * 100), levels, weights)
    out["diet_type"] = cumulative_pick(
        F.floor(uniform(key, seed, 105) * 100), S.DIET_TYPE, list(DIET_TYPE_PERCENT)
    )
    out["disease"] = _by_profile([p.disease for p in PROFILES], index)
    features = base.select(
        "patient_id", *[out[c].alias(c) for c in S.REQUIRED if c in out]
    )
    return with_plans(features).select("patient_id", *S.REQUIRED)


def label_summary(df: DataFrame) -> DataFrame:
    """Row count and share of every class of the three targets, in one pass."""
    return column_value_counts(df, list(S.TARGETS.values()))


# --- fixtures that stand in for model output ------------------------------------------------


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """``label`` is the diet plan; four of five keys are predicted right, the rest as
    Mediterranean."""
    truth = F.col("diet_plan")
    return patients(spark, folder).select(
        "patient_id",
        truth.alias("label"),
        F.when(F.col("patient_id") % 10 < 8, truth).otherwise("Mediterranean").alias("prediction"),
    )


def grouped(spark: SparkSession, folder: str) -> DataFrame:
    """Patients with a given cluster column."""
    return patients(spark, folder).withColumn("cluster", (F.col("patient_id") % 5).cast("int"))


# Draws of the four class weights.
PROBABILITY_DRAWS = ((23, 5), (6151, 101), (40487, 211), (350377, 307))


def probabilities(spark: SparkSession, folder: str) -> DataFrame:
    """A four-class probability array per patient."""
    weights = [F.lit(1) + draw("patient_id", *d) % 97 for d in PROBABILITY_DRAWS]
    named = [w.cast("double").alias(f"w{i}") for i, w in enumerate(weights)]
    total = F.col("w0") + F.col("w1") + F.col("w2") + F.col("w3")
    return (
        scored_patients(spark, folder)
        .select("patient_id", "metabolic_risk", "lifestyle_burden", *named)
        .select(
            "patient_id", "metabolic_risk", "lifestyle_burden",
            F.array(*[F.col(f"w{i}") / total for i in range(4)]).alias("probability"),
        )
    )


def contribution_draw(position: int) -> tuple[int, int]:
    """Multiplier and offset of the n-th contribution."""
    return 7001 + 1000 * position + position * position, 13 + 7 * position


def contributions(spark: SparkSession, folder: str) -> DataFrame:
    """Eleven signed contributions with three decimals per patient."""
    keys = read_table(spark, folder, "customer").select(F.col("c_custkey").cast("bigint").alias("patient_id"))
    entries = [
        F.struct(
            F.lit(name).alias("feature"),
            ((draw("patient_id", *contribution_draw(i)) % 2001 - 1000).cast("double") / F.lit(1000.0)).alias("value"),
        )
        for i, name in enumerate(S.ORDINAL_FEATURES)
    ]
    return keys.select("patient_id", F.array(*entries).alias("contributions"))


# Chance in percent that each stand-in algorithm is right, and its cost factor.
ALGORITHM_SKILL = {
    "LogisticRegression": (78, 3),
    "SVM": (74, 11),
    "XGBoost": (95, 5),
    "LightGBM": (93, 2),
    "NeuralNetwork": (91, 9),
    "RandomForest": (94, 4),
}
FALLBACK_CLASS = {"disease": "Healthy", "diet": "Mediterranean", "lifestyle": "Active_Movement"}


def grid_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (patient, task, algorithm): true label, stand-in prediction, cost in ms.

    This is the shape a model grid leaves behind after scoring a test table.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(task).alias("task"), F.lit(algorithm).alias("algorithm"), F.lit(1000 + 10 * t + a).alias("seed"),
                F.lit(skill - 2 * t).alias("skill"), F.lit(cost * (t + 1)).alias("cost"),
            )
            for t, task in enumerate(S.TARGETS)
            for a, (algorithm, (skill, cost)) in enumerate(ALGORITHM_SKILL.items())
        ]
    )
    truth, fallback = F.lit(None), F.lit(None)
    for task, target in S.TARGETS.items():
        truth = F.when(F.col("task") == task, F.col(target)).otherwise(truth)
        fallback = F.when(F.col("task") == task, F.lit(FALLBACK_CLASS[task])).otherwise(fallback)
    return (
        patients(spark, folder)
        .select("patient_id", *S.TARGETS.values(), F.explode(cells).alias("cell"))
        .select("patient_id", *S.TARGETS.values(), "cell.*")
        .select("*", (key_hash("patient_id", F.col("seed")) % 100).alias("chance"), truth.alias("label"))
        .select(
            "patient_id", "task", "algorithm", "label",
            F.when(F.col("chance") < F.col("skill"), F.col("label")).otherwise(fallback).alias("prediction"),
            (F.col("cost") + F.col("chance") % 5).cast("bigint").alias("cost_ms"),
        )
    )
