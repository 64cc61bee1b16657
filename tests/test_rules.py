"""Truth tables: one row per branch, both sides of every threshold, and null inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from medlattice import schema as S
from medlattice.functions import rules
from medlattice.functions.scalar import clip, cumulative_pick, decode

NEUTRAL = {
    "age": 40.0, "sex": "Female", "bmi": 22.0, "bp_systolic": 110.0, "glucose": 90.0, "cholesterol": 180.0,
    "sleep_hours": 6.5, "stress_level": "Low", "activity_level": "Moderate", "diet_type": "Western",
    "smoking": "Never", "alcohol_units": 1.0, "disease": "Healthy",
}
_FIELDS = ", ".join(f"{c} {'double' if c in S.NUMERIC else 'string'}" for c in NEUTRAL)


def evaluate(spark, expression, cases):
    """``cases``: list of (changes to the neutral patient, expected)."""
    rows = [(i, *{**NEUTRAL, **changes}.values()) for i, (changes, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, " + _FIELDS).select("i", expression.alias("out"))
    got = {r["i"]: r["out"] for r in df.collect()}
    return [got[i] for i in range(len(cases))], [expected for _, expected in cases]


def bands(column, *pairs):
    return [({column: float(v)}, points) for v, points in pairs]


METABOLIC = (
    bands("age", (45, 0), (46, 10), (65, 10), (66, 20))
    + bands("bmi", (24.9, 0), (25, 5), (29.9, 5), (30, 15), (34.9, 15), (35, 20))
    + bands("glucose", (99.9, 0), (100, 5), (139.9, 5), (140, 12), (199.9, 12), (200, 20))
    + bands("bp_systolic", (129, 0), (130, 5), (139, 5), (140, 10), (159, 10), (160, 15))
    + bands("cholesterol", (199.9, 0), (200, 5), (239.9, 5), (240, 10), (279.9, 10), (280, 15))
    + [({"activity_level": a}, p) for a, p in (("Sedentary", 15), ("Light", 8), ("Moderate", 0), ("Active", -5), ("Other", 0))]
    + [({"smoking": a}, p) for a, p in (("Never", 0), ("Former", 5), ("Current", 20), ("Other", 0))]
    + [
        ({"age": 70.0, "bmi": 40.0, "glucose": 250.0, "bp_systolic": 190.0, "cholesterol": 300.0, "activity_level": "Sedentary", "smoking": "Current"}, 100),
        ({"age": None}, None), ({"smoking": None}, None), ({"activity_level": None}, None),
    ]
)
CARDIO = (
    [({"sex": "Male", "age": float(a)}, p) for a, p in ((45, 0), (46, 10), (60, 10), (61, 15))]
    + [({"age": float(a)}, p) for a, p in ((55, 0), (56, 10), (65, 10), (66, 15))]
    + bands("bp_systolic", (129, 0), (130, 6), (140, 12), (160, 20))
    + bands("cholesterol", (199, 0), (200, 6), (240, 12), (280, 18))
    + [({"smoking": "Current"}, 25), ({"smoking": "Former"}, 8), ({"disease": "Diabetes_Type2"}, 15)]
    + [
        ({"sex": "Male", "age": 70.0, "bp_systolic": 180.0, "cholesterol": 300.0, "smoking": "Current", "disease": "Diabetes_Type2"}, 93),
        ({"disease": None}, None), ({"sex": None}, None),
    ]
)
BURDEN = (
    bands("sleep_hours", (4.9, 20), (5, 12), (5.9, 12), (6, 0), (6.9, 0), (7, 0), (9, 0), (9.1, 8))
    + [({"sleep_hours": s, "stress_level": "Medium"}, p) for s, p in ((6.9, 10), (7.0, 5), (8.0, 5), (8.1, 10))]
    + [({"stress_level": s}, p) for s, p in (("Low", 0), ("Medium", 10), ("High", 20), ("Other", 0))]
    + bands("alcohol_units", (4, 0), (4.1, 4), (7, 4), (7.1, 10), (14, 10), (14.1, 18))
    + [({"activity_level": a}, p) for a, p in (("Sedentary", 20), ("Light", 10), ("Active", 0))]
    + [
        ({"sleep_hours": 4.0, "stress_level": "High", "alcohol_units": 20.0, "activity_level": "Sedentary"}, 78),
        ({"sleep_hours": None}, None), ({"alcohol_units": None}, None),
    ]
)
DIET = [
    ({"disease": "Diabetes_Type2", "bmi": 30.0}, "Low_Carb"),
    ({"disease": "Diabetes_Type2", "bmi": 29.9}, "Mediterranean"),
    ({"glucose": 200.0, "bmi": 25.0}, "Mediterranean"),
    ({"disease": "Heart_Disease", "cholesterol": 240.0}, "Heart_Healthy"),
    ({"disease": "Heart_Disease", "cholesterol": 239.9}, "Mediterranean"),
    ({"sex": "Male", "age": 70.0, "bp_systolic": 160.0, "smoking": "Current"}, "Mediterranean"),
    ({"disease": "Hypertension"}, "DASH"),
    ({"bp_systolic": 140.0}, "DASH"),
    ({"bp_systolic": 139.0}, "Mediterranean"),
    ({"age": 50.0, "bmi": 35.0, "smoking": "Current"}, "Weight_Loss"),
    ({"age": 70.0, "bmi": 30.0, "glucose": 100.0, "smoking": "Current"}, "Low_Carb"),
    ({"age": 70.0, "bmi": 30.0, "smoking": "Current"}, "Mediterranean"),
    ({"disease": "Obesity", "activity_level": "Sedentary"}, "Weight_Loss"),
    ({"disease": "Obesity"}, "Low_Carb"),
    ({"bmi": 30.0}, "Low_Carb"),
    ({"disease": "Anxiety"}, "Anti_Inflammatory"),
    ({"disease": "SleepDisorder"}, "Anti_Inflammatory"),
    ({"stress_level": "High"}, "Anti_Inflammatory"),
    ({"disease": "NutritionalDeficiency"}, "Plant_Based"),
    ({"bmi": 18.4}, "Plant_Based"),
    ({"disease": "Hyperlipidemia"}, "Heart_Healthy"),
    ({"cholesterol": 240.0}, "Heart_Healthy"),
    ({"disease": "Prediabetes"}, "Low_Carb"),
    ({"glucose": 100.0}, "Low_Carb"),
    ({"glucose": 125.9}, "Low_Carb"),
    ({"glucose": 126.0}, "Mediterranean"),
    ({"age": 39.0}, "Balanced"),
    ({"age": 40.0}, "Mediterranean"),
    ({"age": 39.0, "bmi": 25.0}, "Mediterranean"),
    ({"age": 39.0, "smoking": "Current"}, "Mediterranean"),
    ({"bmi": None}, None),
    ({"stress_level": None}, None),
    ({"disease": None}, None),
]
LIFESTYLE = [
    ({"smoking": "Current", "sleep_hours": 4.0}, "Smoking_Cessation"),
    ({"disease": "SleepDisorder"}, "Sleep_Improvement"),
    ({"sleep_hours": 4.9}, "Sleep_Improvement"),
    ({"disease": "Anxiety", "sleep_hours": 5.9}, "Sleep_Improvement"),
    ({"disease": "Anxiety", "sleep_hours": 6.0}, "Stress_Management"),
    ({"stress_level": "High"}, "Stress_Management"),
    ({"alcohol_units": 14.1}, "Alcohol_Reduction"),
    ({"alcohol_units": 14.0}, "Wellness_Focus"),
    ({"activity_level": "Sedentary", "disease": "Obesity"}, "Active_Movement"),
    ({"activity_level": "Sedentary", "sleep_hours": 5.0, "stress_level": "Medium"}, "Active_Movement"),
    ({"activity_level": "Sedentary"}, "Wellness_Focus"),
    ({"disease": "Hypertension", "age": 70.0, "bmi": 35.0, "bp_systolic": 160.0, "glucose": 100.0}, "Preventive_Care"),
    ({"disease": "Hypertension"}, "Active_Movement"),
    ({"activity_level": "Light", "sleep_hours": 5.5, "stress_level": "Medium", "alcohol_units": 5.0}, "Sleep_Improvement"),
    ({"activity_level": "Sedentary", "sleep_hours": 6.6, "stress_level": "Medium", "alcohol_units": 8.0}, "Active_Movement"),
    ({"activity_level": "Sedentary", "sleep_hours": 7.0, "stress_level": "Medium", "alcohol_units": 8.0, "bmi": 22.0}, "Active_Movement"),
    ({"bmi": 30.0}, "Active_Movement"),
    ({"disease": "Prediabetes"}, "Preventive_Care"),
    ({"disease": "Hyperlipidemia"}, "Preventive_Care"),
    ({"age": 49.0}, "Wellness_Focus"),
    ({"age": 50.0}, "Maintenance"),
    ({"age": 49.0, "bmi": 25.0}, "Maintenance"),
    ({"age": 49.0, "bp_systolic": 160.0, "cholesterol": 240.0}, "Maintenance"),
    ({"sleep_hours": None}, None),
    ({"disease": None}, None),
]


@pytest.mark.parametrize(
    ("expression", "cases"),
    [
        (rules.metabolic_risk, METABOLIC), (rules.cardio_risk, CARDIO), (rules.lifestyle_burden, BURDEN),
        (rules.diet_plan, DIET), (rules.lifestyle_plan, LIFESTYLE),
    ],
)
def test_truth_table(spark, expression, cases):
    got, expected = evaluate(spark, expression(), cases)
    wrong = [(c[0], g) for c, g in zip(cases, got, strict=True) if g != c[1]]
    assert not wrong, wrong
    assert len(got) == len(expected)


def test_every_class_is_reachable(patients):
    for column, classes in (("diet_plan", S.DIET_PLANS), ("lifestyle_plan", S.LIFESTYLE_PLANS), ("disease", S.DISEASES)):
        found = {r[0] for r in patients.select(column).distinct().collect()}
        assert found == set(classes)


def test_risk_index_and_bands(spark):
    df = spark.createDataFrame([(0.29999,), (0.3,), (0.59999,), (0.6,), (0.9,), (None,)], "x double")
    got = [tuple(r) for r in df.select(rules.risk_band("x"), rules.risk_alert("x")).collect()]
    assert got == [("Low", False), ("Medium", False), ("Medium", False), ("High", False), ("High", True), (None, None)]
    one = spark.range(1).select(rules.health_risk_index(F.lit(1.0), F.lit(0.1), F.lit(0.2)).alias("i")).first()
    assert one["i"] == pytest.approx(0.5 * 1.0 + 0.3 * 0.2 + 0.2 * 0.1)


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(0, -5.0), (1, 50.0), (2, None), (7, 2.0), (None, 3.0)], "code int, x double")
    got = [tuple(r) for r in df.select(decode(["a", "b", "c"], "code"), clip("x", 0.0, 10.0)).collect()]
    assert got == [("a", 0.0), ("b", 10.0), ("c", None), ("Unknown", 2.0), ("Unknown", 3.0)]
    counts = (
        spark.range(100).select(cumulative_pick(F.col("id"), ["l", "m", "h"], [70, 25, 5]).alias("v"))
        .groupBy("v").count().collect()
    )
    assert {r["v"]: r["count"] for r in counts} == {"l": 70, "m": 25, "h": 5}


def test_ordinal_codes_null_when_unmapped(spark):
    df = spark.createDataFrame([("Male", "High", "Active", "Unknown"), ("Female", None, "Sedentary", "Former")],
                               "sex string, stress_level string, activity_level string, smoking string")
    got = [tuple(r) for r in rules.with_ordinals(df).select("sex_num", "stress_num", "activity_num", "smoking_num").collect()]
    assert got == [(1.0, 2.0, 3.0, None), (0.0, None, 0.0, 1.0)]
