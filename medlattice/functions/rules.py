"""Clinical scores and first-match recommendation rules as Column expressions.

Everything here is a pure expression over columns: it stays inside whole-stage code generation
and works the same on batch and streaming DataFrames. A null input to a score makes the score
null, and a label that depends on it null as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from medlattice.functions.scalar import as_column, clip
from medlattice.schema import ORDINAL

# Points per band, first match wins. Operators read left to right.
METABOLIC_BANDS = {
    "age": ((">", 65, 20), (">", 45, 10)),
    "bmi": ((">=", 35, 20), (">=", 30, 15), (">=", 25, 5)),
    "glucose": ((">=", 200, 20), (">=", 140, 12), (">=", 100, 5)),
    "bp_systolic": ((">=", 160, 15), (">=", 140, 10), (">=", 130, 5)),
    "cholesterol": ((">=", 280, 15), (">=", 240, 10), (">=", 200, 5)),
}
METABOLIC_POINTS = {
    "activity_level": {"Sedentary": 15, "Light": 8, "Moderate": 0, "Active": -5},
    "smoking": {"Never": 0, "Former": 5, "Current": 20},
}
CARDIO_BANDS = {
    "bp_systolic": ((">=", 160, 20), (">=", 140, 12), (">=", 130, 6)),
    "cholesterol": ((">=", 280, 18), (">=", 240, 12), (">=", 200, 6)),
}
CARDIO_AGE_MALE = ((">", 60, 15), (">", 45, 10))
CARDIO_AGE_OTHER = ((">", 65, 15), (">", 55, 10))
CARDIO_SMOKING = {"Never": 0, "Former": 8, "Current": 25}
CARDIO_DIABETES = 15
BURDEN_SLEEP = (("<", 5, 20), ("<", 6, 12), (">", 9, 8))
BURDEN_GOOD_SLEEP = (7, 8, -5)
BURDEN_ALCOHOL = ((">", 14, 18), (">", 7, 10), (">", 4, 4))
BURDEN_POINTS = {
    "stress_level": {"Low": 0, "Medium": 10, "High": 20},
    "activity_level": {"Sedentary": 20, "Light": 10, "Moderate": 0, "Active": -8},
}
HRI_WEIGHTS = {"disease": 0.5, "lifestyle": 0.3, "diet": 0.2}
HRI_BANDS = ((0.3, "Low"), (0.6, "Medium"))
HRI_ALERT_PERCENT = 90

_COMPARE = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
}


def _all_present(columns: Sequence[Column]) -> Column:
    return reduce(and_, [c.isNotNull() for c in columns])


def _banded(value: Column, bands) -> Column:
    chain = F
    for op, bound, points in bands:
        chain = chain.when(_COMPARE[op](value, F.lit(bound)), F.lit(points))
    return chain.otherwise(F.lit(0))


def _by_level(value: Column, points: dict[str, int]) -> Column:
    chain = F
    for level, score in points.items():
        chain = chain.when(value == level, F.lit(score))
    return chain.otherwise(F.lit(0))


def _cascade(rules: Sequence[tuple[Column, str | Column]], default: str | Column) -> Column:
    """First match wins; an outcome may be a cascade of its own, so that a shared condition is
    tested once per row."""
    chain = F
    for condition, outcome in rules:
        chain = chain.when(condition, F.lit(outcome))
    return chain.otherwise(F.lit(default))


def metabolic_risk(
    age="age", bmi="bmi", glucose="glucose", bp_systolic="bp_systolic",
    cholesterol="cholesterol", activity_level="activity_level", smoking="smoking",
) -> Column:
    """Metabolic risk: sum of seven banded terms, capped at 100, no floor (minimum -5)."""
    inputs = {
        "age": age, "bmi": bmi, "glucose": glucose, "bp_systolic": bp_systolic,
        "cholesterol": cholesterol, "activity_level": activity_level, "smoking": smoking,
    }
    inputs = {k: as_column(v) for k, v in inputs.items()}
    terms = [_banded(inputs[c], bands) for c, bands in METABOLIC_BANDS.items()]
    terms += [_by_level(inputs[c], points) for c, points in METABOLIC_POINTS.items()]
    score = F.least(reduce(add, terms), F.lit(100))
    return F.when(_all_present(list(inputs.values())), score)


def cardio_risk(
    age="age", sex="sex", bp_systolic="bp_systolic", cholesterol="cholesterol",
    smoking="smoking", disease="disease",
) -> Column:
    """Cardiovascular risk with sex-dependent age bands and a diabetes surcharge."""
    age, sex, bp, chol, smoking, disease = map(
        as_column, (age, sex, bp_systolic, cholesterol, smoking, disease)
    )
    terms = [
        F.when(sex == "Male", _banded(age, CARDIO_AGE_MALE)).otherwise(_banded(age, CARDIO_AGE_OTHER)),
        _banded(bp, CARDIO_BANDS["bp_systolic"]),
        _banded(chol, CARDIO_BANDS["cholesterol"]),
        _by_level(smoking, CARDIO_SMOKING),
        _by_level(disease, {"Diabetes_Type2": CARDIO_DIABETES}),
    ]
    score = F.least(reduce(add, terms), F.lit(100))
    return F.when(_all_present([age, sex, bp, chol, smoking, disease]), score)


def lifestyle_burden(
    sleep_hours="sleep_hours", stress_level="stress_level", alcohol_units="alcohol_units",
    activity_level="activity_level",
) -> Column:
    """Lifestyle burden: U-shaped sleep term, stress, alcohol and activity; never below 0."""
    sleep, stress, alcohol, activity = map(
        as_column, (sleep_hours, stress_level, alcohol_units, activity_level)
    )
    low, high, points = BURDEN_GOOD_SLEEP
    good_sleep = F.when(sleep.between(low, high), F.lit(points)).otherwise(F.lit(0))
    terms = [
        _banded(sleep, BURDEN_SLEEP) + good_sleep,
        _by_level(stress, BURDEN_POINTS["stress_level"]),
        _banded(alcohol, BURDEN_ALCOHOL),
        _by_level(activity, BURDEN_POINTS["activity_level"]),
    ]
    score = F.greatest(reduce(add, terms), F.lit(0))
    return F.when(_all_present([sleep, stress, alcohol, activity]), score)


def diet_plan(metabolic: Column | None = None, cardio: Column | None = None) -> Column:
    """Recommended diet: the first clinical priority that applies.

    Pass ``metabolic`` / ``cardio`` when the scores are already columns of the table.
    """
    metabolic = metabolic_risk() if metabolic is None else metabolic
    cardio = cardio_risk() if cardio is None else cardio
    c = F.col
    is_disease = c("disease").isin
    diabetic = is_disease("Diabetes_Type2") | (c("glucose") >= 200)
    cardiac = is_disease("Heart_Disease") | (cardio >= 60)
    obese = is_disease("Obesity") | (c("bmi") >= 30)
    default = _cascade([((c("age") < 40) & (c("bmi") < 25) & (metabolic < 20), "Balanced")], "Mediterranean")
    rules = [
        (diabetic, _cascade([(c("bmi") >= 30, "Low_Carb")], "Mediterranean")),
        (cardiac, _cascade([(c("cholesterol") >= 240, "Heart_Healthy")], "Mediterranean")),
        (is_disease("Hypertension") | (c("bp_systolic") >= 140), "DASH"),
        (
            metabolic >= 50,
            _cascade([(c("bmi") >= 35, "Weight_Loss"), (c("glucose") >= 100, "Low_Carb")], "Mediterranean"),
        ),
        (obese, _cascade([(c("activity_level") == "Sedentary", "Weight_Loss")], "Low_Carb")),
        (is_disease("Anxiety", "SleepDisorder") | (c("stress_level") == "High"), "Anti_Inflammatory"),
        (is_disease("NutritionalDeficiency") | (c("bmi") < 18.5), "Plant_Based"),
        (is_disease("Hyperlipidemia") | (c("cholesterol") >= 240), "Heart_Healthy"),
        (is_disease("Prediabetes") | ((c("glucose") >= 100) & (c("glucose") < 126)), "Low_Carb"),
    ]
    needed = [metabolic, cardio, c("stress_level")]
    return F.when(_all_present(needed), _cascade(rules, default))


def lifestyle_plan(metabolic: Column | None = None, burden: Column | None = None) -> Column:
    """Recommended lifestyle intervention: the first priority that applies.

    High stress always matches the stress rule, so the burden rule needs no stress branch.
    """
    metabolic = metabolic_risk() if metabolic is None else metabolic
    burden = lifestyle_burden() if burden is None else burden
    c = F.col
    is_disease = c("disease").isin
    stressed = is_disease("Anxiety") | (c("stress_level") == "High")
    needs_movement = is_disease("Obesity", "Diabetes_Type2", "Heart_Disease") | (burden >= 40)
    chronic = is_disease("Diabetes_Type2", "Heart_Disease", "Hypertension", "MetabolicSyndrome")
    default = _cascade([((c("age") < 50) & (c("bmi") < 25) & (metabolic < 25), "Wellness_Focus")], "Maintenance")
    rules = [
        (c("smoking") == "Current", "Smoking_Cessation"),
        (is_disease("SleepDisorder") | (c("sleep_hours") < 5), "Sleep_Improvement"),
        (stressed, _cascade([(c("sleep_hours") < 6, "Sleep_Improvement")], "Stress_Management")),
        (c("alcohol_units") > 14, "Alcohol_Reduction"),
        ((c("activity_level") == "Sedentary") & needs_movement, "Active_Movement"),
        (chronic, _cascade([(metabolic >= 60, "Preventive_Care")], "Active_Movement")),
        (burden >= 35, _cascade([(c("sleep_hours") < 6.5, "Sleep_Improvement")], "Active_Movement")),
        (is_disease("Obesity") | (c("bmi") >= 30), "Active_Movement"),
        (is_disease("Prediabetes", "Hyperlipidemia"), "Preventive_Care"),
    ]
    needed = [metabolic, burden, c("disease")]
    return F.when(_all_present(needed), _cascade(rules, default))


def with_scores(df):
    """Append the three scores; the two label rules read them instead of recomputing."""
    return df.withColumns(
        {
            "metabolic_risk": metabolic_risk(),
            "cardio_risk": cardio_risk(),
            "lifestyle_burden": lifestyle_burden(),
        }
    )


def with_plans(df):
    """Append scores and both recommended plans."""
    scored = with_scores(df)
    return scored.withColumns(
        {
            "diet_plan": diet_plan(F.col("metabolic_risk"), F.col("cardio_risk")),
            "lifestyle_plan": lifestyle_plan(F.col("metabolic_risk"), F.col("lifestyle_burden")),
        }
    )


def health_risk_index(disease, diet, lifestyle) -> Column:
    """Weighted index of three risks in [0, 1]: 0.5 disease, 0.3 lifestyle, 0.2 diet."""
    return (
        F.lit(HRI_WEIGHTS["disease"]) * as_column(disease)
        + F.lit(HRI_WEIGHTS["lifestyle"]) * as_column(lifestyle)
        + F.lit(HRI_WEIGHTS["diet"]) * as_column(diet)
    )


def score_as_risk(score) -> Column:
    """A 0-100 score as a risk in [0, 1]; our stand-in for the diet and lifestyle risks."""
    return clip(as_column(score) / F.lit(100.0), 0.0, 1.0)


def risk_band(index) -> Column:
    """Low / Medium / High band of a health risk index; null stays null."""
    index = as_column(index)
    chain = F.when(index.isNull(), F.lit(None).cast("string"))
    for bound, label in HRI_BANDS:
        chain = chain.when(index < bound, F.lit(label))
    return chain.otherwise(F.lit("High"))


def risk_percent(index) -> Column:
    return as_column(index) * F.lit(100.0)


def risk_alert(index) -> Column:
    """True from 90 percent upwards."""
    return risk_percent(index) >= HRI_ALERT_PERCENT


def ordinal_code(column: str) -> Column:
    """Position of a level in its clinical order as double, null when unmapped."""
    _, levels = ORDINAL[column]
    chain = F
    for code, level in enumerate(levels):
        chain = chain.when(F.col(column) == level, F.lit(float(code)))
    return chain.otherwise(F.lit(None).cast("double"))


def with_ordinals(df):
    """Append the four ordinal feature columns."""
    return df.withColumns({code: ordinal_code(source) for source, (code, _) in ORDINAL.items()})
