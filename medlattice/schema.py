"""Patient schemas and the fixed value lists every module shares."""

from __future__ import annotations

from pyspark.sql import types as T

NUMERIC = ("age", "bmi", "bp_systolic", "glucose", "cholesterol", "sleep_hours", "alcohol_units")
CATEGORICAL = ("sex", "stress_level", "activity_level", "diet_type", "smoking")

#: task name -> target column
TARGETS = {"disease": "disease", "diet": "diet_plan", "lifestyle": "lifestyle_plan"}

REQUIRED = (
    "age", "sex", "bmi", "bp_systolic", "glucose", "cholesterol", "sleep_hours", "stress_level",
    "activity_level", "diet_type", "smoking", "alcohol_units", "disease", "diet_plan",
    "lifestyle_plan",
)

#: a row without one of these cannot be labelled or trained on and is dropped
CRITICAL = (
    "age", "sex", "bmi", "bp_systolic", "glucose", "cholesterol", "disease", "diet_plan",
    "lifestyle_plan",
)
MEDIAN_FILLED = ("sleep_hours", "alcohol_units")
MODE_FILLED = ("stress_level", "activity_level", "diet_type", "smoking")

# Category levels in their clinical order and class names in alphabetical order.
SEX = ("Female", "Male")
STRESS = ("Low", "Medium", "High")
ACTIVITY = ("Sedentary", "Light", "Moderate", "Active")
DIET_TYPE = ("Western", "Mediterranean", "Asian", "Vegetarian")
SMOKING = ("Never", "Former", "Current")
DISEASES = (
    "Anxiety", "Diabetes_Type2", "Healthy", "Heart_Disease", "Hyperlipidemia", "Hypertension",
    "MetabolicSyndrome", "NutritionalDeficiency", "Obesity", "Prediabetes", "SleepDisorder",
)
DIET_PLANS = (
    "Anti_Inflammatory", "Balanced", "DASH", "Heart_Healthy", "Low_Carb", "Mediterranean",
    "Plant_Based", "Weight_Loss",
)
LIFESTYLE_PLANS = (
    "Active_Movement", "Alcohol_Reduction", "Maintenance", "Preventive_Care",
    "Sleep_Improvement", "Smoking_Cessation", "Stress_Management", "Wellness_Focus",
)
CLASSES = {"disease": DISEASES, "diet": DIET_PLANS, "lifestyle": LIFESTYLE_PLANS}
LEVELS = {
    "sex": SEX, "stress_level": STRESS, "activity_level": ACTIVITY,
    "diet_type": DIET_TYPE, "smoking": SMOKING,
}

# Ordinal codes are positions in the clinical order above.
ORDINAL = {
    "sex": ("sex_num", SEX),
    "stress_level": ("stress_num", STRESS),
    "activity_level": ("activity_num", ACTIVITY),
    "smoking": ("smoking_num", SMOKING),
}
ORDINAL_FEATURES = NUMERIC + tuple(code for code, _ in ORDINAL.values())

# Accepted ranges and choices of the patient intake form.
INTAKE_RANGES = {
    "age": (18, 100),
    "bmi": (15, 50),
    "bp_systolic": (90, 200),
    "glucose": (70, 300),
    "cholesterol": (120, 350),
    "sleep_hours": (3, 12),
    "alcohol_units": (0, 30),
}
INTAKE_CHOICES = {
    "sex": SEX, "stress_level": STRESS, "activity_level": ACTIVITY, "smoking": SMOKING,
}

# Display names used in explanation text.
FEATURE_LABELS = {
    "age": "Age",
    "bmi": "BMI",
    "bp_systolic": "Blood Pressure",
    "glucose": "Glucose",
    "cholesterol": "Cholesterol",
    "sleep_hours": "Sleep Hours",
    "alcohol_units": "Alcohol Consumption",
    "sex_num": "Sex",
    "stress_num": "Stress Level",
    "activity_num": "Activity Level",
    "smoking_num": "Smoking Status",
}


def _field(name: str) -> T.StructField:
    kind = T.DoubleType() if name in NUMERIC else T.StringType()
    return T.StructField(name, kind, True)


#: batch rows; ``patient_id`` is optional in files that never carried one
PATIENT = T.StructType([_field(c) for c in REQUIRED])
PATIENT_WITH_ID = T.StructType([T.StructField("patient_id", T.LongType(), True), *PATIENT.fields])

#: stream rows carry an id and no targets
STREAM = T.StructType(
    [T.StructField("patient_id", T.StringType(), True)]
    + [_field(c) for c in REQUIRED if c not in TARGETS.values()]
)

#: one row per (task, algorithm)
MODEL_RESULTS = T.StructType(
    [
        T.StructField("task", T.StringType()),
        T.StructField("algorithm", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("f1_score", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("training_time_seconds", T.DoubleType()),
        T.StructField("cv_accuracy_mean", T.DoubleType()),
        T.StructField("cv_accuracy_std", T.DoubleType()),
        T.StructField("num_classes", T.IntegerType()),
    ]
)

#: one row per training run
RUN_METADATA = T.StructType(
    [
        T.StructField("train_samples", T.LongType()),
        T.StructField("test_samples", T.LongType()),
        T.StructField("total_samples", T.LongType()),
        T.StructField("features", T.IntegerType()),
        T.StructField("algorithm", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)
