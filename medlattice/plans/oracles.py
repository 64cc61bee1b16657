"""Independent SQL for the registered queries, written for a plain ANSI engine.

The patient table is spelled out as one common table expression; nothing here is shared with
the Spark expressions except the profile values and the draw constants.
"""

from __future__ import annotations

from medlattice import schema as S
from medlattice.plans.dataset import (
    ALGORITHM_SKILL,
    DRAWS,
    FALLBACK_CLASS,
    PROBABILITY_DRAWS,
    contribution_draw,
)
from medlattice.plans.profiles import PROFILES


def h(p: int, q: int, key: str = "k") -> str:
    return f"((({key} % 1000003) * {p} + {q}) % 1000003)"


def mix(key: str, seed: int) -> str:
    m = 2147483647
    first = f"((({key} % {m}) * 48271 + {seed * 16807 + 11}) % {m})"
    second = f"(({first} * {first} + {first} * 3 + {seed}) % {m})"
    return f"(({second} * 69621 + 7) % {m})"


def _profile_rows() -> str:
    rows, low = [], 0
    for p in PROFILES:
        t = [low, low + p.weight, f"'{p.disease}'"]
        t += [int(p.age.low), int(p.age.high)]
        t += [round(p.bmi.low * 10), round(p.bmi.high * 10), int(p.bp_systolic.low), int(p.bp_systolic.high)]
        for d in (p.glucose, p.cholesterol, p.sleep_hours):
            t += [round(d.low * 10), round(d.high * 10)]
        t += [p.stress[0], p.stress[0] + p.stress[1]]
        t += [p.activity[0], sum(p.activity[:2]), sum(p.activity[:3])]
        t += [p.smoking[0], p.smoking[0] + p.smoking[1], round(p.alcohol[0] * 10)]
        rows.append("(" + ", ".join(str(v) for v in t) + ")")
        low += p.weight
    return ",\n    ".join(rows)


_D = {name: h(*draw) for name, draw in DRAWS.items()}

PATIENTS = f"""profile(w_lo, w_hi, disease, age_lo, age_hi, bmi_lo, bmi_hi, bp_lo, bp_hi, glu_lo, glu_hi,
    cho_lo, cho_hi, slp_lo, slp_hi, st1, st2, ac1, ac2, ac3, sm1, sm2, alc) AS (VALUES
    {_profile_rows()}),
base AS (
  SELECT k AS patient_id, p.disease,
    CAST(age_lo + {_D['age']} % (age_hi - age_lo + 1) AS DOUBLE) AS age,
    CASE WHEN {_D['sex']} % 2 = 0 THEN 'Male' ELSE 'Female' END AS sex,
    CAST(bmi_lo + {_D['bmi']} % (bmi_hi - bmi_lo + 1) AS DOUBLE) / 10 AS bmi,
    CAST(bp_lo + {_D['bp_systolic']} % (bp_hi - bp_lo + 1) AS DOUBLE) AS bp_systolic,
    CAST(glu_lo + {_D['glucose']} % (glu_hi - glu_lo + 1) AS DOUBLE) / 10 AS glucose,
    CAST(cho_lo + {_D['cholesterol']} % (cho_hi - cho_lo + 1) AS DOUBLE) / 10 AS cholesterol,
    CAST(slp_lo + {_D['sleep_hours']} % (slp_hi - slp_lo + 1) AS DOUBLE) / 10 AS sleep_hours,
    CASE WHEN {_D['stress_level']} % 100 < st1 THEN 'Low' WHEN {_D['stress_level']} % 100 < st2 THEN 'Medium' ELSE 'High' END AS stress_level,
    CASE WHEN {_D['activity_level']} % 100 < ac1 THEN 'Sedentary' WHEN {_D['activity_level']} % 100 < ac2 THEN 'Light'
         WHEN {_D['activity_level']} % 100 < ac3 THEN 'Moderate' ELSE 'Active' END AS activity_level,
    CASE WHEN {_D['diet_type']} % 100 < 40 THEN 'Western' WHEN {_D['diet_type']} % 100 < 65 THEN 'Mediterranean'
         WHEN {_D['diet_type']} % 100 < 85 THEN 'Asian' ELSE 'Vegetarian' END AS diet_type,
    CASE WHEN {_D['smoking']} % 100 < sm1 THEN 'Never' WHEN {_D['smoking']} % 100 < sm2 THEN 'Former' ELSE 'Current' END AS smoking,
    CAST({_D['alcohol_units']} % (4 * alc + 1) AS DOUBLE) / 10 AS alcohol_units
  FROM (SELECT CAST(c_custkey AS BIGINT) AS k FROM customer) c
  JOIN profile p ON {_D['disease']} % 100 >= w_lo AND {_D['disease']} % 100 < w_hi),
scores AS (
  SELECT *,
    LEAST(CASE WHEN age > 65 THEN 20 WHEN age > 45 THEN 10 ELSE 0 END
      + CASE WHEN bmi >= 35 THEN 20 WHEN bmi >= 30 THEN 15 WHEN bmi >= 25 THEN 5 ELSE 0 END
      + CASE WHEN glucose >= 200 THEN 20 WHEN glucose >= 140 THEN 12 WHEN glucose >= 100 THEN 5 ELSE 0 END
      + CASE WHEN bp_systolic >= 160 THEN 15 WHEN bp_systolic >= 140 THEN 10 WHEN bp_systolic >= 130 THEN 5 ELSE 0 END
      + CASE WHEN cholesterol >= 280 THEN 15 WHEN cholesterol >= 240 THEN 10 WHEN cholesterol >= 200 THEN 5 ELSE 0 END
      + CASE activity_level WHEN 'Sedentary' THEN 15 WHEN 'Light' THEN 8 WHEN 'Active' THEN -5 ELSE 0 END
      + CASE smoking WHEN 'Current' THEN 20 WHEN 'Former' THEN 5 ELSE 0 END, 100) AS metabolic_risk,
    LEAST(CASE WHEN sex = 'Male' THEN CASE WHEN age > 60 THEN 15 WHEN age > 45 THEN 10 ELSE 0 END
               ELSE CASE WHEN age > 65 THEN 15 WHEN age > 55 THEN 10 ELSE 0 END END
      + CASE WHEN bp_systolic >= 160 THEN 20 WHEN bp_systolic >= 140 THEN 12 WHEN bp_systolic >= 130 THEN 6 ELSE 0 END
      + CASE WHEN cholesterol >= 280 THEN 18 WHEN cholesterol >= 240 THEN 12 WHEN cholesterol >= 200 THEN 6 ELSE 0 END
      + CASE smoking WHEN 'Current' THEN 25 WHEN 'Former' THEN 8 ELSE 0 END
      + CASE WHEN disease = 'Diabetes_Type2' THEN 15 ELSE 0 END, 100) AS cardio_risk,
    GREATEST(CASE WHEN sleep_hours < 5 THEN 20 WHEN sleep_hours < 6 THEN 12 WHEN sleep_hours > 9 THEN 8
                  WHEN sleep_hours >= 7 AND sleep_hours <= 8 THEN -5 ELSE 0 END
      + CASE stress_level WHEN 'High' THEN 20 WHEN 'Medium' THEN 10 ELSE 0 END
      + CASE WHEN alcohol_units > 14 THEN 18 WHEN alcohol_units > 7 THEN 10 WHEN alcohol_units > 4 THEN 4 ELSE 0 END
      + CASE activity_level WHEN 'Sedentary' THEN 20 WHEN 'Light' THEN 10 WHEN 'Active' THEN -8 ELSE 0 END, 0) AS lifestyle_burden
  FROM base),
patients AS (
  SELECT *,
    CASE
      WHEN disease = 'Diabetes_Type2' OR glucose >= 200 THEN CASE WHEN bmi >= 30 THEN 'Low_Carb' ELSE 'Mediterranean' END
      WHEN disease = 'Heart_Disease' OR cardio_risk >= 60 THEN CASE WHEN cholesterol >= 240 THEN 'Heart_Healthy' ELSE 'Mediterranean' END
      WHEN disease = 'Hypertension' OR bp_systolic >= 140 THEN 'DASH'
      WHEN metabolic_risk >= 50 THEN CASE WHEN bmi >= 35 THEN 'Weight_Loss' WHEN glucose >= 100 THEN 'Low_Carb' ELSE 'Mediterranean' END
      WHEN disease = 'Obesity' OR bmi >= 30 THEN CASE WHEN activity_level = 'Sedentary' THEN 'Weight_Loss' ELSE 'Low_Carb' END
      WHEN disease IN ('Anxiety', 'SleepDisorder') OR stress_level = 'High' THEN 'Anti_Inflammatory'
      WHEN disease = 'NutritionalDeficiency' OR bmi < 18.5 THEN 'Plant_Based'
      WHEN disease = 'Hyperlipidemia' OR cholesterol >= 240 THEN 'Heart_Healthy'
      WHEN disease = 'Prediabetes' OR (glucose >= 100 AND glucose < 126) THEN 'Low_Carb'
      WHEN age < 40 AND bmi < 25 AND metabolic_risk < 20 THEN 'Balanced' ELSE 'Mediterranean' END AS diet_plan,
    CASE
      WHEN smoking = 'Current' THEN 'Smoking_Cessation'
      WHEN disease = 'SleepDisorder' OR sleep_hours < 5 THEN 'Sleep_Improvement'
      WHEN disease = 'Anxiety' OR stress_level = 'High' THEN CASE WHEN sleep_hours < 6 THEN 'Sleep_Improvement' ELSE 'Stress_Management' END
      WHEN alcohol_units > 14 THEN 'Alcohol_Reduction'
      WHEN activity_level = 'Sedentary' AND (disease IN ('Obesity', 'Diabetes_Type2', 'Heart_Disease') OR lifestyle_burden >= 40) THEN 'Active_Movement'
      WHEN disease IN ('Diabetes_Type2', 'Heart_Disease', 'Hypertension', 'MetabolicSyndrome')
        THEN CASE WHEN metabolic_risk >= 60 THEN 'Preventive_Care' ELSE 'Active_Movement' END
      WHEN lifestyle_burden >= 35 THEN CASE WHEN sleep_hours < 6.5 THEN 'Sleep_Improvement' ELSE 'Active_Movement' END
      WHEN disease = 'Obesity' OR bmi >= 30 THEN 'Active_Movement'
      WHEN disease IN ('Prediabetes', 'Hyperlipidemia') THEN 'Preventive_Care'
      WHEN age < 50 AND bmi < 25 AND metabolic_risk < 25 THEN 'Wellness_Focus' ELSE 'Maintenance' END AS lifestyle_plan
  FROM scores)"""

DIRTY = """dirty AS (
  SELECT patient_id, age, sex,
    CASE WHEN patient_id % 101 = 0 THEN NULL WHEN patient_id % 97 = 0 THEN -1.0 ELSE bmi END AS bmi,
    bp_systolic, glucose, cholesterol,
    CASE WHEN patient_id % 37 = 0 THEN NULL ELSE sleep_hours END AS sleep_hours,
    CASE WHEN patient_id % 43 = 0 THEN NULL ELSE stress_level END AS stress_level,
    activity_level, diet_type,
    CASE WHEN patient_id % 89 = 0 THEN 'Unknown' ELSE smoking END AS smoking,
    CASE WHEN patient_id % 41 = 0 THEN NULL ELSE alcohol_units END AS alcohol_units,
    disease, diet_plan, lifestyle_plan
  FROM patients)"""

PREDICTIONS = """predictions AS (
  SELECT patient_id, diet_plan AS label,
    CASE WHEN patient_id % 10 < 8 THEN diet_plan ELSE 'Mediterranean' END AS prediction
  FROM patients)"""

GROUPED = "grouped AS (SELECT *, CAST(patient_id % 5 AS INTEGER) AS cluster FROM patients)"

_COLS = ", ".join(S.REQUIRED)
_NUM7 = list(S.NUMERIC)


def with_patients(select: str, *extra: str) -> str:
    return "WITH " + ",\n".join([PATIENTS, *extra]) + "\n" + select


def _class_counts(source: str) -> str:
    """Per-class counts of a (grp, label, prediction) relation."""
    return f"""cells AS (SELECT grp, label, prediction, COUNT(*) AS n FROM {source} GROUP BY grp, label, prediction),
sides AS (SELECT grp, label AS class, n AS support, 0 AS predicted, CASE WHEN label = prediction THEN n ELSE 0 END AS tp FROM cells
  UNION ALL SELECT grp, prediction, 0, n, 0 FROM cells),
classes AS (SELECT grp, class, SUM(support) AS support, SUM(predicted) AS predicted, SUM(tp) AS tp FROM sides GROUP BY grp, class),
class_scores AS (SELECT *,
    CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0 END AS pr,
    CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0 END AS rc,
    2.0 * CAST(tp AS DOUBLE) / (predicted + support) AS f1 FROM classes),
metrics AS (SELECT grp, CAST(SUM(support) AS BIGINT) AS n, CAST(SUM(tp) AS DOUBLE) / SUM(support) AS accuracy,
    SUM(support * pr) / SUM(support) AS "precision", SUM(support * rc) / SUM(support) AS recall,
    SUM(support * f1) / SUM(support) AS f1_score, COUNT(*) FILTER (WHERE support > 0) AS num_classes
  FROM class_scores GROUP BY grp)"""


def _grid() -> str:
    """model_results of the stand-in predictions."""
    rows = []
    for t, task in enumerate(S.TARGETS):
        for a, (algorithm, (skill, cost)) in enumerate(ALGORITHM_SKILL.items()):
            chance = f"({mix('patient_id', 1000 + 10 * t + a)} % 100)"
            rows.append(
                f"SELECT '{task}|{algorithm}' AS grp, {S.TARGETS[task]} AS label, CASE WHEN {chance} < {skill - 2 * t} "
                f"THEN {S.TARGETS[task]} ELSE '{FALLBACK_CLASS[task]}' END AS prediction, {cost * (t + 1)} + {chance} % 5 AS cost_ms FROM patients"
            )
    return f"""scored AS ({' UNION ALL '.join(rows)}),
{_class_counts('scored')},
costs AS (SELECT grp, SUM(cost_ms) / 1000.0 AS training_time_seconds FROM scored GROUP BY grp),
model_results AS (SELECT split_part(grp, '|', 1) AS task, split_part(grp, '|', 2) AS algorithm, accuracy, f1_score, "precision", recall,
    CAST(training_time_seconds AS DOUBLE) AS training_time_seconds, CAST(num_classes AS INTEGER) AS num_classes
  FROM metrics JOIN costs USING (grp))"""


_R4 = ", ".join(f'round({c}, 6) AS {c}' for c in ("accuracy", "f1_score", '"precision"', "recall"))


def _unpivot(source: str, columns, by: str = "", cast: str = "") -> str:
    pre = f"{by}, " if by else ""
    return " UNION ALL ".join(
        f"SELECT {pre}'{c}' AS \"column\", {f'CAST({c} AS {cast})' if cast else c} AS value FROM {source}" for c in columns
    )


def _scaled(source: str, columns, deviation: str, key: str, where: str = "") -> str:
    cols = ", ".join(
        f"round((s.{c} - avg_{c}) / sd_{c}, 6) + 0.0 AS {c}_scaled" for c in columns
    )
    stats = ", ".join(f"avg({c}) AS avg_{c}, {deviation}({c}) AS sd_{c}" for c in columns)
    return f"SELECT {key}, {cols} FROM {source} s CROSS JOIN (SELECT {stats} FROM {source}) st"


def _hist(source: str, column: str, bins: int) -> str:
    return f"""span AS (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {source}),
counted AS (SELECT CAST(CASE WHEN hi > lo THEN LEAST(floor(({column} - lo) / ((hi - lo) / {bins})), {bins - 1}) ELSE 0 END AS INTEGER) AS bin, COUNT(*) AS n
  FROM {source} CROSS JOIN span WHERE {column} IS NOT NULL GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * ((hi - lo) / {bins}), 6) AS low, round(lo + (b.bin + 1) * ((hi - lo) / {bins}), 6) AS high,
  COALESCE(n, 0) AS n
FROM (SELECT unnest(range({bins})) AS bin) b CROSS JOIN span LEFT JOIN counted c ON c.bin = b.bin"""


def _box(source: str, by: str, columns) -> str:
    return f"""long AS ({_unpivot(source, columns, by, 'DOUBLE')}),
q AS (SELECT {by}, "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
  FROM long WHERE value IS NOT NULL GROUP BY {by}, "column")
SELECT q.{by}, q."column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(value), 6) AS whisker_low, round(max(value), 6) AS whisker_high
FROM q JOIN long l ON l.{by} = q.{by} AND l."column" = q."column"
WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
GROUP BY q.{by}, q."column", q1, median, q3"""


def _corr(source: str, columns) -> str:
    rows = []
    for a in columns:
        for b in columns:
            value = "1.0" if a == b else f"round(corr({a}, {b}), 6) + 0.0"
            rows.append(f"SELECT '{a}' AS x, '{b}' AS y, CAST({value} AS DOUBLE) AS corr FROM {source}")
            if a == b:
                rows[-1] += " LIMIT 1"
                rows[-1] = f"({rows[-1]})"
    return " UNION ALL ".join(rows)


def _probabilities() -> str:
    w = [f"CAST(1 + {h(*d, key='patient_id')} % 97 AS DOUBLE)" for d in PROBABILITY_DRAWS]
    return f"""weights AS (SELECT patient_id, metabolic_risk, lifestyle_burden, {', '.join(f'{e} AS w{i}' for i, e in enumerate(w))} FROM patients),
probs AS (SELECT patient_id, metabolic_risk, lifestyle_burden, {', '.join(f'w{i} / (w0 + w1 + w2 + w3) AS p{i}' for i in range(4))} FROM weights),
long_probs AS ({' UNION ALL '.join(f'SELECT patient_id, {i} AS class, p{i} AS probability FROM probs' for i in range(4))}),
ranked_probs AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY probability DESC, class) AS rank FROM long_probs),
hri AS (SELECT patient_id, 0.5 * (1 - p0) + 0.3 * LEAST(GREATEST(lifestyle_burden / 100.0, 0), 1)
    + 0.2 * LEAST(GREATEST(metabolic_risk / 100.0, 0), 1) AS hri FROM probs)"""


def _contributions() -> str:
    rows = " UNION ALL ".join(
        f"SELECT CAST(c_custkey AS BIGINT) AS patient_id, '{name}' AS feature, CAST({h(*contribution_draw(i), key='c_custkey')} % 2001 - 1000 AS DOUBLE) / 1000.0 AS value FROM customer"
        for i, name in enumerate(S.ORDINAL_FEATURES)
    )
    return f"""contributions AS ({rows}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY abs(value) DESC, feature) AS rank FROM contributions)"""


def _mode(column: str, source: str = "dirty") -> str:
    return f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"


def _complete() -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in S.CRITICAL)


def _one_hot(unknown: str = "") -> str:
    parts = []
    for c in S.CATEGORICAL:
        for level in sorted(S.LEVELS[c]):
            parts.append(f"CASE WHEN {c} = '{level}' THEN 1 ELSE 0 END AS {c}_{level}")
    return ", ".join(parts)


def _domain(source: str) -> str:
    checks = [(c, f"COALESCE({c} BETWEEN {lo} AND {hi}, FALSE)") for c, (lo, hi) in S.INTAKE_RANGES.items()]
    checks += [
        (c, "COALESCE(" + f"{c} IN (" + ", ".join(f"'{v}'" for v in levels) + "), FALSE)")
        for c, levels in S.INTAKE_CHOICES.items()
    ]
    failed = ", ".join(f"CASE WHEN NOT {test} THEN '{c}' END" for c, test in checks)
    ok = " AND ".join(test for _, test in checks)
    return f"""SELECT patient_id, concat_ws(',', {failed}) AS failed_rules,
  CASE WHEN {ok} THEN 'accepted' ELSE 'rejected' END AS verdict FROM {source}"""


_LEVEL_ROWS = {c: sorted(S.LEVELS[c]) for c in S.CATEGORICAL}
_STREAM_COLS = [f.name for f in S.STREAM.fields]
_ORD = ", ".join(
    f"CASE {c} " + " ".join(f"WHEN '{v}' THEN CAST({i} AS DOUBLE)" for i, v in enumerate(levels)) + f" END AS {code}"
    for c, (code, levels) in S.ORDINAL.items()
)
LINEITEM_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
CENTROIDS = ((35.0, 22.0, 85.0), (55.0, 29.0, 110.0), (65.0, 36.0, 190.0))
LINEAR_COEFFICIENTS = {
    "age": 0.02, "bmi": 0.05, "bp_systolic": 0.01, "glucose": 0.015, "cholesterol": 0.004, "sleep_hours": -0.1, "alcohol_units": 0.03,
}


def _shapley_toy() -> str:
    """Two-feature Shapley values in closed form over a tree whose covers come from the data.

    root: bmi <= 30; left child: glucose <= 120. Value of a leaf: share of Healthy rows.
    """
    return """leaf AS (SELECT
    CAST(COUNT(*) FILTER (WHERE bmi <= 30) AS DOUBLE) / COUNT(*) AS wl,
    CAST(COUNT(*) FILTER (WHERE bmi <= 30 AND glucose <= 120) AS DOUBLE) / COUNT(*) FILTER (WHERE bmi <= 30) AS wll,
    CAST(COUNT(*) FILTER (WHERE bmi <= 30 AND glucose <= 120 AND disease = 'Healthy') AS DOUBLE) / COUNT(*) FILTER (WHERE bmi <= 30 AND glucose <= 120) AS a,
    CAST(COUNT(*) FILTER (WHERE bmi <= 30 AND glucose > 120 AND disease = 'Healthy') AS DOUBLE) / COUNT(*) FILTER (WHERE bmi <= 30 AND glucose > 120) AS b,
    CAST(COUNT(*) FILTER (WHERE bmi > 30 AND disease = 'Healthy') AS DOUBLE) / COUNT(*) FILTER (WHERE bmi > 30) AS c
  FROM patients),
game AS (SELECT patient_id,
    wl * (wll * a + (1 - wll) * b) + (1 - wl) * c AS v0,
    CASE WHEN bmi <= 30 THEN wll * a + (1 - wll) * b ELSE c END AS v_bmi,
    wl * (CASE WHEN glucose <= 120 THEN a ELSE b END) + (1 - wl) * c AS v_glu,
    CASE WHEN bmi <= 30 THEN (CASE WHEN glucose <= 120 THEN a ELSE b END) ELSE c END AS v_both
  FROM patients CROSS JOIN leaf)
SELECT patient_id, round(v0, 6) AS base_value, round(v_both, 6) AS explained_value,
  round(0.5 * ((v_bmi - v0) + (v_both - v_glu)), 6) + 0.0 AS bmi, round(0.5 * ((v_glu - v0) + (v_both - v_bmi)), 6) + 0.0 AS glucose
FROM game"""


def oracle_sql() -> dict[str, str]:
    p = with_patients
    grid = _grid()
    probs, contrib = _probabilities(), _contributions()
    order_hash = mix("patient_id", 42)
    out: dict[str, str] = {}

    # sources
    out["csv_roundtrip"] = out["parquet_roundtrip"] = p(f"SELECT patient_id, {_COLS} FROM patients")
    out["results_long"] = p(f"SELECT task, algorithm, {_R4}, round(training_time_seconds, 3) AS training_time_seconds FROM model_results", grid)
    out["results_default_zero"] = p(
        f"""SELECT t.task, {', '.join(f'round(COALESCE({c}, 0.0), 6) AS {c}' for c in ('accuracy', 'f1_score', '"precision"', 'recall'))}
FROM (VALUES ('disease'), ('diet'), ('lifestyle')) t(task)
LEFT JOIN (SELECT * FROM model_results WHERE algorithm = 'RandomForest' AND task <> 'diet') r ON r.task = t.task""", grid)

    # projection and cleaning
    out["project_patients"] = p("SELECT age, sex, bmi, bp_systolic, glucose, cholesterol, disease, diet_plan, lifestyle_plan FROM patients")
    out["null_profile"] = p(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM dirty" for c in S.REQUIRED), DIRTY)
    out["drop_critical_nulls"] = p(f"SELECT patient_id, {_COLS} FROM dirty WHERE {_complete()}", DIRTY)
    out["impute_median"] = p(
        """SELECT patient_id, round(COALESCE(sleep_hours, (SELECT median(sleep_hours) FROM dirty)), 6) AS sleep_hours,
  round(COALESCE(alcohol_units, (SELECT median(alcohol_units) FROM dirty)), 6) AS alcohol_units FROM dirty""", DIRTY)
    out["median_at_volume"] = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(median({c}), 6) AS median FROM lineitem" for c in LINEITEM_MEASURES)
    out["impute_mean"] = p("SELECT patient_id, " + ", ".join(
        f"round(COALESCE({c}, (SELECT avg({c}) FROM dirty)), 6) AS {c}" for c in _NUM7) + " FROM dirty", DIRTY)
    out["impute_mode"] = p("SELECT patient_id, " + ", ".join(
        f"COALESCE({c}, {_mode(c)}) AS {c}" for c in S.MODE_FILLED) + " FROM dirty", DIRTY)
    out["cast_numeric"] = p(
        """SELECT patient_id, CAST(age AS DOUBLE) AS age, CASE WHEN patient_id % 53 = 0 THEN NULL ELSE bmi END AS bmi,
  CASE WHEN patient_id % 53 = 0 AND bmi IS NOT NULL THEN 1 ELSE 0 END AS cast_failures FROM dirty""", DIRTY)
    out["retention_report"] = p(
        f"""SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE {_complete()}) AS rows_after, CAST(16 AS BIGINT) AS columns,
  round(100.0 * COUNT(*) FILTER (WHERE {_complete()}) / COUNT(*), 4) AS percent_kept,
  COUNT(*) FILTER (WHERE {_complete()}) < 1000 AS below_minimum FROM dirty""", DIRTY)
    filled = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in S.REQUIRED)
    out["completeness"] = p(
        f"SELECT CAST(SUM({filled}) AS BIGINT) AS filled_cells, round(100.0 * SUM({filled}) / (COUNT(*) * 15), 4) AS completeness_pct FROM dirty", DIRTY)
    out["seeded_shuffle"] = p(f"SELECT patient_id, disease, row_number() OVER (ORDER BY {order_hash}, patient_id) AS position FROM patients")
    out["sample_n"] = p(f"SELECT patient_id, age, disease FROM patients ORDER BY {order_hash}, patient_id LIMIT 1000")
    out["preview_n"] = p("SELECT patient_id, age, sex, bmi, bp_systolic, glucose, cholesterol, disease, diet_plan, lifestyle_plan FROM patients ORDER BY patient_id LIMIT 100")
    out["clip_bounds"] = p(
        """SELECT patient_id, CASE WHEN bmi IS NULL THEN NULL ELSE LEAST(GREATEST(bmi, 18.5), 35.0) END AS bmi,
  CASE WHEN alcohol_units IS NULL THEN NULL ELSE LEAST(GREATEST(alcohol_units, 1.0), 10.0) END AS alcohol_units FROM dirty""", DIRTY)
    out["round_values"] = "SELECT o_orderkey, round(o_totalprice * 0.7310585, 1) AS price_1dp FROM orders"
    out["domain_check"] = p(_domain("dirty"), DIRTY)

    # rules
    out["metabolic_risk"] = p("SELECT patient_id, metabolic_risk FROM patients")
    out["cardio_risk"] = p("SELECT patient_id, cardio_risk FROM patients")
    out["lifestyle_burden"] = p("SELECT patient_id, lifestyle_burden FROM patients")
    out["diet_plan"] = p("SELECT patient_id, diet_plan FROM patients")
    out["lifestyle_plan"] = p("SELECT patient_id, lifestyle_plan FROM patients")
    out["health_risk_index"] = p("SELECT patient_id, round(hri, 10) AS health_risk_index FROM hri", probs)
    out["risk_band"] = p(
        """SELECT patient_id, CASE WHEN hri < 0.3 THEN 'Low' WHEN hri < 0.6 THEN 'Medium' ELSE 'High' END AS risk_band,
  round(hri * 100, 8) AS risk_percent, hri * 100 >= 90 AS alert FROM hri""", probs)
    out["ordinal_encode"] = p(f"SELECT patient_id, {_ORD} FROM dirty", DIRTY)
    out["decode_labels"] = p(
        """SELECT patient_id, COALESCE(name, 'Unknown') AS class_name FROM patients p
LEFT JOIN (SELECT disease AS name, row_number() OVER (ORDER BY disease) - 1 AS code FROM (SELECT DISTINCT disease FROM patients) d) l
  ON l.code = p.patient_id % 13""")

    # encoding
    index_joins = " ".join(
        f"LEFT JOIN (SELECT {c} AS v, row_number() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS i FROM dirty WHERE {c} IS NOT NULL GROUP BY {c}) x_{c} ON x_{c}.v = d.{c}"
        for c in S.CATEGORICAL)
    out["string_index"] = p("SELECT patient_id, " + ", ".join(
        f"CAST(COALESCE(x_{c}.i, (SELECT COUNT(DISTINCT {c}) FROM dirty)) AS DOUBLE) AS {c}_index" for c in S.CATEGORICAL)
        + f" FROM dirty d {index_joins}", DIRTY)
    code_joins = " ".join(
        f"JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT {c} AS v FROM patients) u) x_{c} ON x_{c}.v = p.{c}"
        for c in (*S.CATEGORICAL, *S.TARGETS.values()))
    out["label_encode_alpha"] = p("SELECT patient_id, " + ", ".join(
        f"CAST(x_{c}.i AS DOUBLE) AS {c}_code" for c in (*S.CATEGORICAL, *S.TARGETS.values())) + f" FROM patients p {code_joins}")
    out["one_hot"] = p(f"SELECT patient_id, {_one_hot()} FROM patients")
    out["one_hot_ignore_unknown"] = p(f"SELECT patient_id, {_one_hot()} FROM dirty", DIRTY)
    out["assemble_skip"] = p("SELECT patient_id, " + ", ".join(f"{c} AS {c}" for c in _NUM7) + " FROM dirty WHERE "
                             + " AND ".join(f"{c} IS NOT NULL" for c in _NUM7), DIRTY)
    out["standard_scale"] = out["scaler_reload"] = p(_scaled("patients", _NUM7, "stddev_samp", "patient_id"))
    out["standard_scale_pop"] = _scaled("lineitem", LINEITEM_MEASURES, "stddev_pop", "l_orderkey, l_linenumber")

    # splits
    out["hash_split"] = p(f"SELECT patient_id, {order_hash} % 10000 < 8000 AS is_train FROM patients")
    ranked = f"SELECT patient_id, disease, row_number() OVER (PARTITION BY disease ORDER BY {order_hash}, patient_id) AS r, COUNT(*) OVER (PARTITION BY disease) AS n FROM patients"
    out["stratified_split"] = p(f"SELECT patient_id, disease, r * 10000 <= n * 8000 AS is_train FROM ({ranked}) s")
    out["kfold_assign"] = p(f"SELECT patient_id, disease, CAST(CASE WHEN r > n * 2 // 3 THEN 2 WHEN r > n // 3 THEN 1 ELSE 0 END AS INTEGER) AS fold FROM ({ranked}) s")

    # models with a closed form
    dist = [" + ".join(f"({c} - {v}) * ({c} - {v})" for c, v in zip(("age", "bmi", "glucose"), pt, strict=True)) for pt in CENTROIDS]
    out["nearest_centroid"] = p(
        f"""SELECT patient_id, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster,
  round(LEAST(d0, d1, d2), 4) AS distance_sq FROM (SELECT patient_id, {', '.join(f'{e} AS d{i}' for i, e in enumerate(dist))} FROM patients) d""")
    out["confidence"] = p("SELECT patient_id, class AS prediction, round(probability, 6) AS confidence FROM ranked_probs WHERE rank = 1", probs)

    # evaluation
    grouped_predictions = _class_counts("(SELECT 'all' AS grp, label, prediction FROM predictions) z")
    out["confusion_matrix"] = p("SELECT label, prediction, COUNT(*) AS n FROM predictions GROUP BY label, prediction", PREDICTIONS)
    out["class_report"] = p(
        """SELECT class, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted, CAST(tp AS BIGINT) AS tp,
  round(pr, 6) AS "precision", round(rc, 6) AS recall, round(f1, 6) AS f1_score FROM class_scores""", PREDICTIONS, grouped_predictions)
    out["accuracy"] = p("SELECT COUNT(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM predictions", PREDICTIONS)
    out["weighted_prf"] = p(f"SELECT n, {_R4}, num_classes FROM metrics", PREDICTIONS, grouped_predictions)
    out["binary_report"] = "WITH " + _class_counts("(SELECT 'all' AS grp, quality AS label, toxic AS prediction FROM labels) z") + f"\nSELECT n, {_R4}, num_classes FROM metrics"
    out["silhouette"] = p(
        """SELECT * FROM (WITH st AS (SELECT cluster, CAST(COUNT(*) AS DOUBLE) AS n, SUM(age) AS sa, SUM(bmi) AS sb, SUM(glucose) AS sg, SUM(age * age + bmi * bmi + glucose * glucose) AS sq FROM grouped GROUP BY cluster),
d AS (SELECT g.patient_id, g.cluster AS own, s.cluster AS other, s.n, g.age * g.age + g.bmi * g.bmi + g.glucose * g.glucose
    + (s.sq - 2 * (g.age * s.sa + g.bmi * s.sb + g.glucose * s.sg)) / s.n AS dist FROM grouped g CROSS JOIN st s),
ab AS (SELECT patient_id, MAX(CASE WHEN own = other THEN dist * n / (n - 1) END) AS a, MIN(CASE WHEN own <> other THEN dist END) AS b FROM d GROUP BY patient_id)
SELECT COUNT(*) AS n, round(avg((b - a) / GREATEST(a, b)), 6) AS silhouette FROM ab) z""", GROUPED)
    out["target_band"] = p(
        """SELECT round(avg(accuracy), 6) AS mean_accuracy, CASE WHEN avg(accuracy) >= 0.85 THEN 'achieved' WHEN avg(accuracy) >= 0.75 THEN 'close' ELSE 'below' END AS band
FROM model_results WHERE algorithm = 'RandomForest'""", grid)
    out["sample_counts"] = p(
        f"""SELECT COUNT(*) FILTER (WHERE t) AS train_samples, COUNT(*) FILTER (WHERE NOT t) AS test_samples, COUNT(*) AS total_samples,
  {', '.join(f'COUNT(DISTINCT {c}) AS {c}_classes' for c in S.TARGETS.values())}
FROM (SELECT *, {order_hash} % 10000 < 8000 AS t FROM patients) s""")

    # profiling
    out["row_count"] = "SELECT COUNT(*) AS row_count FROM lineitem"
    out["distinct_counts"] = p(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS distinct_count FROM patients" for c in (*S.CATEGORICAL, *S.TARGETS.values())))
    share = "round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM {t}), 4) AS percent"
    out["value_counts"] = p(f"SELECT disease AS value, COUNT(*) AS n, {share.format(t='patients')} FROM patients GROUP BY disease")
    out["value_counts_events"] = f"SELECT event_type AS value, COUNT(*) AS n, {share.format(t='events')} FROM events GROUP BY event_type"
    out["diet_plan_share"] = p(f"SELECT diet_plan AS value, COUNT(*) AS n, {share.format(t='patients')} FROM patients GROUP BY diet_plan")
    out["label_summary"] = p(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, COUNT(*) AS n, {share.format(t='patients')} FROM patients GROUP BY {c}" for c in S.TARGETS.values()))
    out["group_counts"] = p("SELECT cluster, COUNT(*) AS n FROM grouped GROUP BY cluster", GROUPED)
    means = ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in _NUM7[:5])
    out["group_means"] = p(f"SELECT cluster, {means} FROM grouped GROUP BY cluster", GROUPED)
    out["contingency"] = p("SELECT cluster, " + ", ".join(
        f"COUNT(*) FILTER (WHERE disease = '{d}') AS {d}" for d in S.DISEASES)
        + ", 0::BIGINT AS _other FROM grouped GROUP BY cluster", GROUPED)
    out["contingency_orders"] = "SELECT o_orderpriority, " + ", ".join(
        f"COUNT(*) FILTER (WHERE o_orderstatus = '{s}') AS {s}" for s in ("F", "O", "P")) + ", 0::BIGINT AS _other FROM orders GROUP BY o_orderpriority"
    out["contingency_unlisted"] = """SELECT o_orderpriority, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS F,
        COUNT(*) FILTER (WHERE o_orderstatus IS DISTINCT FROM 'F') AS _other FROM orders GROUP BY o_orderpriority"""
    # invariants of the fitted models over every row
    out["model_reload"] = p("SELECT COUNT(*) AS n, 0::BIGINT AS changed FROM patients")
    out["stream_model_scoring"] = p("SELECT COUNT(*) AS n, 0::BIGINT AS different FROM patients")
    out["labelled_scoring"] = p("SELECT patient_id, disease AS true_disease, true AS index_agrees FROM patients")
    out["probability_check"] = p(f"SELECT patient_id, {len(S.DISEASES)}::INTEGER AS n_classes, true AS adds_up, true AS within FROM patients")
    out["attribution_check"] = p("SELECT patient_id, true AS adds_up FROM patients")
    out["importance_check"] = "SELECT 'disease' AS task, 1.0::DOUBLE AS total"
    out["cluster_check"] = p("SELECT COUNT(*) AS n, 5::BIGINT AS clusters FROM patients")
    out["fit_on_train_only"] = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", 0.0::DOUBLE AS mean, 1.0::DOUBLE AS sd" for c in S.NUMERIC)
    out["box_summary"] = p("SELECT * FROM (WITH " + _box("grouped", "cluster", _NUM7[:5]) + ") z", GROUPED)
    out["box_summary_orders"] = "WITH " + _box("orders", "o_orderpriority", ["o_totalprice"])
    top = """top AS (SELECT cluster, disease AS value, COUNT(*) AS n, row_number() OVER (PARTITION BY cluster ORDER BY COUNT(*) DESC, disease) AS rank FROM grouped GROUP BY cluster, disease)"""
    out["top_per_group"] = p("SELECT cluster, value, n, rank FROM top WHERE rank <= 3", GROUPED, top)
    out["group_profile"] = p(
        f"""SELECT g.*, t1.value AS top_1, t2.value AS top_2, t3.value AS top_3
FROM (SELECT cluster, COUNT(*) AS n, {means} FROM grouped GROUP BY cluster) g
LEFT JOIN top t1 ON t1.cluster = g.cluster AND t1.rank = 1 LEFT JOIN top t2 ON t2.cluster = g.cluster AND t2.rank = 2
LEFT JOIN top t3 ON t3.cluster = g.cluster AND t3.rank = 3""", GROUPED, top)
    out["histogram"] = "WITH " + _hist("lineitem", "l_extendedprice", 30)
    out["histogram_age"] = p("SELECT * FROM (WITH " + _hist("patients", "age", 30) + ") z")
    out["corr_matrix"] = p(_corr("patients", _NUM7))
    out["corr_matrix_lineitem"] = _corr("lineitem", LINEITEM_MEASURES)

    # ranking inside rows and over models
    out["top_classes"] = p("SELECT patient_id, rank, class, round(probability, 6) AS probability FROM ranked_probs WHERE rank <= 3", probs)
    out["top_contributions"] = f"WITH {contrib}\nSELECT patient_id, rank, feature, value FROM ranked WHERE rank <= 5"
    model_rank = "row_number() OVER (PARTITION BY task ORDER BY accuracy DESC, algorithm)"
    out["rank_models"] = p(f"SELECT task, algorithm, round(accuracy, 6) AS accuracy, {model_rank} AS rank FROM model_results", grid)
    out["best_models"] = p(
        f"""SELECT t.task, COALESCE(algorithm, 'N/A') AS algorithm, round(COALESCE(accuracy, 0.0), 6) AS accuracy,
  round(COALESCE(f1_score, 0.0), 6) AS f1_score, round(COALESCE(training_time_seconds, 0.0), 3) AS training_time_seconds
FROM (VALUES ('disease'), ('diet'), ('lifestyle')) t(task)
LEFT JOIN (SELECT *, {model_rank} AS rank FROM model_results WHERE task <> 'lifestyle') r ON r.task = t.task AND r.rank = 1""", grid)
    tasks = tuple(S.TARGETS)
    for metric, name in (("accuracy", "accuracy_matrix"), ("f1_score", "f1_matrix")):
        cells = ", ".join(f"round(COALESCE(MAX(CASE WHEN task = '{t}' THEN {metric} END), 0.0), 6) AS {t}" for t in tasks)
        out[name] = p(f"SELECT algorithm, {cells} FROM model_results WHERE NOT (task = 'diet' AND algorithm = 'SVM') GROUP BY algorithm", grid)
    out["algorithm_list"] = p("SELECT DISTINCT algorithm FROM model_results", grid)
    out["metric_grid"] = p(" UNION ALL ".join(
        f"""SELECT '{m}' AS metric, a.algorithm, t.task, round(COALESCE("{m}", 0.0), 6) AS value FROM (SELECT DISTINCT algorithm FROM model_results) a
CROSS JOIN (VALUES ('disease'), ('diet'), ('lifestyle')) t(task)
LEFT JOIN (SELECT * FROM model_results WHERE NOT (task = 'diet' AND algorithm = 'SVM')) r ON r.task = t.task AND r.algorithm = a.algorithm"""
        for m in ("accuracy", "f1_score", "precision", "recall")), grid)
    out["efficiency"] = p(
        "SELECT task, algorithm, round(training_time_seconds, 3) AS training_time_seconds, round(accuracy, 6) AS accuracy, round(avg(accuracy) OVER (PARTITION BY task), 6) AS task_mean_accuracy FROM model_results", grid)
    out["summary_table"] = p(
        f"""SELECT task, rank, CASE WHEN rank = 1 THEN upper(task[1]) || task[2:] END AS task_label, rank = 1 AS is_best, algorithm, {_R4},
  round(training_time_seconds, 3) AS training_time_seconds FROM (SELECT *, {model_rank} AS rank FROM model_results) r""", grid)
    out["metric_overview"] = p(f"SELECT task, {_R4} FROM model_results WHERE algorithm = 'RandomForest'", grid)

    # explanation
    out["linear_attribution"] = p(" UNION ALL ".join(
        f"SELECT patient_id, '{c}' AS feature, round({k} * ({c} - (SELECT avg({c}) FROM patients)), 6) + 0.0 AS value FROM patients"
        for c, k in LINEAR_COEFFICIENTS.items()))
    out["global_importance"] = f"WITH {contrib}\nSELECT feature, round(avg(abs(value)), 6) AS importance FROM contributions GROUP BY feature"
    labels = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.FEATURE_LABELS.items())
    out["explanation_text"] = f"""WITH {contrib}
SELECT patient_id, string_agg('• ' || CASE feature {labels} END || CASE WHEN value > 0 THEN ' increases' ELSE ' decreases' END
  || ' risk (impact: ' || printf('%.3f', abs(value)) || ')', chr(10) ORDER BY rank) AS explanation FROM ranked WHERE rank <= 5 GROUP BY patient_id"""
    out["tree_shap_two_features"] = p("SELECT * FROM (WITH " + _shapley_toy() + ") z")

    # streaming
    stream_cols = ", ".join("CAST(patient_id AS VARCHAR) AS patient_id" if c == "patient_id" else c for c in _STREAM_COLS)
    out["stream_passthrough"] = p(f"SELECT {stream_cols} FROM patients")
    scored = f"""SELECT CAST(patient_id AS VARCHAR) AS patient_id,
  metabolic_risk, lifestyle_burden, LEAST(GREATEST(metabolic_risk / 100.0, 0.0), 1.0) AS diet_risk,
  LEAST(GREATEST(lifestyle_burden / 100.0, 0.0), 1.0) AS lifestyle_risk,
  v.verdict, v.failed_rules FROM patients JOIN ({_domain('patients')}) v USING (patient_id)"""
    out["stream_scoring"] = out["stream_batch_scoring"] = p(scored)

    broken = "patient_id % 53 = 0 OR patient_id % 59 = 0 OR patient_id % 61 = 0"
    out["csv_quarantine"] = out["stream_quarantine"] = p(
        f"SELECT count(*) AS lines, count(*) FILTER (NOT ({broken})) AS good, count(*) FILTER ({broken}) AS bad FROM patients")
    out["stream_batches"] = p("SELECT true AS batch_per_file, CAST(count(*) AS BIGINT) AS rows FROM patients")
    trained = f"{mix('patient_id', 42)} % 10000 < 8000"
    out["run_document"] = p(f"""SELECT count(*) FILTER ({trained}) AS train_samples, count(*) FILTER (NOT ({trained})) AS test_samples, count(*) AS total_samples,
  CAST({len(S.NUMERIC) + len(S.CATEGORICAL)} AS INTEGER) AS features, CAST({len(ALGORITHM_SKILL)} AS BIGINT) AS models FROM patients""")
    out["approximate_median"] = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", true AS within" for c in LINEITEM_MEASURES)
    whole = "usable AS (SELECT * FROM dirty WHERE " + _complete() + ")"
    filled = {c: f"COALESCE({c}, (SELECT median({c}) FROM usable))" for c in S.MEDIAN_FILLED} | {c: f"COALESCE({c}, {_mode(c, 'usable')})" for c in S.MODE_FILLED}
    out["clean_chain"] = p("SELECT patient_id, " + ", ".join(f"{filled.get(c, c)} AS {c}" for c in S.REQUIRED) + " FROM usable", f"{DIRTY},\n{whole}")
    out["results_document"] = p(f"""SELECT task, algorithm, {_R4}, round(training_time_seconds, 3) AS training_time_seconds, CAST(NULL AS DOUBLE) AS cv_accuracy_mean,
  CAST(NULL AS DOUBLE) AS cv_accuracy_std, num_classes FROM model_results""", grid)

    # dataset builder
    out["weighted_assign"] = p("SELECT patient_id, disease FROM patients")
    out["patients"] = p(f"SELECT patient_id, {_COLS}, metabolic_risk, cardio_risk, lifestyle_burden FROM patients")
    return out
