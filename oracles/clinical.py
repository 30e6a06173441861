"""Independent DuckDB texts for the derived patient tables.

Each entry is a CTE body; ``with_ctes`` strings the needed ones together in
dependency order. The raw fixture text is shared with Spark (it *defines* the
input); every later stage is written here separately in DuckDB SQL.
"""
from __future__ import annotations

from wardstat.functions import vocab as V
from wardstat.sources.fixture import fixture_sql


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def ph(x: str) -> str:
    return f"(CASE WHEN lower(trim({x})) IN {_in(V.PLACEHOLDERS)} THEN NULL ELSE {x} END)"


def dmap(x: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {x} {whens} ELSE {x} END)"


def norm(x: str) -> str:
    return f"lower(trim({x}))"


def rng(x: str, c: str) -> str:
    lo, hi = V.RANGES[c]
    return f"(CASE WHEN {x} BETWEEN {lo} AND {hi} THEN {x} END)"


def fin(x: str) -> str:
    return f"(CASE WHEN isinf({x}) OR isnan({x}) THEN NULL ELSE {x} END)"


DOSAGE_RE = r"(?:^|\D)(\d+\.?\d*)\s*mg(?:\D|$)"
BP_RE = r"(\d{2,3})\s*/\s*(\d{2,3})"


def dosage(x: str) -> str:
    m = f"regexp_extract(lower({x}), {_q(DOSAGE_RE)}, 1)"
    s = f"trim(lower({x}))"
    return (f"(CASE WHEN {m} <> '' THEN CAST({m} AS DOUBLE) "
            f"WHEN regexp_full_match({s}, '\\d+\\.?\\d*') THEN CAST({s} AS DOUBLE) END)")


def duration(x: str) -> str:
    return (f"(CASE WHEN {x} IN ('ongoing', 'chronic', 'lifetime') THEN 365.0 "
            f"WHEN regexp_full_match(trim({x}), '[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?') "
            f"THEN TRY_CAST(trim({x}) AS DOUBLE) END)")


def bin_text(x: str) -> str:
    return (f"CAST(CASE WHEN lower(trim({x})) IN {_in(V.BINARY_ZERO)} THEN 0 "
            f"WHEN lower(trim({x})) IN {_in(V.BINARY_ONE)} THEN 1 END AS INTEGER)")


def bin_any(x: str) -> str:
    n = f"TRY_CAST(CASE WHEN regexp_full_match(trim({x}), '[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?') THEN trim({x}) END AS DOUBLE)"
    return (f"CAST(CASE WHEN {n} IS NOT NULL THEN (CASE WHEN {n} IN (0, 1) THEN {n} END) "
            f"WHEN lower(trim({x})) IN {_in(V.BINARY_ZERO)} THEN 0 "
            f"WHEN lower(trim({x})) IN {_in(V.BINARY_ONE)} THEN 1 END AS INTEGER)")


def parse_date(x: str) -> str:
    return f"CAST(try_strptime({x}, ['%Y-%m-%d', '%Y/%m/%d', '%B %d, %Y', '%m/%d/%Y']) AS DATE)"


RAW = fixture_sql("orders")

CONSOLIDATED = f"""
SELECT * REPLACE (
  coalesce(Age, age_1) AS Age,
  coalesce(Gender, gender_1) AS Gender,
  coalesce(Drug_Name, drug_name_1) AS Drug_Name,
  coalesce(Weight_kg, Weight_lbs / 2.20462) AS Weight_kg,
  coalesce(Systolic_BP, CAST(nullif(regexp_extract(trim(blood_pressure), {_q(BP_RE)}, 1), '') AS DOUBLE)) AS Systolic_BP,
  coalesce(Diastolic_BP, CAST(nullif(regexp_extract(trim(blood_pressure), {_q(BP_RE)}, 2), '') AS DOUBLE)) AS Diastolic_BP
) FROM patients_raw"""

DEDUP = """
SELECT * FROM consolidated
QUALIFY row_number() OVER (PARTITION BY Patient_ID ORDER BY row_ord) = 1"""

RENAMED = """
SELECT row_ord, Patient_ID AS patient_id, Age AS age, Gender AS gender, Ethnicity AS ethnicity,
  Weight_kg AS weight_kg, Height_cm AS height_cm, BMI AS bmi, Systolic_BP AS systolic_bp,
  Diastolic_BP AS diastolic_bp, Heart_Rate AS heart_rate, Temperature_F AS temperature_f,
  Hemoglobin AS hemoglobin, WBC_Count AS wbc_count, ALT_Enzyme AS alt_enzyme, AST_Enzyme AS ast_enzyme,
  Creatinine AS creatinine, eGFR AS egfr, HbA1c AS hba1c, Total_Cholesterol AS total_cholesterol,
  Drug_Name AS drug_name, Dosage AS dosage_mg, Duration_Days AS duration_days, Route AS route,
  Concurrent_Drugs AS concurrent_drugs, Diagnosis AS diagnosis, Smoking_Status AS smoking_status,
  Alcohol_Use AS alcohol_use, Admission_Date AS admission_date, Treatment_Outcome AS treatment_outcome,
  Adverse_Event AS adverse_event, Readmission_30d AS readmission_30d
FROM dedup"""

_TEXT = ["gender", "ethnicity", "drug_name", "dosage_mg", "duration_days", "route", "diagnosis",
         "smoking_status", "alcohol_use", "admission_date", "treatment_outcome", "adverse_event"]

PLACEHELD = "SELECT * REPLACE (" + ", ".join(f"{ph(c)} AS {c}" for c in _TEXT) + ") FROM renamed"

MAPPED = f"""
SELECT * REPLACE (
  {dmap(norm('gender'), V.GENDER_MAP)} AS gender,
  {dmap(norm('ethnicity'), V.ETHNICITY_MAP)} AS ethnicity,
  {dmap("regexp_replace(" + norm('drug_name') + ", '\\s+', ' ', 'g')", V.DRUG_MAP)} AS drug_name,
  {dmap(norm('route'), V.ROUTE_MAP)} AS route,
  {dmap(norm('diagnosis'), V.DIAGNOSIS_MAP)} AS diagnosis,
  {dmap(norm('smoking_status'), V.SMOKING_MAP)} AS smoking_status,
  {norm('alcohol_use')} AS alcohol_use,
  {dosage('dosage_mg')} AS dosage_mg,
  {duration('duration_days')} AS duration_days,
  CASE WHEN height_cm BETWEEN 4 AND 8 THEN height_cm * 30.48 ELSE height_cm END AS height_cm
) FROM placeheld"""

RANGED = ("SELECT * REPLACE (" + ", ".join(f"{rng(fin(c), c)} AS {c}" for c in V.NUMERIC_COLUMNS)
          + ") FROM mapped")


def _bmi(bounded: bool) -> str:
    rec = "(CASE WHEN height_cm > 0 THEN weight_kg / pow(height_cm / 100.0, 2) END)"
    bad = "(bmi IS NULL OR bmi < 5 OR bmi > 100)"
    if bounded:
        return f"CASE WHEN {bad} AND {rec} BETWEEN 5 AND 100 THEN {rec} ELSE bmi END"
    return f"CASE WHEN {bad} AND height_cm > 0 THEN {rec} ELSE bmi END"


def _final(bounded: bool, binary) -> str:
    return f"""
SELECT * REPLACE (
  {_bmi(bounded)} AS bmi,
  {parse_date('admission_date')} AS admission_date,
  {binary('treatment_outcome')} AS treatment_outcome,
  {binary('adverse_event')} AS adverse_event,
  CAST(CASE WHEN readmission_30d IN (0, 1) THEN readmission_30d END AS INTEGER) AS readmission_30d
) FROM ranged"""


CLEAN_DET = _final(True, bin_any)       # C32
CLEAN_RULES = _final(False, bin_text)   # C02-C27 as in the full job

# Medians (after range nulling), modes, then quartiles on imputed values.
_MED = ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in V.NUMERIC_COLUMNS)
MEDIANS = f"SELECT {_MED} FROM clean_rules"


def _mode_sql(c: str) -> str:
    return (f"(SELECT {c} FROM clean_rules WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} ASC LIMIT 1)")


MODES = "SELECT " + ", ".join(f"{_mode_sql(c)} AS {c}" for c in V.CATEGORICAL_COLUMNS)

IMPUTED = ("SELECT r.* REPLACE (" +
           ", ".join([f"coalesce(r.{c}, m.{c}) AS {c}" for c in V.NUMERIC_COLUMNS] +
                     [f"coalesce(r.{c}, o.{c}) AS {c}" for c in V.CATEGORICAL_COLUMNS]) +
           ") FROM clean_rules r, medians m, modes o")

IQR = ("SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in V.IQR_COLUMNS)
    + " FROM imputed")


def _cap(c: str) -> str:
    lo = f"(q.{c}_q1 - 1.5 * (q.{c}_q3 - q.{c}_q1))"
    hi = f"(q.{c}_q3 + 1.5 * (q.{c}_q3 - q.{c}_q1))"
    return f"CASE WHEN i.{c} IS NULL THEN NULL WHEN i.{c} < {lo} THEN {lo} WHEN i.{c} > {hi} THEN {hi} ELSE i.{c} END"


CLEAN_FULL = ("SELECT i.* REPLACE (" + ", ".join(f"{_cap(c)} AS {c}" for c in V.IQR_COLUMNS)
              + ") FROM imputed i, iqr q")

# F01-F09 on the C31 table.
FEAT_STATS = """
SELECT median(dosage_mg) AS dosage_median,
       (SELECT quantile_cont(CASE WHEN alt_enzyme > 0 THEN ast_enzyme / alt_enzyme END, 0.5) FROM clean_full) AS ratio_median
FROM clean_full"""

RATIO_RAW = """
SELECT c.*, coalesce(CASE WHEN alt_enzyme > 0 THEN ast_enzyme / alt_enzyme END, s.ratio_median) AS ratio_filled
FROM clean_full c, feat_stats s"""

RATIO_LIMITS = """
SELECT greatest(0.0, q1 - 1.5 * (q3 - q1)) AS lower, q3 + 1.5 * (q3 - q1) AS upper, q1, q3
FROM (SELECT quantile_cont(ratio_filled, 0.25) AS q1, quantile_cont(ratio_filled, 0.75) AS q3 FROM ratio_raw)"""

ENGINEERED = """
SELECT r.* EXCLUDE (ratio_filled),
  CASE WHEN egfr >= 90 THEN 'Normal' WHEN egfr >= 60 AND egfr < 90 THEN 'Mild'
       WHEN egfr >= 30 AND egfr < 60 THEN 'Moderate' WHEN egfr < 30 THEN 'Severe' ELSE 'Unknown' END AS kidney_stage,
  CASE WHEN bmi < 18.5 THEN 'Underweight' WHEN bmi >= 18.5 AND bmi < 25 THEN 'Normal'
       WHEN bmi >= 25 AND bmi < 30 THEN 'Overweight' WHEN bmi >= 30 THEN 'Obese' ELSE 'Unknown' END AS bmi_category,
  CASE WHEN age < 18 THEN 'Pediatric' WHEN age >= 18 AND age < 35 THEN 'Young Adult'
       WHEN age >= 35 AND age < 65 THEN 'Middle Aged' WHEN age >= 65 AND age < 80 THEN 'Senior'
       WHEN age >= 80 THEN 'Elderly' ELSE 'Unknown' END AS age_group,
  CAST(coalesce(alt_enzyme > 40, false) OR coalesce(ast_enzyme > 40, false) AS INTEGER) AS liver_risk,
  CAST(coalesce(concurrent_drugs >= 5, false) AS INTEGER) AS polypharmacy,
  CAST(coalesce(age >= 65 AND dosage_mg > s.dosage_median, false) AS INTEGER) AS elderly_high_dose,
  least(greatest(ratio_filled, l.lower), l.upper) AS de_ritis_ratio
FROM ratio_raw r, feat_stats s, ratio_limits l"""

CTES = {
    "patients_raw": RAW,
    "consolidated": CONSOLIDATED,
    "dedup": DEDUP,
    "renamed": RENAMED,
    "placeheld": PLACEHELD,
    "mapped": MAPPED,
    "ranged": RANGED,
    "clean_det": CLEAN_DET,
    "clean_rules": CLEAN_RULES,
    "medians": MEDIANS,
    "modes": MODES,
    "imputed": IMPUTED,
    "iqr": IQR,
    "clean_full": CLEAN_FULL,
    "feat_stats": FEAT_STATS,
    "ratio_raw": RATIO_RAW,
    "ratio_limits": RATIO_LIMITS,
    "engineered": ENGINEERED,
}
_DEPS = {
    "patients_raw": [], "consolidated": ["patients_raw"], "dedup": ["consolidated"], "renamed": ["dedup"],
    "placeheld": ["renamed"], "mapped": ["placeheld"], "ranged": ["mapped"], "clean_det": ["ranged"],
    "clean_rules": ["ranged"], "medians": ["clean_rules"], "modes": ["clean_rules"],
    "imputed": ["clean_rules", "medians", "modes"], "iqr": ["imputed"], "clean_full": ["imputed", "iqr"],
    "feat_stats": ["clean_full"], "ratio_raw": ["clean_full", "feat_stats"], "ratio_limits": ["ratio_raw"],
    "engineered": ["ratio_raw", "feat_stats", "ratio_limits"],
}


def with_ctes(needed: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    order: list[str] = []

    def visit(n):
        for d in _DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in needed:
        visit(n)
    parts = [f"{n} AS ({CTES[n]})" for n in order] + [f"{n} AS ({s})" for n, s in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body
