"""Oracle texts for sources, cleaning, features and the SQL catalog."""
from __future__ import annotations

from wardstat.functions import vocab as V

from . import analytics as S
from .clinical import (bin_any, bin_text, duration, dosage, dmap, fin, norm, parse_date, ph, rng, with_ctes, _q)

ORACLE_SQL: dict[str, str] = {}


def add(key, sql):
    ORACLE_SQL[key] = sql


RAW_TO_CANON = {"Age": "age", "Weight_kg": "weight_kg", "Height_cm": "height_cm", "BMI": "bmi",
                "Systolic_BP": "systolic_bp", "Diastolic_BP": "diastolic_bp", "Heart_Rate": "heart_rate",
                "Temperature_F": "temperature_f", "Hemoglobin": "hemoglobin", "WBC_Count": "wbc_count",
                "ALT_Enzyme": "alt_enzyme", "AST_Enzyme": "ast_enzyme", "Creatinine": "creatinine",
                "eGFR": "egfr", "HbA1c": "hba1c", "Total_Cholesterol": "total_cholesterol",
                "Concurrent_Drugs": "concurrent_drugs"}
RAW_TEXT = ["Gender", "Ethnicity", "Drug_Name", "Dosage", "Duration_Days", "Route", "Diagnosis",
            "Smoking_Status", "Alcohol_Use", "Admission_Date", "Treatment_Outcome", "Adverse_Event"]


def raw_op(out, rawcol, expr_of, placeholder=True):
    src = ph(rawcol) if placeholder else rawcol
    return with_ctes(["patients_raw"], f"SELECT row_ord, {rawcol} AS raw_value, {expr_of(src)} AS {out} FROM patients_raw")


add("canonical_schema", with_ctes(["renamed"], "SELECT * FROM renamed"))
add("snake_case_labels", """
SELECT p_partkey,
  regexp_replace(regexp_replace(regexp_replace(lower(trim(p_name)), '\\s+', '_', 'g'), '[^a-z0-9_]', '', 'g'), '_+', '_', 'g') AS label,
  regexp_replace(regexp_replace(regexp_replace(lower(trim(p_type)), '\\s+', '_', 'g'), '[^a-z0-9_]', '', 'g'), '_+', '_', 'g') AS type_label
FROM part""")
add("coalesce_fill", with_ctes(["patients_raw"], f"""
SELECT * FROM (
  SELECT 'age' AS column, CAST(sum(CASE WHEN Age IS NULL AND age_1 IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS filled FROM patients_raw
  UNION ALL SELECT 'gender', CAST(sum(CASE WHEN Gender IS NULL AND gender_1 IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) FROM patients_raw
  UNION ALL SELECT 'drug_name', CAST(sum(CASE WHEN Drug_Name IS NULL AND drug_name_1 IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) FROM patients_raw
  UNION ALL SELECT 'weight_kg', CAST(sum(CASE WHEN Weight_kg IS NULL AND Weight_lbs IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) FROM patients_raw
  UNION ALL SELECT 'systolic_bp', CAST(sum(CASE WHEN Systolic_BP IS NULL AND regexp_extract(trim(blood_pressure), '(\\d{{2,3}})\\s*/\\s*(\\d{{2,3}})', 1) <> '' THEN 1 ELSE 0 END) AS BIGINT) FROM patients_raw
  UNION ALL SELECT 'diastolic_bp', CAST(sum(CASE WHEN Diastolic_BP IS NULL AND regexp_extract(trim(blood_pressure), '(\\d{{2,3}})\\s*/\\s*(\\d{{2,3}})', 2) <> '' THEN 1 ELSE 0 END) AS BIGINT) FROM patients_raw
)"""))
add("unit_fill", with_ctes(["consolidated"], "SELECT row_ord, Weight_kg AS weight_kg FROM consolidated"))
add("split_pair_fill", with_ctes(["consolidated"],
                                 "SELECT row_ord, Systolic_BP AS systolic_bp, Diastolic_BP AS diastolic_bp FROM consolidated"))
add("dedup_keep_first", """
SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""")
add("dedup_patients", with_ctes(["dedup"], "SELECT row_ord, Patient_ID, Age, Gender, Drug_Name, Systolic_BP FROM dedup"))
add("drop_columns", with_ctes(["patients_raw"], "SELECT * EXCLUDE (" + ", ".join(V.DROP_COLUMNS) + ") FROM patients_raw"))
add("placeholder_to_null", with_ctes(["patients_raw"], "SELECT row_ord, " + ", ".join(
    f"{ph(c)} AS {c.lower()}" for c in RAW_TEXT) + " FROM patients_raw"))
add("normalize_text", "SELECT c_custkey, lower(trim(c_mktsegment)) AS segment, lower(trim(c_name)) AS name FROM customer")
add("canonical_gender", raw_op("gender", "Gender", lambda s: dmap(norm(s), V.GENDER_MAP)))
add("canonical_ethnicity", raw_op("ethnicity", "Ethnicity", lambda s: dmap(norm(s), V.ETHNICITY_MAP)))
add("canonical_drug", raw_op("drug_name", "Drug_Name",
                             lambda s: dmap("regexp_replace(" + norm(s) + ", '\\s+', ' ', 'g')", V.DRUG_MAP)))
add("canonical_route", raw_op("route", "Route", lambda s: dmap(norm(s), V.ROUTE_MAP)))
add("canonical_diagnosis", raw_op("diagnosis", "Diagnosis", lambda s: dmap(norm(s), V.DIAGNOSIS_MAP)))
add("canonical_smoking", raw_op("smoking_status", "Smoking_Status", lambda s: dmap(norm(s), V.SMOKING_MAP)))
add("extract_dosage", raw_op("dosage_mg", "Dosage", dosage))
add("duration_labels", raw_op("duration_days", "Duration_Days", duration))
add("coerce_numeric", raw_op("duration_number", "Duration_Days",
                             lambda s: f"(CASE WHEN regexp_full_match(trim({s}), '[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?') THEN TRY_CAST(trim({s}) AS DOUBLE) END)"))
add("unit_by_range", raw_op("height_cm", "Height_cm",
                            lambda s: f"(CASE WHEN {s} BETWEEN 4 AND 8 THEN {s} * 30.48 ELSE {s} END)", False))
add("inf_to_null", raw_op("bmi", "BMI", fin, False))
add("parse_mixed_dates", raw_op("admission_date", "Admission_Date", parse_date))
add("keep_zero_one", raw_op("readmission_30d", "Readmission_30d",
                            lambda s: f"CAST(CASE WHEN {s} IN (0, 1) THEN {s} END AS INTEGER)", False))
add("binary_from_text", with_ctes(["patients_raw"], f"SELECT row_ord, {bin_text(ph('Treatment_Outcome'))} AS treatment_outcome, "
                                                    f"{bin_text(ph('Adverse_Event'))} AS adverse_event FROM patients_raw"))
add("binary_from_any", with_ctes(["patients_raw"], f"SELECT row_ord, {bin_any(ph('Treatment_Outcome'))} AS treatment_outcome, "
                                                   f"{bin_any(ph('Adverse_Event'))} AS adverse_event FROM patients_raw"))
add("range_to_null", with_ctes(["patients_raw"], "SELECT row_ord, " + ", ".join(
    f"{rng(x, c)} AS {c}" for c, x in [*((c, fin(rc)) for rc, c in RAW_TO_CANON.items()), ("dosage_mg", dosage(ph("Dosage"))),
                                      ("duration_days", duration(ph("Duration_Days")))]) + " FROM patients_raw"))
add("recompute_bmi", with_ctes(["clean_rules", "clean_det"],
                               "SELECT r.patient_id, r.bmi AS bmi_unbounded, d.bmi AS bmi_bounded "
                               "FROM clean_rules r JOIN clean_det d USING (patient_id)"))
add("impute_median", with_ctes(["clean_rules"], " UNION ALL ".join(
    f"SELECT '{c}' AS column, quantile_cont({c}, 0.5) AS median FROM clean_rules" for c in V.NUMERIC_COLUMNS)))
add("impute_mode", with_ctes(["clean_rules"], " UNION ALL ".join(
    f"SELECT '{c}' AS column, (SELECT {c} FROM clean_rules WHERE {c} IS NOT NULL GROUP BY {c} "
    f"ORDER BY count(*) DESC, {c} LIMIT 1) AS mode" for c in V.CATEGORICAL_COLUMNS)))


def _iqr_one(c):
    return (f"SELECT '{c}' AS column, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper, "
            f"CAST(sum(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS below, "
            f"CAST(sum(CASE WHEN {c} > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS above, "
            f"min(least(greatest({c}, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1))) AS min_after, "
            f"max(least(greatest({c}, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1))) AS max_after "
            f"FROM imputed, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM imputed) "
            f"WHERE {c} IS NOT NULL GROUP BY q1, q3")


add("iqr_cap", with_ctes(["imputed"], " UNION ALL ".join(_iqr_one(c) for c in V.IQR_COLUMNS)))
add("clean_full", with_ctes(["clean_full"], "SELECT * EXCLUDE (row_ord) FROM clean_full"))
add("clean_deterministic", with_ctes(["clean_det"], "SELECT * EXCLUDE (row_ord) FROM clean_det"))

# Analytics catalog over the stored patients table (= C32 output).
_PAT = [("patients", "SELECT * EXCLUDE (row_ord) FROM clean_det")]
for key, sql in (("outcome_distribution", S.Q01), ("effectiveness_by_age", S.Q02), ("top_drugs", S.Q03),
                 ("adverse_by_drug_age", S.Q04), ("high_risk_patients", S.Q05), ("rates_by_dosage", S.Q06)):
    add(key, with_ctes(["clean_det"], sql, extra=_PAT))
add("query_suite", with_ctes(["clean_det"], " UNION ALL ".join(
    f"SELECT '{qid}' AS query_id, {_q(title)} AS title, {i + 1} AS position, CAST(count(*) AS BIGINT) AS n_rows FROM ({sql})"
    for i, (qid, title, sql) in enumerate(S.CATALOG)), extra=_PAT))

# Features on the C31 table.
for key, cols in (("kidney_stage", "egfr, kidney_stage"), ("bmi_category", "bmi, bmi_category"),
                  ("age_group", "age, age_group"), ("liver_risk", "alt_enzyme, ast_enzyme, liver_risk"),
                  ("polypharmacy", "concurrent_drugs, polypharmacy"),
                  ("elderly_high_dose", "age, dosage_mg, elderly_high_dose"),
                  ("safe_ratio_capped", "alt_enzyme, ast_enzyme, de_ritis_ratio")):
    add(key, with_ctes(["engineered"], f"SELECT patient_id, {cols} FROM engineered"))
add("feature_summary", with_ctes(["engineered"], """
SELECT 'kidney_stage' AS feature, kidney_stage AS value, count(*) AS n FROM engineered GROUP BY 2
UNION ALL SELECT 'bmi_category', bmi_category, count(*) FROM engineered GROUP BY 2
UNION ALL SELECT 'age_group', age_group, count(*) FROM engineered GROUP BY 2
UNION ALL SELECT 'liver_risk', '1', CAST(sum(liver_risk) AS BIGINT) FROM engineered
UNION ALL SELECT 'polypharmacy', '1', CAST(sum(polypharmacy) AS BIGINT) FROM engineered
UNION ALL SELECT 'elderly_high_dose', '1', CAST(sum(elderly_high_dose) AS BIGINT) FROM engineered"""))
add("engineer_full", with_ctes(["engineered"], "SELECT * EXCLUDE (row_ord) FROM engineered"))
