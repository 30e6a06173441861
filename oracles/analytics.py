"""DuckDB texts of the analytics catalog and the prediction-log reports. Labels, bounds and
limits are stated here again, so a mistyped value in the operators shows."""
from __future__ import annotations


def _pct(hit: str, col: str) -> str:
    return f"round(100.0 * count(*) FILTER ({col} = 1) / nullif(count({col}), 0)::DOUBLE, 2) AS observed_{hit}_rate_pct"


_OUTCOME = ("count(treatment_outcome) AS known_outcome_count, "
            "count(*) FILTER (treatment_outcome IS NULL) AS missing_outcome_count")
_ADVERSE = "count(adverse_event) AS known_adverse_count, count(*) FILTER (adverse_event IS NULL) AS missing_adverse_count"
_EFFECTIVE = _pct("effective", "treatment_outcome")
_DRUG = "coalesce(nullif(trim(drug_name), ''), 'Unknown Drug')"

Q01 = f"""SELECT CASE treatment_outcome WHEN 0 THEN 'Ineffective (0)' WHEN 1 THEN 'Effective (1)' ELSE 'Unknown' END
 AS treatment_outcome_group, count(*) AS total_records, {_OUTCOME},
 round(100.0 * count(*) / (sum(count(*)) OVER ())::DOUBLE, 2) AS pct_of_all_records FROM patients GROUP BY 1"""

Q02 = f"""SELECT age_group, count(*) AS total_records, {_OUTCOME}, {_EFFECTIVE}
FROM (SELECT treatment_outcome, CASE WHEN age > 65 THEN 'Over 65' WHEN age > 50 THEN '>50-65'
 WHEN age >= 30 THEN '30-50' WHEN age < 30 THEN 'Under 30' ELSE 'Unknown' END AS age_group FROM patients) GROUP BY ALL"""

Q03 = f"""SELECT {_DRUG} AS drug_group, count(*) AS total_records, {_OUTCOME},
 count(*) FILTER (treatment_outcome = 1) AS observed_effective_count, {_EFFECTIVE}
FROM patients GROUP BY 1 HAVING count(*) >= 100 AND {_DRUG} <> 'Unknown Drug'
ORDER BY observed_effective_rate_pct DESC NULLS LAST, total_records DESC, drug_group LIMIT 10"""

Q04 = f"""SELECT {_DRUG} AS drug_group,
 coalesce(if(age IS NULL, NULL, if(age > 65, 'Elderly', 'Non-Elderly')), 'Unknown') AS age_category,
 count(*) AS total_records, {_ADVERSE}, count(*) FILTER (adverse_event = 1) AS observed_adverse_count,
 {_pct('adverse', 'adverse_event')} FROM patients GROUP BY 1, 2
ORDER BY observed_adverse_rate_pct DESC NULLS LAST, total_records DESC, drug_group, age_category LIMIT 15"""

Q05 = """SELECT patient_id, age, bmi, creatinine, concurrent_drugs, treatment_outcome, adverse_event FROM patients
WHERE concurrent_drugs >= 5 AND creatinine > 1.5 AND age > 65 ORDER BY creatinine DESC, patient_id LIMIT 20"""

Q06 = f"""SELECT dosage_category, count(*) AS total_records, {_OUTCOME}, {_ADVERSE}, {_EFFECTIVE},
 {_pct('adverse', 'adverse_event')}
FROM (SELECT treatment_outcome, adverse_event, CASE WHEN dosage_mg > 500 THEN 'High (>500mg)'
 WHEN dosage_mg >= 100 THEN 'Medium (100-500mg)' WHEN dosage_mg < 100 THEN 'Low (<100mg)' ELSE 'Unknown' END
 AS dosage_category FROM patients) GROUP BY ALL"""

CATALOG = [
    ("Q1", "Treatment outcome distribution", Q01),
    ("Q2", "Treatment effectiveness by age group", Q02),
    ("Q3", "Top 10 drugs by observed treatment effectiveness (min 100 records)", Q03),
    ("Q4", "Adverse-event rates by drug and age category (top 15)", Q04),
    ("Q5", "High-risk patients (age > 65, creatinine > 1.5, concurrent_drugs >= 5)", Q05),
    ("Q6", "Treatment and adverse-event rates by dosage category", Q06),
]

_LOGGED = "model_name, model_version, probability_effective, cutoff, predicted_class, predicted_outcome"
_SEEN = "treatment_outcome AS observed_treatment_outcome, adverse_event AS observed_adverse_event"

LATEST = f"""SELECT prediction_id, patient_id, {_LOGGED}, predicted_at FROM
(SELECT *, row_number() OVER (ORDER BY predicted_at DESC, prediction_id DESC) AS nth FROM log) WHERE nth <= 100"""

CONTEXT = f"""SELECT * EXCLUDE (nth) FROM (SELECT prediction_id, predicted_at, patient_id, age, gender, drug_name,
 dosage_mg, concurrent_drugs, creatinine, {_SEEN}, {_LOGGED},
 row_number() OVER (ORDER BY predicted_at DESC, prediction_id DESC) AS nth
FROM log JOIN clean_det USING (patient_id)) WHERE nth <= 200"""


def history(patient_id: int) -> str:
    return (f"SELECT prediction_id, predicted_at, patient_id, {_LOGGED}, {_SEEN}, "
            f"readmission_30d AS observed_readmission_30d FROM log JOIN clean_det USING (patient_id) "
            f"WHERE patient_id = {patient_id}")
