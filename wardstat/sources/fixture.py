"""Derived 41-column messy patient table (``patients_raw``) built from ``orders``.

The driver's tables carry no clinical columns, so the raw patient table is derived
from ``orders`` with integer arithmetic only. The select list below is a single
text valid in both Spark SQL and DuckDB: Spark evaluates it with
``orders.selectExpr`` (a projection that stays inside whole-stage codegen, one
output row per order, no shuffle), the DuckDB oracle embeds the very same text.

Work grows with ``orders``: every order row yields one raw patient row, about one
row in eleven repeats the previous patient id, two thirds of those as exact copies.
"""
from __future__ import annotations

from pyspark.sql import DataFrame

# h(p, m): a deterministic pseudo-random integer in [0, m) per source row.
def _h(p: int, m: int) -> str:
    return f"(((k * {p} + 7919) % 1000003) % {m})"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _num(p, null_pct, base, span, scale, specials=()):
    parts = [f"CASE WHEN {_h(p, 100)} < {null_pct} THEN CAST(NULL AS DOUBLE)"]
    for j, s in enumerate(specials):
        parts.append(f"WHEN {_h(p + 2, 200)} = {j} THEN CAST({_lit(s)} AS DOUBLE)")
    parts.append(f"ELSE CAST({base} + {_h(p + 4, span)} AS DOUBLE) / {scale} END")
    return " ".join(parts)


def _pick(p, values):
    parts = [f"CASE {_h(p, len(values))}"]
    for i, v in enumerate(values):
        parts.append(f"WHEN {i} THEN {_lit(v) if v is not None else 'CAST(NULL AS STRING)'}")
    parts.append("END")
    return " ".join(parts)


_N = None  # NULL entry in a pick list

# The raw column names and their generating rules (FIXTURES.md §2).
_COLUMNS: list[tuple[str, str]] = [
    ("Patient_ID", "o_orderkey + 1 - CASE WHEN o_orderkey % 11 = 10 THEN 1 ELSE 0 END"),
    ("patient_id_1", _num(101, 9, 1, 999, 1)),
    ("Age", _num(211, 6, 1, 99, 1, [999, -5])),
    ("age_1", _num(223, 95, 20, 60, 1)),
    ("Gender", _pick(307, ["m", "Male", " F ", "female", "1", "0", "unknown", "Other", _N, "femal", "MAL"])),
    ("gender_1", _pick(311, [_N] * 8 + ["Male", "f"])),
    ("Ethnicity", _pick(401, ["White", "caucasian", "AA", "African American", "Latina", "Hispanic/Latino",
                              "ASIAN", "Chinese", "Other", "NA", _N])),
    ("Weight_kg", _num(503, 5, 450, 800, 10, [-13.1, 499.9])),
    ("Weight_lbs", _num(521, 6, 990, 1760, 10)),
    ("Height_cm", _num(601, 15, 1450, 500, 10, [5.6, 0, 228.4])),
    ("BMI", _num(701, 7, 150, 250, 10, ["Infinity", "-Infinity", 150])),
    ("blood_pressure",
     f"CASE WHEN {_h(809, 10)} = 0 THEN CAST(NULL AS STRING) WHEN {_h(809, 10)} = 1 THEN 'n/a' "
     f"ELSE CAST(80 + {_h(811, 100)} AS STRING) || CASE WHEN {_h(821, 2)} = 0 THEN '/' ELSE ' / ' END "
     f"|| CAST(50 + {_h(823, 60)} AS STRING) END"),
    ("Systolic_BP", _num(907, 9, 80, 100, 1, [7, 253])),
    ("Diastolic_BP", _num(919, 5, 50, 60, 1, [4, 157])),
    ("Heart_Rate", _num(1009, 11, 45, 70, 1, [500, -1])),
    ("Temperature_F", _num(1103, 12, 970, 40, 10, [0, 115])),
    ("Hemoglobin", _num(1201, 9, 90, 90, 10, [99, -1.09])),
    ("WBC_Count", _num(1301, 10, 3000, 8000, 1, [-4529, 999999])),
    ("ALT_Enzyme", _num(1409, 5, 0, 700, 10, [9999, -5, 0])),
    ("AST_Enzyme", _num(1423, 5, 50, 600, 10, [9999, -5])),
    ("Creatinine", _num(1511, 12, 40, 220, 100, [99, -1])),
    ("eGFR", _num(1601, 11, 150, 1100, 10, [999, -39.5])),
    ("HbA1c", _num(1709, 5, 40, 60, 10, [50, -3.1])),
    ("Total_Cholesterol", _num(1801, 12, 120, 200, 1, [1500, -10])),
    ("Drug_Name", _pick(1901, ["Metformin", "metformine", "met  formin", "Warfarin", "warfarine", "lisinipril",
                               "Lisinopril", "Atorvastain", "none", "N/A", _N, "Gabapentin", "insulin glargine"])),
    ("drug_name_1", _pick(1907, ["Metformin", "Warfarin", _N, "Sertraline", "N/A"])),
    ("Dosage", _pick(2003, ["100 mg", "50mg", "2x50mg", "500", "0.5 mg daily", "1,000 mg", "as needed", "--", _N,
                            "25", "750mg", "80 mcg"])),
    ("Duration_Days", _pick(2011, ["30", "60", "ongoing", "Chronic", "lifetime", "120", "12d", "-", _N, "4000"])),
    ("Route", _pick(2027, ["IV", "im", "sc", "Oral", "NA", _N, "oral "])),
    ("Concurrent_Drugs", _num(2111, 13, 0, 9, 1, [99, -5, 50])),
    ("Diagnosis", _pick(2203, ["htn", "DM2", "T2DM", "afib", "CKD", "oa", "hld", "chf", "Osteoporosis", "Unknown", _N])),
    ("Smoking_Status", _pick(2213, ["yes", "Y", "true", "1", "No", "n", "0", "Former", "ex-smoker", "current", _N,
                                    "unknown"])),
    ("Alcohol_Use", _pick(2221, ["Social", "Heavy", "None", "no", " Daily ", _N, "-"])),
    ("Admission_Date", _pick(2309, ["2020-02-23", "2022/06/10", "October 22, 2021", "12/08/2023", "not a date", _N])),
    ("Treatment_Outcome", _pick(2411, ["0"] * 6 + ["1", "1", "no", "Yes", "Effective", "Ineffective", "N/A", _N,
                                       "1.0", "2"])),
    ("Adverse_Event", _pick(2503, ["0", "0", "0", "1", "No", "yes", "true", "FALSE", _N, "?"])),
    ("Readmission_30d", _num(2609, 7, 0, 2, 1, [3])),
    ("Notes", _pick(2617, [_N] * 6 + ["See chart"])),
    ("Extra_Col_1", "CAST(NULL AS STRING)"),
    ("Extra_Col_2", "CAST(NULL AS STRING)"),
    ("unnamed_0", _num(2707, 10, 0, 1000, 1000)),
]

RAW_COLUMNS = [name for name, _ in _COLUMNS]
ORDER_COL = "row_ord"

_INNER = ["o_orderkey", "o_orderkey AS row_ord",
          "CASE WHEN o_orderkey % 33 IN (10, 21) THEN o_orderkey - 1 ELSE o_orderkey END AS k"]


def select_list() -> list[str]:
    return ["row_ord"] + [f"{expr} AS {name}" for name, expr in _COLUMNS]


def fixture_sql(source: str = "orders") -> str:
    """The shared SQL text (both dialects) of ``patients_raw``."""
    return f"SELECT {', '.join(select_list())} FROM (SELECT {', '.join(_INNER)} FROM {source}) src"


def patients_raw(orders: DataFrame) -> DataFrame:
    """Spark form: two projections over ``orders``; row_ord is the explicit source order."""
    return orders.selectExpr(*_INNER).selectExpr(*select_list())
