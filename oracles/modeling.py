"""Oracle texts for train-only preprocessing (fit on train rows, apply to test rows)."""
from __future__ import annotations

from wardstat.functions import vocab as V

from .catalog import add
from .clinical import with_ctes
from .splits import _J05

NUM, CAT, IQRC = V.NUMERIC_COLUMNS, V.CATEGORICAL_COLUMNS, V.IQR_COLUMNS


def _clip(c, src):
    lo = f"(tq.{c}_q1 - 1.5 * (tq.{c}_q3 - tq.{c}_q1))"
    hi = f"(tq.{c}_q3 + 1.5 * (tq.{c}_q3 - tq.{c}_q1))"
    return f"CASE WHEN {src}.{c} < {lo} THEN {lo} WHEN {src}.{c} > {hi} THEN {hi} ELSE {src}.{c} END AS {c}"


def _imp(src):
    return (f"SELECT {src}.patient_id, " + ", ".join(f"coalesce({src}.{c}, tmed.{c}) AS {c}" for c in NUM) + ", "
            + ", ".join(f"coalesce({src}.{c}, tmode.{c}) AS {c}" for c in CAT) + f" FROM {src}, tmed, tmode")


_T = _J05 + [
    ("tr", "SELECT p.* FROM labelled p JOIN assign a USING (patient_id) WHERE a.split = 'train'"),
    ("te", "SELECT p.* FROM labelled p JOIN assign a USING (patient_id) WHERE a.split = 'test'"),
    ("tmed", "SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in NUM) + " FROM tr"),
    ("tmode", "SELECT " + ", ".join(
        f"(SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}" for c in CAT)),
    ("timp", _imp("tr")),
    ("tq", "SELECT " + ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in IQRC)
     + " FROM timp"),
    ("tclip", "SELECT timp.* REPLACE (" + ", ".join(_clip(c, "timp") for c in IQRC) + ") FROM timp, tq"),
    ("tfs0", "SELECT median(dosage_mg) AS dosage_median, "
             "quantile_cont(CASE WHEN alt_enzyme > 0 THEN ast_enzyme / alt_enzyme END, 0.5) AS ratio_median FROM tclip"),
    ("trf", "SELECT coalesce(CASE WHEN alt_enzyme > 0 THEN ast_enzyme / alt_enzyme END, ratio_median) AS rf FROM tclip, tfs0"),
    ("tfs", "SELECT dosage_median, ratio_median, q1 AS ratio_q1, q3 AS ratio_q3, greatest(0.0, q1 - 1.5 * (q3 - q1)) AS ratio_lower, "
            "q3 + 1.5 * (q3 - q1) AS ratio_upper FROM tfs0, "
            "(SELECT quantile_cont(rf, 0.25) AS q1, quantile_cont(rf, 0.75) AS q3 FROM trf)"),
    ("teimp", _imp("te")),
    ("teclip", "SELECT teimp.* REPLACE (" + ", ".join(_clip(c, "teimp") for c in IQRC) + ") FROM teimp, tq"),
]


def _features(src):
    return f"""
SELECT {src}.*,
  CASE WHEN egfr >= 90 THEN 'Normal' WHEN egfr >= 60 AND egfr < 90 THEN 'Mild'
       WHEN egfr >= 30 AND egfr < 60 THEN 'Moderate' WHEN egfr < 30 THEN 'Severe' ELSE 'Unknown' END AS kidney_stage,
  CASE WHEN bmi < 18.5 THEN 'Underweight' WHEN bmi >= 18.5 AND bmi < 25 THEN 'Normal'
       WHEN bmi >= 25 AND bmi < 30 THEN 'Overweight' WHEN bmi >= 30 THEN 'Obese' ELSE 'Unknown' END AS bmi_category,
  CASE WHEN age < 18 THEN 'Pediatric' WHEN age >= 18 AND age < 35 THEN 'Young Adult'
       WHEN age >= 35 AND age < 65 THEN 'Middle Aged' WHEN age >= 65 AND age < 80 THEN 'Senior'
       WHEN age >= 80 THEN 'Elderly' ELSE 'Unknown' END AS age_group,
  CAST(coalesce(alt_enzyme > 40, false) OR coalesce(ast_enzyme > 40, false) AS INTEGER) AS liver_risk,
  CAST(coalesce(concurrent_drugs >= 5, false) AS INTEGER) AS polypharmacy,
  CAST(coalesce(age >= 65 AND dosage_mg > dosage_median, false) AS INTEGER) AS elderly_high_dose,
  least(greatest(coalesce(CASE WHEN alt_enzyme > 0 THEN ast_enzyme / alt_enzyme END, ratio_median), ratio_lower), ratio_upper) AS de_ritis_ratio
FROM {src}, tfs"""


_T += [("tefeat", _features("teclip")), ("trfeat", _features("tclip"))]


def tq(body):
    return with_ctes(["clean_det"], body, extra=_T)


add("fit_medians", tq(" UNION ALL ".join(f"SELECT '{c}' AS column, {c} AS median FROM tmed" for c in NUM)))
add("fit_modes", tq(" UNION ALL ".join(f"SELECT '{c}' AS column, {c} AS mode FROM tmode" for c in CAT)))
add("fit_iqr_limits", tq(" UNION ALL ".join(
    f"SELECT '{c}' AS column, {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) AS lower, {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) AS upper FROM tq"
    for c in IQRC)))
add("fit_ratio_stats", tq("SELECT * FROM tfs"))
_OUT = ["patient_id"] + V.PREDICTORS + V.ENGINEERED_COLUMNS
add("apply_stats", tq("SELECT " + ", ".join(_OUT) + " FROM tefeat"))
_FC = V.FEATURE_CATEGORICAL


def _ohe(drop_first):
    parts = []
    for c in _FC:
        cond = f"t.{c} IN (SELECT DISTINCT {c} FROM trfeat)"
        if drop_first:
            cond += f" AND t.{c} <> (SELECT min({c}) FROM trfeat)"
        parts.append(f"SELECT t.patient_id, '{c}' AS feature, t.{c} AS category FROM tefeat t WHERE {cond}")
    return tq(" UNION ALL ".join(parts))


add("one_hot", _ohe(False))
add("one_hot_drop_first", _ohe(True))
_FN = V.FEATURE_NUMERIC
add("standard_scale", tq("SELECT t.patient_id, " + ", ".join(
    f"(t.{c} - s.{c}_m) / CASE WHEN s.{c}_s = 0 THEN 1.0 ELSE s.{c}_s END AS {c}" for c in _FN)
    + " FROM tefeat t, (SELECT " + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in _FN)
    + " FROM trfeat) s"))

# Vector size = numeric features + one slot per train category; non-zeros = non-zero
# numeric values + categories of the row that were seen in train.
_NFEAT = " + ".join([str(len(_FN))] + [f"(SELECT count(DISTINCT {c}) FROM trfeat)" for c in _FC])
_NNZ = " + ".join([f"CASE WHEN t.{c} <> 0 THEN 1 ELSE 0 END" for c in _FN] +
                  [f"CASE WHEN t.{c} IN (SELECT DISTINCT {c} FROM trfeat) THEN 1 ELSE 0 END" for c in _FC])
add("assemble_features", tq(f"SELECT t.patient_id, CAST({_NFEAT} AS INTEGER) AS n_features, "
                            f"CAST({_NNZ} AS INTEGER) AS nnz FROM tefeat t"))

# position = numeric features first, then each column's train categories in order.
_SLOTS = " UNION ALL ".join(
    [f"SELECT {i} AS position, '{c}' AS name, '{c}' AS col, NULL AS category" for i, c in enumerate(_FN)]
    + [f"SELECT CAST({len(_FN)} + " + "".join(f"(SELECT count(DISTINCT {b}) FROM trfeat) + " for b in _FC[:i])
       + f"row_number() OVER (ORDER BY {c}) - 1 AS INTEGER), '{c}__ohe_' || {c}, '{c}', {c} FROM (SELECT DISTINCT {c} FROM trfeat WHERE {c} IS NOT NULL)"
       for i, c in enumerate(_FC)])
_ENTRIES = " UNION ALL ".join(
    [f"SELECT patient_id, '{c}' AS col, NULL AS category, CAST({c} AS DOUBLE) AS value FROM tefeat WHERE {c} <> 0" for c in _FN]
    + [f"SELECT patient_id, '{c}', {c}, 1.0 FROM tefeat" for c in _FC])
add("assemble_feature_values", tq(
    f"SELECT e.patient_id, s.position, s.name, e.value FROM ({_ENTRIES}) e JOIN ({_SLOTS}) s "
    "ON e.col = s.col AND e.category IS NOT DISTINCT FROM s.category"))
# A reloaded model gives every test row the same probability.
add("save_load_model", tq("SELECT count(*) AS joined_rows, CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, "
                          "CAST(0 AS DOUBLE) AS max_abs_diff, 1 AS all_close FROM te"))
_CONTRIB = """
WITH c AS (
  SELECT o_orderkey AS key, 'f1' AS feature, ((o_orderkey % 41) - 20) / CAST(64 AS DOUBLE) AS value FROM orders
  UNION ALL SELECT o_orderkey, 'f2', ((o_orderkey * 3) % 41 - 20) / CAST(64 AS DOUBLE) FROM orders
  UNION ALL SELECT o_orderkey, 'f3', ((o_orderkey * 7) % 41 - 20) / CAST(64 AS DOUBLE) FROM orders
  UNION ALL SELECT o_orderkey, 'f4', ((o_orderkey * 11) % 41 - 20) / CAST(64 AS DOUBLE) FROM orders
  UNION ALL SELECT o_orderkey, 'f5', ((o_orderkey * 19) % 41 - 20) / CAST(64 AS DOUBLE) FROM orders
  UNION ALL SELECT o_orderkey, 'price', (CAST(floor(o_totalprice) AS BIGINT) % 97 - 48) / CAST(128 AS DOUBLE) FROM orders
  UNION ALL SELECT o_orderkey, '__base__', CAST(0.25 AS DOUBLE) FROM orders)
"""
add("additivity_check_orders", _CONTRIB + """,
 t AS (SELECT key, sum(value) AS total, sum(value) + (key % 5) / CAST(64 AS DOUBLE) AS margin FROM c GROUP BY key)
SELECT count(*) AS rows, max(abs(total - margin)) AS max_margin_diff,
       max(abs(1 / (1 + exp(-2 * total)) - 1 / (1 + exp(-2 * margin)))) AS max_probability_diff FROM t""")
add("mean_abs_contribution_orders", _CONTRIB + """
SELECT feature, avg(abs(value)) AS mean_abs_contribution FROM c WHERE feature <> '__base__'
GROUP BY feature ORDER BY 2 DESC, 1 LIMIT 4""")
add("row_contributions_orders", _CONTRIB + """
SELECT key, feature, value FROM c WHERE key = (SELECT min(o_orderkey) FROM orders) AND feature <> '__base__'
ORDER BY abs(value) DESC, feature LIMIT 3""")
