"""Oracle texts for sources/sinks, profiling and validation."""
from __future__ import annotations

from wardstat.functions import vocab as V
from wardstat.sources.fixture import RAW_COLUMNS

from .catalog import add
from wardstat.plans.clinical import RAW_TO_CANON

from .clinical import ph, with_ctes

LNUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

add("csv_ingest", "SELECT * FROM nation")
add("csv_ingest_orders", "SELECT * FROM orders")
add("parquet_scan", "SELECT * FROM lineitem")
add("pruned_scan", "SELECT l_orderkey, l_extendedprice FROM lineitem")
add("table_shape", " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, (SELECT count(*) FROM {t}) AS n_rows, "
    f"(SELECT count(*) FROM duckdb_columns() WHERE table_name = '{t}') AS n_cols"
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()))
add("parquet_sink", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
add("csv_sink", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
add("table_load", with_ctes(["clean_det"], "SELECT * EXCLUDE (row_ord) FROM clean_det"))
add("head_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")

_LCOLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
          "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_ROLE = {"l_returnflag": "categorical", "l_linestatus": "categorical", "l_shipdate": "unsupported"}
_DTYPE = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def _profile(cols: list[str], table: str) -> str:
    kind = "CASE typeof(any_value({0})) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _DTYPE.items()) + " END"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, {kind.format(c)} AS dtype, CASE typeof(any_value({c})) WHEN 'VARCHAR' THEN 'categorical' "
        f"WHEN 'DATE' THEN 'unsupported' WHEN 'TIMESTAMP' THEN 'unsupported' ELSE 'numeric' END AS role, count({c}) AS non_null, "
        f"count(DISTINCT {c}) AS n_distinct FROM {table}" for c in cols)


add("column_profile", with_ctes(["patients_raw"], _profile(_LCOLS, "lineitem") + " UNION ALL " + _profile(list(RAW_COLUMNS), "patients_raw")))
_RAWC = [c for c in RAW_COLUMNS]
add("null_profile", with_ctes(["patients_raw"], " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing, "
    f"CASE WHEN count(*) > 0 THEN round(100.0 * sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / count(*), 6) ELSE 0.0 END AS missing_pct "
    f"FROM patients_raw" for c in _RAWC)))
_ALL = ", ".join(_RAWC)
add("exact_dup_count", with_ctes(["patients_raw"],
                                 f"SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS exact_duplicates FROM "
                                 f"(SELECT count(*) AS c FROM patients_raw GROUP BY {_ALL})"))
add("value_counts", with_ctes(["patients_raw"], """
SELECT coalesce(Gender, '<MISSING>') AS value, count(*) AS count,
       round(100.0 * count(*) / (SELECT count(*) FROM patients_raw), 6) AS pct
FROM patients_raw GROUP BY 1"""))
_RAWNUM = ["patient_id_1", "Age", "age_1", "Weight_kg", "Weight_lbs", "Height_cm", "BMI", "Systolic_BP",
           "Diastolic_BP", "Heart_Rate", "Temperature_F", "Hemoglobin", "WBC_Count", "ALT_Enzyme", "AST_Enzyme",
           "Creatinine", "eGFR", "HbA1c", "Total_Cholesterol", "Concurrent_Drugs", "Readmission_30d", "unnamed_0"]
add("inf_profile", with_ctes(["patients_raw"], " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(sum(CASE WHEN {c} = 'Infinity'::DOUBLE THEN 1 ELSE 0 END) AS BIGINT) AS pos_inf, "
    f"CAST(sum(CASE WHEN {c} = '-Infinity'::DOUBLE THEN 1 ELSE 0 END) AS BIGINT) AS neg_inf FROM patients_raw"
    for c in _RAWNUM)))
add("seeded_sample", "SELECT * FROM orders ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))) LIMIT 1000")


def _describe(c: str, table: str) -> str:
    """Infinities: the mean follows them, the deviation is undefined."""
    odd = f"count(*) FILTER (WHERE NOT isfinite({c})) > 0"
    mean = (f"CASE WHEN count(*) FILTER (WHERE {c} = 'Infinity'::DOUBLE) > 0 AND count(*) FILTER (WHERE {c} = '-Infinity'::DOUBLE) > 0 "
            f"THEN 'NaN'::DOUBLE WHEN count(*) FILTER (WHERE {c} = 'Infinity'::DOUBLE) > 0 THEN 'Infinity'::DOUBLE "
            f"WHEN {odd} THEN '-Infinity'::DOUBLE ELSE avg({c}) FILTER (WHERE isfinite({c})) END")
    return (f"SELECT '{c}' AS column, count({c}) AS count, {mean} AS mean, CASE WHEN {odd} THEN 'NaN'::DOUBLE "
            f"ELSE stddev_samp({c}) FILTER (WHERE isfinite({c})) END AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS q25, "
            f"quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM {table}")


def _histogram(c: str, table: str) -> str:
    return f"""
SELECT '{c}' AS column, CAST(g.bin AS INTEGER) AS bin, lo + g.bin * (hi - lo) / 50 AS bin_start, count(v.bin) AS count
FROM range(50) g(bin) CROSS JOIN (SELECT min({c}) AS lo, max({c}) AS hi FROM {table} WHERE isfinite({c})) m
LEFT JOIN (SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor(({c} - lo) / ((hi - lo) / 50)), 49) END AS bin
  FROM {table}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {table} WHERE isfinite({c})) WHERE isfinite({c})) v
ON v.bin = g.bin GROUP BY g.bin, lo, hi"""


def _corr(cols: list[str], table: str) -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    r = "corr({0}, {1}) FILTER (WHERE isfinite({0}) AND isfinite({1}))"
    return " UNION ALL ".join([f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r.format(a, b)} AS r FROM {table}" for a, b in pairs] +
                              [f"SELECT '{b}', '{a}', {r.format(a, b)} FROM {table}" for a, b in pairs] +
                              [f"SELECT '{c}', '{c}', 1.0::DOUBLE" for c in cols])


for _key, _fn in (("numeric_describe", _describe), ("histogram", _histogram)):
    add(_key, with_ctes(["patients_raw"], " UNION ALL ".join([_fn(c, "lineitem") for c in LNUM] + [_fn(c, "patients_raw") for c in _RAWNUM])))
add("corr_matrix", with_ctes(["patients_raw"], _corr(LNUM, "lineitem") + " UNION ALL " + _corr(_RAWNUM, "patients_raw")))
add("key_profile", with_ctes(["patients_raw"], f"""
SELECT total_rows, distinct_keys, total_rows - distinct_keys AS extra_key_rows, exact_duplicates,
       greatest(total_rows - distinct_keys - exact_duplicates, 0) AS non_identical_repeats
FROM (SELECT count(*) AS total_rows, count(DISTINCT Patient_ID) AS distinct_keys FROM patients_raw),
     (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS exact_duplicates FROM (SELECT count(*) AS c FROM patients_raw GROUP BY {_ALL}))"""))
add("constant_columns", with_ctes(["patients_raw"], "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM patients_raw)) AS n_values"
    for c in _RAWC) + ") WHERE n_values <= 1"))


def checks(rows):
    return " UNION ALL ".join(
        f"SELECT '{n}' AS check, CAST({o} AS BIGINT) AS observed, CAST({e} AS BIGINT) AS expected, "
        f"CAST(coalesce(({o}) = ({e}), false) AS INTEGER) AS passed" + (f" FROM {src}" if src else "")
        for n, o, e, src in rows)


add("key_integrity", checks([
    ("null_keys", "sum(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END)", "0", "orders"),
    ("duplicate_keys", "count(o_orderkey) - count(DISTINCT o_orderkey)", "0", "orders")]))
add("integer_key", with_ctes(["patients_raw"], checks([
    ("non_integer_keys", "sum(CASE WHEN patient_id_1 IS NOT NULL AND patient_id_1 % 1 <> 0 THEN 1 ELSE 0 END)", "0", "patients_raw"),
    ("non_numeric_keys", "0", "0", None)])))
add("shape_expectation", """
SELECT s.dataset, s.n_rows, CAST(s.n_cols AS BIGINT) AS n_cols, CAST(e.exp_rows AS BIGINT) AS exp_rows,
       CAST(e.exp_cols AS BIGINT) AS exp_cols,
       CAST((e.exp_rows IS NULL OR s.n_rows = e.exp_rows) AND (e.exp_cols IS NULL OR s.n_cols = e.exp_cols) AS INTEGER) AS passed
FROM (SELECT 'region' AS dataset, (SELECT count(*) FROM region) AS n_rows, 2 AS n_cols
      UNION ALL SELECT 'nation', (SELECT count(*) FROM nation), 3
      UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), 6
      UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), 11) s
LEFT JOIN (SELECT 'region' AS dataset, 5 AS exp_rows, 2 AS exp_cols UNION ALL SELECT 'nation', 25, 3
           UNION ALL SELECT 'orders', NULL, 6 UNION ALL SELECT 'lineitem', NULL, 11) e USING (dataset)""")
add("lineage_audit", with_ctes(["clean_det"], """
SELECT * FROM audit UNION ALL SELECT 'overall', CAST(sum(passed) AS BIGINT), count(*), CAST(min(passed) AS INTEGER) FROM audit""", extra=[
    ("r", "SELECT count(*) AS raw_rows, count(DISTINCT Patient_ID) AS raw_keys FROM patients_raw"),
    ("c", "SELECT count(*) AS clean_rows, count(DISTINCT patient_id) AS clean_keys FROM clean_det"),
    ("audit", """
SELECT 'row_reduction_equals_repeated_keys' AS check, CAST(raw_rows - clean_rows AS BIGINT) AS observed,
       CAST(raw_rows - raw_keys AS BIGINT) AS expected, CAST(raw_rows - clean_rows = raw_rows - raw_keys AS INTEGER) AS passed FROM r, c
UNION ALL SELECT 'clean_rows_equal_distinct_keys', clean_rows, clean_keys, CAST(clean_rows = clean_keys AS INTEGER) FROM r, c
UNION ALL SELECT 'clean_keys_equal_raw_keys', clean_keys, raw_keys, CAST(clean_keys = raw_keys AS INTEGER) FROM r, c
UNION ALL SELECT 'clean_column_count', 31, 31, 1""")]))
add("key_set_diff", """
SELECT (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM orders EXCEPT SELECT DISTINCT c_custkey FROM customer)) AS only_in_a,
       (SELECT count(*) FROM (SELECT DISTINCT c_custkey FROM customer EXCEPT SELECT DISTINCT o_custkey FROM orders)) AS only_in_b""")
add("value_agreement", with_ctes(["clean_det", "clean_full"], """
SELECT count(*) AS matched_keys,
       CAST(sum(CASE WHEN a.treatment_outcome IS NOT DISTINCT FROM b.treatment_outcome THEN 0 ELSE 1 END) AS BIGINT) AS mismatches,
       CAST(sum(CASE WHEN a.treatment_outcome IS NULL AND b.treatment_outcome IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS both_null
FROM clean_det a JOIN clean_full b USING (patient_id)"""))
add("value_agreement_samples", with_ctes(["clean_det", "clean_full"], """
SELECT patient_id, a.bmi AS value_a, b.bmi AS value_b FROM clean_det a JOIN clean_full b USING (patient_id)
WHERE a.bmi IS DISTINCT FROM b.bmi ORDER BY patient_id LIMIT 10"""))
_NUMRE = "'[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?'"


def _failed(c: str) -> tuple[str, str]:
    """(whether a raw value is lost in conversion, its text)."""
    if c in ("Dosage", "Duration_Days"):
        return f"{ph(c)} IS NOT NULL AND NOT regexp_full_match(trim({c}), {_NUMRE})", ph(c)
    return (f"{c} IS NOT NULL AND NOT isfinite({c})",
            f"CASE WHEN isnan({c}) THEN 'nan' WHEN {c} > 0 THEN 'inf' ELSE '-inf' END")


add("conversion_failures", with_ctes(["patients_raw"], " UNION ALL ".join(
    f"SELECT '{c}' AS column, (SELECT count(*) FROM patients_raw WHERE {bad}) AS failures, coalesce((SELECT string_agg(v, '|' ORDER BY row_ord) "
    f"FROM (SELECT {text} AS v, row_ord FROM patients_raw WHERE {bad} ORDER BY row_ord LIMIT 5)), '') AS samples"
    for c in [*RAW_TO_CANON, "Dosage", "Duration_Days"] for bad, text in [_failed(c)])))
add("non_finite_values", with_ctes(["patients_raw"], " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(sum(CASE WHEN {c} IS NOT NULL AND (isnan({c}) OR isinf({c})) THEN 1 ELSE 0 END) AS BIGINT) "
    f"AS non_finite FROM patients_raw" for c in RAW_TO_CANON)))
add("row_order", "SELECT o_orderkey, row_number() OVER () - 1 AS row_order FROM orders")
add("domain_check", " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(sum(CASE WHEN {c} IS NOT NULL AND {c} NOT IN (0, 1) THEN 1 ELSE 0 END) AS BIGINT) AS outside FROM labels"
    for c in ("quality", "toxic")))
add("text_length_check", with_ctes(["clean_det"], " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST({lim} AS BIGINT) AS limit, CAST(max(length({c})) AS BIGINT) AS max_length, "
    f"CAST(sum(CASE WHEN length({c}) > {lim} THEN 1 ELSE 0 END) AS BIGINT) AS over_limit FROM clean_det"
    for c, lim in V.TEXT_LIMITS.items())))
add("date_only_check", " UNION ALL ".join(
    f"SELECT '{lbl}' AS column, count({c}) AS non_null, CAST(0 AS BIGINT) AS conversion_failures, "
    f"CAST(sum(CASE WHEN date_trunc('day', {c}) <> {c} THEN 1 ELSE 0 END) AS BIGINT) AS with_time_of_day FROM {t}"
    for lbl, c, t in (("events.ts", "ts", "events"), ("orders.o_orderdate", "o_orderdate", "orders"))))
_CLEANC = V.FINAL_COLUMNS
add("null_profile_diff", with_ctes(["clean_det", "clean_full"], " UNION ALL ".join(
    f"SELECT '{c}' AS column, (SELECT CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM clean_det) AS missing_before, "
    f"(SELECT CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM clean_full) AS missing_after, "
    f"(SELECT CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM clean_full) - "
    f"(SELECT CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM clean_det) AS change" for c in _CLEANC)))
_BD = " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zero, "
    f"CAST(sum(CASE WHEN {c} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_one, "
    f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null FROM clean_det" for c in V.OUTCOME_COLUMNS)
add("binary_distribution", with_ctes(["clean_det"], _BD))
_LP = (["SELECT 'rows' AS metric, count(*) AS v FROM clean_det",
        "SELECT 'distinct_keys', count(DISTINCT patient_id) FROM clean_det"] +
       [f"SELECT 'nulls:{c}', CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM clean_det" for c in _CLEANC] +
       [f"SELECT '{c}:{lab}', CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) FROM clean_det"
        for c in V.OUTCOME_COLUMNS for lab, cond in (("0", f"{c} = 0"), ("1", f"{c} = 1"), ("null", f"{c} IS NULL"))])
add("load_parity", with_ctes(["clean_det"], "SELECT metric, v AS source_value, v AS stored_value, 1 AS passed FROM ("
                             + " UNION ALL ".join(_LP) + ")"))
add("probability_validity", """
WITH s AS (SELECT round(o_totalprice / 500000.0, 2) AS p FROM orders)
SELECT 'not_finite' AS check, CAST(sum(CASE WHEN p IS NULL OR isnan(p) OR isinf(p) THEN 1 ELSE 0 END) AS BIGINT) AS observed, CAST(0 AS BIGINT) AS expected,
       CAST(sum(CASE WHEN p IS NULL OR isnan(p) OR isinf(p) THEN 1 ELSE 0 END) = 0 AS INTEGER) AS passed FROM s
UNION ALL SELECT 'below_zero', CAST(sum(CASE WHEN p < 0 THEN 1 ELSE 0 END) AS BIGINT), 0, CAST(sum(CASE WHEN p < 0 THEN 1 ELSE 0 END) = 0 AS INTEGER) FROM s
UNION ALL SELECT 'above_one', CAST(sum(CASE WHEN p > 1 THEN 1 ELSE 0 END) AS BIGINT), 0, CAST(sum(CASE WHEN p > 1 THEN 1 ELSE 0 END) = 0 AS INTEGER) FROM s
UNION ALL SELECT 'row_count', count(*), (SELECT count(*) FROM orders), 1 FROM s""")
add("score_alignment", """
WITH a AS (SELECT o_orderkey AS k, o_orderkey % 3 = 0 AS y, round(o_totalprice / 500000.0, 2) AS p FROM orders),
     b AS (SELECT o_orderkey AS k, o_orderkey % 3 = 0 AS y, o_totalprice * 0.000002 AS q FROM orders),
     j AS (SELECT a.k AS ka, b.k AS kb, abs(p - q) AS d FROM a FULL JOIN b ON a.k = b.k AND a.y = b.y)
SELECT count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL) AS joined_rows, count(*) FILTER (WHERE kb IS NULL) AS only_left,
       count(*) FILTER (WHERE ka IS NULL) AS only_right, max(d) AS max_abs_diff,
       CAST(min(CASE WHEN d <= 0.005 THEN 1 ELSE 0 END) AS INTEGER) AS all_close
FROM j""")
