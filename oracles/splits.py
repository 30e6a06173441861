"""Oracle texts for splits, joins, requests and the prediction log (plain row_number forms)."""
from __future__ import annotations

from wardstat.functions import vocab as V
from wardstat.streaming.requests import REQUEST_BODY_SQL

from . import analytics as S
from .catalog import add
from .clinical import with_ctes


def stage(name, src, key, label, frac, stg):
    return [
        (f"{name}_b", f"SELECT {key} AS key, {label} AS label, md5(concat_ws('|', '42', '{stg}', CAST({key} AS VARCHAR))) AS h FROM {src}"),
        (f"{name}_c", f"SELECT label, count(*) AS n FROM {name}_b GROUP BY label"),
        (f"{name}_t", f"SELECT sum(n) AS nn, CAST(ceil(CAST({frac} AS DOUBLE) * sum(n)) AS BIGINT) AS t FROM {name}_c"),
        (f"{name}_q0", f"SELECT label, floor(t * n / nn) AS bq, t * n / nn - floor(t * n / nn) AS rem, t FROM {name}_c, {name}_t"),
        (f"{name}_q", f"SELECT label, bq + CASE WHEN row_number() OVER (ORDER BY rem DESC, CAST(label AS VARCHAR)) "
                      f"<= t - sum(bq) OVER () THEN 1 ELSE 0 END AS quota FROM {name}_q0"),
        (name, f"SELECT b.key, b.label, row_number() OVER (PARTITION BY b.label ORDER BY h) <= q.quota AS selected "
               f"FROM {name}_b b JOIN {name}_q q USING (label)"),
    ]


def ctes(parts):
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in parts) + "\n"


add("stratified_split_2", ctes(stage("s1", "orders", "o_orderkey", "o_orderstatus", 0.2, "test")) +
    "SELECT key AS o_orderkey, label AS o_orderstatus, CASE WHEN selected THEN 'test' ELSE 'train' END AS split FROM s1")

_LAB = ("labelled", "SELECT * EXCLUDE (row_ord) FROM clean_det WHERE treatment_outcome IS NOT NULL")
_J05 = [_LAB] + stage("s1", "labelled", "patient_id", "treatment_outcome", 0.2, "test") + [
    ("rest", "SELECT key AS patient_id, label AS treatment_outcome FROM s1 WHERE NOT selected")] + \
    stage("s2", "rest", "patient_id", "treatment_outcome", 0.25, "validation") + [
    ("assign", "SELECT key AS patient_id, label AS treatment_outcome, 'test' AS split FROM s1 WHERE selected "
               "UNION ALL SELECT key, label, CASE WHEN selected THEN 'validation' ELSE 'train' END FROM s2")]


def j05(body):
    return with_ctes(["clean_det"], body, extra=_J05)


add("stratified_split_3", j05("SELECT * FROM assign"))
add("stratified_split_3b", with_ctes(["clean_det"], """
SELECT key AS patient_id, label AS treatment_outcome, 'train' AS split FROM h1 WHERE NOT selected
UNION ALL SELECT key, label, CASE WHEN selected THEN 'test' ELSE 'validation' END FROM h2""", extra=[_LAB] +
    stage("h1", "labelled", "patient_id", "treatment_outcome", 0.4, "holdout") +
    [("hold", "SELECT key AS patient_id, label AS treatment_outcome FROM h1 WHERE selected")] +
    stage("h2", "hold", "patient_id", "treatment_outcome", 0.5, "halve")))
add("split_assignments", j05("SELECT patient_id, split FROM assign"))
add("join_one_to_one", j05("SELECT a.split, row_number() OVER (ORDER BY a.split, a.patient_id) - 1 AS assignment_order, p.* "
                                "FROM assign a JOIN labelled p USING (patient_id)"))
add("join_left_check", with_ctes(["clean_full", "clean_det"], """
SELECT count(*) AS reference_rows,
       CAST(sum(CASE WHEN n.patient_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_in_new,
       CAST(sum(CASE WHEN n.patient_id IS NOT NULL AND r.treatment_outcome IS DISTINCT FROM n.treatment_outcome THEN 1 ELSE 0 END) AS BIGINT) AS target_mismatches
FROM (SELECT patient_id, treatment_outcome FROM clean_full WHERE treatment_outcome IS NOT NULL) r
LEFT JOIN clean_det n USING (patient_id)"""))
add("join_scores", """
SELECT o_orderkey AS key, CAST(o_orderkey % 3 = 0 AS INTEGER) AS y,
       round(o_totalprice / 500000.0, 2) AS price_probability,
       round((o_custkey % 100) / 100.0, 2) AS customer_probability,
       CAST(CASE WHEN starts_with(o_orderpriority, '1') THEN 0.9 ELSE 0.2 END AS DOUBLE) AS priority_probability
FROM orders""")
add("split_summary", j05("""
SELECT split, count(*) AS rows, CAST(sum(CASE WHEN treatment_outcome = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zero,
       CAST(sum(CASE WHEN treatment_outcome = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_one,
       round(100.0 * sum(CASE WHEN treatment_outcome = 0 THEN 1 ELSE 0 END) / count(*), 6) AS pct_zero,
       round(100.0 * sum(CASE WHEN treatment_outcome = 1 THEN 1 ELSE 0 END) / count(*), 6) AS pct_one
FROM assign GROUP BY split"""))
add("class_weights", j05("""
SELECT a.patient_id, a.treatment_outcome, w.weight FROM assign a JOIN (
  SELECT treatment_outcome, (SELECT count(*) FROM assign WHERE split = 'train') /
         ((SELECT count(DISTINCT treatment_outcome) FROM assign WHERE split = 'train') * count(*)) AS weight
  FROM assign WHERE split = 'train' GROUP BY treatment_outcome) w USING (treatment_outcome)
WHERE a.split = 'train'"""))
_PAIRS = [("train", "validation"), ("train", "test"), ("validation", "test")]
_INTEGRITY = [(f"overlap_{x}_{y}", f"(SELECT count(*) FROM (SELECT patient_id FROM assign WHERE split = '{x}' INTERSECT "
               f"SELECT patient_id FROM assign WHERE split = '{y}'))", "0") for x, y in _PAIRS] + [
    ("keys_assigned_more_than_once", "(SELECT count(*) FROM (SELECT patient_id FROM assign GROUP BY 1 HAVING count(*) > 1))", "0"),
    ("labelled_keys_missing", "(SELECT count(*) FROM (SELECT patient_id FROM labelled EXCEPT SELECT patient_id FROM assign))", "0"),
    ("assigned_keys_not_labelled", "(SELECT count(*) FROM (SELECT patient_id FROM assign EXCEPT SELECT patient_id FROM labelled))", "0"),
    ("invalid_split_labels", "(SELECT count(*) FROM assign WHERE split NOT IN ('train', 'validation', 'test'))", "0"),
    ("rows_train", "(SELECT count(*) FROM assign WHERE split = 'train')", "(SELECT n - t - v FROM expect)"),
    ("rows_validation", "(SELECT count(*) FROM assign WHERE split = 'validation')", "(SELECT v FROM expect)"),
    ("rows_test", "(SELECT count(*) FROM assign WHERE split = 'test')", "(SELECT t FROM expect)")]
add("split_integrity", with_ctes(["clean_det"], "SELECT \"check\", CAST(observed AS BIGINT) AS observed, CAST(expected AS BIGINT) AS expected, "
    "CAST(observed = expected AS INTEGER) AS passed FROM (" + " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", {o} AS observed, {e} AS expected" for n, o, e in _INTEGRITY) + ")", extra=_J05 + [
    ("expect", "SELECT n, t, CAST(ceil((n - t) * 0.25) AS BIGINT) AS v FROM (SELECT count(DISTINCT patient_id) AS n, "
               "CAST(ceil(count(DISTINCT patient_id) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS t FROM labelled)")]))

_REQ = f"SELECT event_id AS request_id, ts AS received_at, {REQUEST_BODY_SQL} AS body, value AS score_hint FROM events"
_STATUS = """
SELECT request_id, received_at, score_hint,
  CASE WHEN body IS NULL OR NOT regexp_matches(body, '"patient_id"\\s*:') THEN 'missing_id'
       WHEN pid IS NULL THEN 'not_integer' WHEN pid <= 0 THEN 'not_positive' ELSE 'ok' END AS status,
  CASE WHEN regexp_matches(body, '"patient_id"\\s*:') AND pid > 0 THEN pid END AS patient_id
FROM (SELECT *, CASE WHEN regexp_matches(body, '"patient_id"\\s*:\\s*"') AND regexp_full_match(trim(v), '[0-9]+') THEN TRY_CAST(trim(v) AS BIGINT)
                     WHEN NOT regexp_matches(body, '"patient_id"\\s*:\\s*"') AND regexp_full_match(v, '-?[0-9]+') THEN TRY_CAST(v AS BIGINT) END AS pid
      FROM (SELECT *, json_extract_string(body, '$.patient_id') AS v FROM req))"""
add("stream_validate_requests", f"WITH req AS ({_REQ}) SELECT request_id, status, patient_id FROM ({_STATUS})")

_LOG = [("req", _REQ), ("st", _STATUS), ("log", f"""
SELECT CAST(row_number() OVER (ORDER BY received_at, s.patient_id, request_id) AS BIGINT) AS prediction_id,
       s.patient_id, 'request_score_hint' AS model_name, '1' AS model_version,
       score_hint / 50.0 AS probability_effective, CAST(0.5 AS DOUBLE) AS cutoff,
       CAST(score_hint / 50.0 >= 0.5 AS INTEGER) AS predicted_class,
       CASE WHEN score_hint / 50.0 >= 0.5 THEN 'Effective' ELSE 'Ineffective' END AS predicted_outcome,
       received_at AS predicted_at
FROM st s JOIN clean_det p ON p.patient_id = s.patient_id
WHERE s.status = 'ok' AND score_hint / 50.0 BETWEEN 0 AND 1 AND NOT isnan(score_hint / 50.0)""")]


def logq(body):
    return with_ctes(["clean_det"], body, extra=_LOG)


add("prediction_log", logq("SELECT * FROM log"))
add("prediction_log_append", logq("SELECT * FROM log"))
# every request's outcome; a fitted model's probability is always valid
add("stream_outcomes", logq("""
SELECT s.request_id, s.patient_id,
  CASE WHEN s.status <> 'ok' THEN s.status WHEN p.patient_id IS NULL THEN 'not_found' ELSE 'scored' END AS outcome
FROM st s LEFT JOIN clean_det p ON p.patient_id = s.patient_id"""))
add("stream_validation", f"WITH req AS ({_REQ}) SELECT request_id, status, patient_id FROM ({_STATUS})")
add("latest_predictions", logq(S.LATEST))
add("prediction_context", logq(S.CONTEXT))
add("prediction_history", logq(S.history(100)))
add("point_lookup", with_ctes(["clean_det"], "SELECT patient_id, " + ", ".join(V.PREDICTORS) +
                              " FROM clean_det WHERE patient_id = 100"))
add("labelled_filter", with_ctes(["clean_full"], """
SELECT CAST(sum(CASE WHEN treatment_outcome IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN treatment_outcome IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS removed FROM clean_full"""))
add("leakage_projection", with_ctes(["engineered"], "SELECT * EXCLUDE (row_ord, " + ", ".join(V.LEAKAGE_COLUMNS) + ") FROM engineered"))
add("stream_prediction_counts", logq("SELECT count(*) AS prediction_count FROM log"))
