"""Oracle texts for metrics (plain windows over the whole score table) and association."""
from __future__ import annotations

from wardstat.functions import vocab as V

from .catalog import add
from .clinical import with_ctes
from .splits import stage

_SC = ([("ybase", "SELECT o_orderkey AS key, CAST(o_orderkey % 3 = 0 AS INTEGER) AS y FROM orders")] +
       stage("m1", "ybase", "key", "y", 0.2, "test") +
       [("mrest", "SELECT key, label AS y FROM m1 WHERE NOT selected")] +
       stage("m2", "mrest", "key", "y", 0.25, "validation") +
       [("massign", "SELECT key, 'test' AS split FROM m1 WHERE selected UNION ALL "
                    "SELECT key, CASE WHEN selected THEN 'validation' ELSE 'train' END FROM m2"),
        ("scores", """
SELECT 'price' AS model, a.split, o_orderkey AS key, CAST(o_orderkey % 3 = 0 AS INTEGER) AS y,
       CAST(round(o_totalprice / 500000.0, 2) AS DOUBLE) AS prob FROM orders JOIN massign a ON a.key = o_orderkey
UNION ALL SELECT 'customer', a.split, o_orderkey, CAST(o_orderkey % 3 = 0 AS INTEGER),
       CAST(round((o_custkey % 100) / 100.0, 2) AS DOUBLE) FROM orders JOIN massign a ON a.key = o_orderkey
UNION ALL SELECT 'priority', a.split, o_orderkey, CAST(o_orderkey % 3 = 0 AS INTEGER),
       CAST(CASE WHEN starts_with(o_orderpriority, '1') THEN 0.9 ELSE 0.2 END AS DOUBLE) FROM orders JOIN massign a ON a.key = o_orderkey"""),
        ("cm", """
SELECT model, split,
  CAST(sum(CASE WHEN prob < 0.5 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN prob >= 0.5 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN prob < 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN prob >= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
FROM scores GROUP BY model, split"""),
        ("tm", """
SELECT *, CASE WHEN tp + tn + fp + fn = 0 THEN 0.0 ELSE (tp + tn) / (tp + tn + fp + fn) END AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM cm"""),
        ("sc", """
SELECT model, split, prob, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos,
       CAST(sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_neg FROM scores GROUP BY model, split, prob"""),
        ("cum", """
SELECT *, pos_total - pos_below AS tp_at, neg_total - neg_below AS fp_at FROM (
  SELECT *, sum(n_pos) OVER w - n_pos AS pos_below, sum(n_neg) OVER w - n_neg AS neg_below,
         sum(n_pos) OVER (PARTITION BY model, split) AS pos_total, sum(n_neg) OVER (PARTITION BY model, split) AS neg_total
  FROM sc WINDOW w AS (PARTITION BY model, split ORDER BY prob ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""),
        ("auc", """
SELECT model, split, CASE WHEN max(pos_total) = 0 OR max(neg_total) = 0 THEN NULL ELSE
  (sum(n_pos * (pos_below + neg_below + (n_pos + n_neg + 1) / 2.0)) - max(pos_total) * (max(pos_total) + 1) / 2.0)
  / (max(pos_total) * max(neg_total)) END AS roc_auc FROM cum GROUP BY model, split"""),
        ("ap", """
SELECT model, split, CASE WHEN max(pos_total) = 0 THEN 0.0 ELSE sum(n_pos * tp_at / (tp_at + fp_at)) / max(pos_total) END
  AS average_precision FROM cum GROUP BY model, split"""),
        ("summary", "SELECT t.model, t.split, accuracy, precision, recall, f1, roc_auc, average_precision "
                    "FROM tm t JOIN auc USING (model, split) JOIN ap USING (model, split)"),
        ("morder", "SELECT 'price' AS model, 1 AS position UNION ALL SELECT 'customer', 2 UNION ALL SELECT 'priority', 3"),
        ("th", "SELECT i AS idx, (30 + i) / 100.0 AS threshold FROM range(51) r(i)"),
        ("sweep", """
SELECT model, split, CAST(threshold AS DOUBLE) AS threshold, tp, fp, fn, tn,
  CASE WHEN tp + tn + fp + fn = 0 THEN 0.0 ELSE (tp + tn) / (tp + tn + fp + fn) END AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, position AS config
FROM (SELECT model, split, threshold,
        CAST(sum(CASE WHEN prob >= CAST(threshold AS DOUBLE) AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
        CAST(sum(CASE WHEN prob >= CAST(threshold AS DOUBLE) AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
        CAST(sum(CASE WHEN prob < CAST(threshold AS DOUBLE) AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
        CAST(sum(CASE WHEN prob < CAST(threshold AS DOUBLE) AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn
      FROM scores, th WHERE split = 'validation' GROUP BY model, split, threshold) JOIN morder USING (model)""")])


def mq(body):
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in _SC) + "\n" + body


add("confusion_matrix", mq("SELECT * FROM cm"))
add("threshold_metrics", mq("SELECT * FROM tm"))
add("roc_auc", mq("SELECT * FROM auc"))
add("average_precision", mq("SELECT * FROM ap"))
add("roc_curve", mq("SELECT model, split, prob AS threshold, CASE WHEN neg_total = 0 THEN 0.0 ELSE fp_at / neg_total END AS fpr, "
                    "CASE WHEN pos_total = 0 THEN 0.0 ELSE tp_at / pos_total END AS tpr FROM cum "
                    "UNION ALL SELECT DISTINCT model, split, CAST('Infinity' AS DOUBLE), 0.0, 0.0 FROM cum"))
add("pr_curve", mq("SELECT model, split, prob AS threshold, CASE WHEN tp_at + fp_at = 0 THEN 0.0 ELSE tp_at / (tp_at + fp_at) END AS precision, "
                   "CASE WHEN pos_total = 0 THEN 0.0 ELSE tp_at / pos_total END AS recall FROM cum "
                   "UNION ALL SELECT DISTINCT model, split, CAST('Infinity' AS DOUBLE), 1.0, 0.0 FROM cum"))
add("classification_report", mq("""
SELECT * FROM per
UNION ALL SELECT model, split, 'accuracy', NULL, NULL, (SELECT accuracy FROM tm WHERE tm.model = per.model AND tm.split = per.split), CAST(sum(support) AS BIGINT) FROM per GROUP BY model, split
UNION ALL SELECT model, split, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per GROUP BY model, split
UNION ALL SELECT model, split, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per GROUP BY model, split""").replace(
    "\nSELECT * FROM per", """, per AS (
SELECT model, split, '1' AS label, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, tp + fn AS support FROM cm
UNION ALL SELECT model, split, '0', CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END,
  CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END,
  CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END, tn + fp FROM cm)
SELECT * FROM per""", 1))
_gap = ", ".join(
    f"max(CASE WHEN split = 'train' THEN {m} END) - max(CASE WHEN split = 'validation' THEN {m} END) AS {m}_train_minus_validation, "
    f"max(CASE WHEN split = 'validation' THEN {m} END) - max(CASE WHEN split = 'test' THEN {m} END) AS {m}_validation_minus_test"
    for m in ("accuracy", "f1", "roc_auc"))
add("generalization_gap", mq(f"SELECT model, {_gap} FROM summary GROUP BY model"))
_mets = ["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]
add("model_comparison", mq("SELECT model, " + ", ".join(
    f"max(CASE WHEN split = '{s}' THEN {m} END) AS {s}_{m}" for s in ("validation", "test") for m in _mets)
    + " FROM summary GROUP BY model"))
add("threshold_sweep", mq("SELECT * FROM sweep"))
add("select_threshold", mq("""
SELECT model, config, threshold, precision, recall, f1, CAST(precision >= 0.5 AND recall >= 0.1 AS INTEGER) AS qualifies
FROM sweep ORDER BY qualifies DESC, f1 DESC, config, threshold LIMIT 1"""))
add("tuning_report", mq("""
SELECT s.model, s.split, s.threshold, s.tp, s.fp, s.fn, s.tn, s.accuracy, s.precision, s.recall, s.f1, a.roc_auc,
  CAST(row_number() OVER (ORDER BY CAST(s.precision >= 0.5 AND s.recall >= 0.1 AS INTEGER) DESC, s.f1 DESC, s.model, s.threshold) = 1
       AS INTEGER) AS selected
FROM sweep s JOIN auc a ON a.model = s.model AND a.split = s.split WHERE s.split = 'validation'
UNION ALL
SELECT 'always_zero', 'validation', CAST(0.5 AS DOUBLE), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(sum(y) AS BIGINT),
  CAST(sum(1 - y) AS BIGINT), CAST(avg(1 - y) AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0.5 AS DOUBLE), 0
FROM scores WHERE model = 'price' AND split = 'validation'"""))
add("select_model", mq("""
SELECT model, roc_auc, f1, roc_auc - runner AS gap_to_runner_up FROM (
  SELECT model, roc_auc, f1, lead(roc_auc) OVER (ORDER BY roc_auc DESC, f1 DESC, position) AS runner,
         row_number() OVER (ORDER BY roc_auc DESC, f1 DESC, position) AS rk
  FROM summary JOIN morder USING (model) WHERE split = 'validation') WHERE rk = 1"""))
add("rank_models", mq("SELECT model, roc_auc, CAST(rank() OVER (ORDER BY roc_auc DESC) AS INTEGER) AS rank FROM summary WHERE split = 'validation'"))
add("always_zero", mq("""
SELECT 'always_zero' AS model, split,
  CAST(avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS accuracy, CAST(0.0 AS DOUBLE) AS precision,
  CAST(0.0 AS DOUBLE) AS recall, CAST(0.0 AS DOUBLE) AS f1,
  CAST(CASE WHEN sum(y) = 0 OR sum(1 - y) = 0 THEN NULL ELSE 0.5 END AS DOUBLE) AS roc_auc,
  avg(CAST(y AS DOUBLE)) AS average_precision
FROM scores WHERE model = 'price' GROUP BY split"""))

# ---------------------------------------------------------------- association
add("crosstab", "SELECT CAST(o_orderstatus AS VARCHAR) AS a, CAST(o_orderpriority AS VARCHAR) AS b, count(*) AS n "
                "FROM orders GROUP BY 1, 2")


def v_sql(cells: str, group: str) -> str:
    """Cramer's V from cells(group..., a, b, n) with the all-cells chi-square definition."""
    return f"""
SELECT {group}, CASE WHEN denom <= 0 THEN 0.0 ELSE sqrt(phi2c / denom) END AS cramers_v FROM (
  SELECT {group}, CASE WHEN t > 1 THEN greatest(0.0, chi2 / t - (k - 1) * (r - 1) / (t - 1)) ELSE chi2 / t END AS phi2c,
    least(CASE WHEN t > 1 THEN k - (k - 1) * (k - 1) / (t - 1) ELSE k END - 1,
          CASE WHEN t > 1 THEN r - (r - 1) * (r - 1) / (t - 1) ELSE r END - 1) AS denom
  FROM (
    SELECT {group}, max(t) AS t, max(r) AS r, max(k) AS k,
           sum(CASE WHEN e > 0 THEN (n - e) * (n - e) / e ELSE 0 END) AS chi2
    FROM (
      SELECT g.*, coalesce(c.n, 0) AS n, ra * cb / t AS e FROM (
        SELECT ra_t.*, cb_t.b, cb_t.cb, cb_t.k FROM
          (SELECT {group}, a, sum(n) AS ra, sum(sum(n)) OVER (PARTITION BY {group}) AS t,
                  count(*) OVER (PARTITION BY {group}) AS r FROM {cells} GROUP BY {group}, a) ra_t
          JOIN (SELECT {group}, b, sum(n) AS cb, count(*) OVER (PARTITION BY {group}) AS k FROM {cells} GROUP BY {group}, b) cb_t
          USING ({group})) g
      LEFT JOIN {cells} c USING ({group}, a, b))
    GROUP BY {group}))"""


add("cramers_v", "WITH cells AS (SELECT 'x' AS pair, CAST(o_orderstatus AS VARCHAR) AS a, CAST(o_orderpriority AS VARCHAR) AS b, "
                 "count(*) AS n FROM orders GROUP BY 1, 2, 3)\nSELECT 'o_orderstatus' AS col_a, 'o_orderpriority' AS col_b, cramers_v FROM ("
                 + v_sql("cells", "pair") + ")")

CAT = V.CATEGORICAL_COLUMNS + V.ENGINEERED_CATEGORICAL
NUM = V.NUMERIC_COLUMNS + ["liver_risk", "polypharmacy", "elderly_high_dose", "de_ritis_ratio"]


def assoc(cols):
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i + 1:]]
    cells = " UNION ALL ".join(
        f"SELECT '{x}' AS col_a, '{y}' AS col_b, coalesce(CAST({x} AS VARCHAR), 'nan') AS a, "
        f"coalesce(CAST({y} AS VARCHAR), 'nan') AS b, count(*) AS n FROM lab GROUP BY 1, 2, 3, 4" for x, y in pairs)
    diag = " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0" for c in cols)
    return (f"cells AS ({cells}), upper AS ({v_sql('cells', 'col_a, col_b')})",
            f"SELECT col_a, col_b, cramers_v FROM upper UNION ALL SELECT col_b, col_a, cramers_v FROM upper UNION ALL {diag}")


_LABX = [("lab", "SELECT * FROM engineered WHERE treatment_outcome IS NOT NULL")]
c1, b1 = assoc(CAT)
add("association_matrix", with_ctes(["engineered"], b1, extra=_LABX).replace("\nSELECT col_a, col_b, cramers_v FROM upper",
                                                                          f",\n{c1}\nSELECT col_a, col_b, cramers_v FROM upper", 1))
c2, b2 = assoc(["treatment_outcome"] + CAT)
add("rank_categorical", with_ctes(["engineered"], "SELECT col_b AS feature, cramers_v, CAST(row_number() OVER (ORDER BY cramers_v DESC NULLS LAST, col_b) AS INTEGER) AS rank "
                                                      "FROM upper WHERE col_a = 'treatment_outcome'",
                                  extra=_LABX).replace("\nSELECT col_b AS feature", f",\n{c2}\nSELECT col_b AS feature", 1))
add("rank_numeric", with_ctes(["engineered"], "SELECT *, CAST(row_number() OVER (ORDER BY abs_r DESC NULLS LAST, feature) AS INTEGER) AS rank FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(treatment_outcome AS DOUBLE)) AS r, "
    f"abs(corr(CAST({c} AS DOUBLE), CAST(treatment_outcome AS DOUBLE))) AS abs_r FROM lab" for c in NUM) + ")", extra=_LABX))
_L = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "loaded_quantity": "l_quantity * 1.1 + l_tax"}


def _pairs(cols: dict, table: str) -> str:
    names = list(cols)
    return " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({cols[a]} AS DOUBLE), CAST({cols[b]} AS DOUBLE)) AS r FROM {table}"
                              for i, a in enumerate(names) for b in names[i + 1:])


add("high_corr_pairs", with_ctes(["engineered"], f"SELECT * FROM ({_pairs({c: c for c in NUM}, 'lab')} UNION ALL "
                                                 f"{_pairs(_L, 'lineitem')}) WHERE abs(r) > 0.9", extra=_LABX))
