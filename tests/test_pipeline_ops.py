"""Dedup, splits, metrics, association, requests, preprocessing: against brute force."""
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardstat.operators import association as A
from wardstat.operators import cleaning as C
from wardstat.operators import metrics as M
from wardstat.operators import splits as SP
from wardstat.streaming import requests as RQ


def test_dedup_keep_first_stable_under_repartition(spark):
    rows = [(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 9, "z"), (2, 5, "y"), (3, 4, None)]
    df = spark.createDataFrame(rows, "k long, row_ord long, v string")
    for parts in (1, 3, 7):
        got = sorted(tuple(r) for r in C.dedup_keep_first(df.repartition(parts), "k").collect())
        assert got == [(1, 1, "a"), (2, 5, "y"), (3, 4, None)]


def test_fill_before_dedup_uses_secondary(spark):
    df = spark.createDataFrame([(1, 1, None, 40.0), (1, 2, 55.0, None)], "Patient_ID long, row_ord long, Age double, age_1 double")
    out = C.dedup_keep_first(C.consolidate(df), "Patient_ID").collect()
    assert [(r["row_ord"], r["Age"]) for r in out] == [(1, 40.0)]


def _brute_split(pdf, frac, seed, stage):
    import hashlib
    pdf = pdf.copy()
    pdf["h"] = [hashlib.md5(f"{seed}|{stage}|{k}".encode()).hexdigest() for k in pdf["key"]]
    n = len(pdf)
    total = math.ceil(frac * n)
    counts = pdf.groupby("y").size().to_dict()
    quotas = {c: math.floor(total * v / n) for c, v in counts.items()}
    rem = sorted(counts, key=lambda c: (-(total * counts[c] / n - quotas[c]), str(c)))
    for c in rem[: total - sum(quotas.values())]:
        quotas[c] += 1
    pdf["rk"] = pdf.groupby("y")["h"].rank(method="first")
    return set(pdf.loc[pdf["rk"] <= pdf["y"].map(quotas), "key"])


def test_stratified_select_matches_row_number(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"key": np.arange(5000), "y": (rng.random(5000) < 0.23).astype(int)})
    s = SP.stratified_select(spark.createDataFrame(pdf), "key", "y", 0.2, 42, "test")
    got = {r["key"] for r in s.where("selected").collect()}
    assert got == _brute_split(pdf, 0.2, 42, "test")
    assert len(got) == math.ceil(0.2 * 5000)


def test_three_way_split_is_a_partition(spark):
    pdf = pd.DataFrame({"key": np.arange(2000), "y": np.arange(2000) % 4 == 0}).astype({"y": int})
    a = SP.stratified_split_3(spark.createDataFrame(pdf), "key", "y").toPandas()
    assert len(a) == 2000 and a["key"].is_unique
    assert a["split"].value_counts().to_dict() == {"train": 1200, "test": 400, "validation": 400}


def _brute_auc(y, p):
    pos = [pi for yi, pi in zip(y, p) if yi == 1]
    neg = [pi for yi, pi in zip(y, p) if yi == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _brute_ap(y, p):
    order = sorted(set(p), reverse=True)
    P = sum(y)
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = sum(1 for yi, pi in zip(y, p) if pi >= t and yi == 1)
        fp = sum(1 for yi, pi in zip(y, p) if pi >= t and yi == 0)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


def test_auc_ap_match_brute_force_with_ties(spark):
    rng = np.random.default_rng(7)
    y = (rng.random(400) < 0.3).astype(int)
    p = np.round(np.clip(y * 0.2 + rng.random(400) * 0.8, 0, 1), 1)
    df = spark.createDataFrame(pd.DataFrame({"model": "m", "split": "s", "key": np.arange(400), "y": y, "prob": p}))
    s = M.summary_metrics(df).first()
    assert s["roc_auc"] == pytest.approx(_brute_auc(y, p), abs=1e-12)
    assert s["average_precision"] == pytest.approx(_brute_ap(list(y), list(p)), abs=1e-12)


def test_constant_scores_and_zero_division(spark):
    df = spark.createDataFrame([("m", "s", i, int(i % 4 == 0), 0.3) for i in range(40)],
                               "model string, split string, key long, y int, prob double")
    s = M.summary_metrics(df).first()
    assert s["roc_auc"] == 0.5 and s["average_precision"] == pytest.approx(0.25)
    assert s["precision"] == 0.0 and s["recall"] == 0.0 and s["f1"] == 0.0


def test_threshold_sweep_exact_at_boundaries(spark):
    vals = [0.29, 0.3, 0.57, 0.58, 0.8, 0.81]
    df = spark.createDataFrame([("m", "s", i, 1, v) for i, v in enumerate(vals)],
                               "model string, split string, key long, y int, prob double")
    sw = {round(r["threshold"], 2): r["tp"] for r in M.threshold_sweep(df).collect()}
    for t, tp in sw.items():
        assert tp == sum(1 for v in vals if v >= (round(t * 100)) / 100.0)


def test_cramers_v_edges(spark):
    df = spark.createDataFrame([("a", "x", "x"), ("a", "y", "y"), ("a", "x", "x"), ("a", "z", "z")] * 5,
                               "one string, b string, c string")
    assert A.cramers_v(df, "one", "b").first()["cramers_v"] == 0.0
    v = A.cramers_v(df, "b", "c").first()["cramers_v"]
    assert v == pytest.approx(1.0, abs=1e-9)


def test_request_validation(spark):
    bodies = ['{"other": 1}', '{"patient_id": true}', '{"patient_id": "abc"}', '{"patient_id": " 12 "}',
              '{"patient_id": 0}', '{"patient_id": -1}', '{"patient_id": 3.5}', '{"patient_id": 7}',
              '{"patient_id": "-4"}', None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "request_id long, body string")
    out = [(r["status"], r["patient_id"]) for r in RQ.validate_requests(df).orderBy("request_id").collect()]
    assert out == [("missing_id", None), ("not_integer", None), ("not_integer", None), ("ok", 12),
                   ("not_positive", None), ("not_positive", None), ("not_integer", None), ("ok", 7),
                   ("not_integer", None), ("missing_id", None)]


def test_invalid_probabilities_never_reach_the_log(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.2), (4, -0.1), (5, 0.7)], "i int, p double")
    ok = [r["i"] for r in df.where(RQ.valid_probability(F.col("p"))).collect()]
    assert ok == [5]


def test_hot_key_holding_a_third_of_rows(spark):
    """Dedup and modes stay exact when one key / value holds a third of all rows."""
    from wardstat.functions import stats
    n = 3000
    rows = [(0 if i % 3 == 0 else i, i, f"v{i % 5}") for i in range(n)]
    df = spark.createDataFrame(rows, "k long, row_ord long, v string").repartition(6)
    d = C.dedup_keep_first(df, "k")
    assert d.count() == n - n // 3 + 1
    assert d.where("k = 0").collect()[0]["row_ord"] == 0
    hot = spark.createDataFrame([("hot" if i % 3 == 0 else f"c{i % 50}",) for i in range(n)], "g string")
    assert stats.modes(hot, ["g"]).first()["mode"] == "hot"


def test_missing_keys_and_labels_are_kept(spark):
    from wardstat.operators import cleaning as C
    from wardstat.operators import splits as S
    df = spark.createDataFrame([(1, 0), (1, 1), (None, 2), (None, 3)], "k long, row_ord long")
    assert sorted(r["row_ord"] for r in C.dedup_keep_first(df, "k", "row_ord").collect()) == [0, 2]
    d = spark.range(1000).selectExpr("id AS k", "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 2 END AS y")
    out = S.stratified_select(d, "k", "y", 0.2, 42, "test")
    assert out.count() == 1000 and out.where("selected").count() == 200


def test_incomplete_scores_fail(spark):
    import pytest
    from wardstat.operators import splits as S
    truth = spark.createDataFrame([(1, 0), (2, 1)], "key long, y int")
    part = spark.createDataFrame([(1, 0, 0.5)], "key long, y int, prob double")
    with pytest.raises(ValueError):
        S.join_scores(truth, {"m": part}, ["key", "y"])


def test_counts_beyond_32_bits(spark):
    from wardstat.operators import association as A
    from wardstat.operators import metrics as M
    from wardstat.operators import validate as V
    n = 4_000_000_000
    cells = spark.createDataFrame([("p", "a", "x", n), ("p", "b", "y", n)], "pair string, a string, b string, n long")
    assert abs(A._v_from_cells(cells, ["pair"]).first()["cramers_v"] - 1.0) < 1e-6
    cum = spark.createDataFrame([("m", "s", 0.9, n, 0, n, n, 0, n), ("m", "s", 0.1, 0, n, n, n, 0, 0)],
                                "model string, split string, prob double, n_pos long, n_neg long, pos_total long, "
                                "neg_total long, pos_below long, neg_below long")
    assert abs(M.roc_auc(None, cum).first()["roc_auc"] - 1.0) < 1e-6
    bad = spark.createDataFrame([("12", "2024-01-01"), ("x1", "not a day"), ("1.5", "2024-01-01 10:00:00")], "k string, d string")
    assert {r["check"]: r["observed"] for r in V.integer_key(bad, "k").collect()} == {
        "non_integer_keys": 1, "non_numeric_keys": 1}
    assert V.date_only_check(bad, "d").first()["conversion_failures"] == 1
