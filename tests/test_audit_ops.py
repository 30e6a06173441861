"""Audit, sampling, order and association operators on frames that break their rules."""
import hashlib
import math
import tempfile

from wardstat.functions import exprs as X
from wardstat.operators import association as A
from wardstat.operators import metrics as M
from wardstat.operators import profile as P
from wardstat.operators import splits as SP
from wardstat.operators import validate as V
from wardstat.sources import io as IO


def checks(df):
    return {r["check"]: (r["observed"], r["expected"], r["passed"]) for r in df.collect()}


def test_split_integrity_finds_every_fault(spark):
    lab = spark.createDataFrame([(i,) for i in range(1, 11)], "k long")
    good = [(i, "test" if i < 3 else "validation" if i < 5 else "train") for i in range(1, 11)]
    got = checks(SP.split_integrity(spark.createDataFrame(good, "k long, split string"), lab, "k"))
    assert all(p for *_, p in got.values()) and got["rows_train"] == (6, 6, 1) and got["rows_validation"] == (2, 2, 1)
    bad = good[:-1] + [(1, "train"), (3, "validation"), (99, "train"), (98, "holdout"), (97, None)]
    got = checks(SP.split_integrity(spark.createDataFrame(bad, "k long, split string"), lab, "k"))
    assert got["overlap_train_test"][0] == 1 and got["overlap_train_validation"][0] == 0
    assert got["keys_assigned_more_than_once"][0] == 2 and got["labelled_keys_missing"][0] == 1
    assert got["assigned_keys_not_labelled"][0] == 3 and got["invalid_split_labels"][0] == 2
    assert got["rows_train"] == (7, 6, 0) and got["rows_validation"] == (3, 2, 0) and got["rows_test"] == (2, 2, 1)
    empty = checks(SP.split_integrity(spark.createDataFrame([], "k long, split string"), lab.where("false"), "k"))
    assert all(p for *_, p in empty.values())


def test_split_integrity_exchanges_each_side_once(spark):
    path = tempfile.mkdtemp(prefix="wardstat-split-")
    spark.createDataFrame([(i, "train") for i in range(50)], "k long, split string").write.parquet(f"{path}/a")
    spark.createDataFrame([(i,) for i in range(50)], "k long").write.parquet(f"{path}/l")
    df = SP.split_integrity(spark.read.parquet(f"{path}/a"), spark.read.parquet(f"{path}/l"), "k")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_conversion_failures_counts_and_first_samples(spark):
    rows = [(i, f"x{i}" if i % 2 else str(i), float("inf") if i == 3 else float(i), None) for i in range(40)]
    df = spark.createDataFrame(rows, "o long, t string, d double, e string").repartition(7)
    got = {r["column"]: (r["failures"], r["samples"]) for r in V.conversion_failures(df, ["t", "d", "e"], X.to_number, "o").collect()}
    assert got == {"t": (20, "x1|x3|x5|x7|x9"), "d": (1, "inf"), "e": (0, "")}


def test_seeded_sample_is_the_hash_order_prefix(spark):
    df = spark.range(5000).selectExpr("id AS k", "id % 7 AS v").repartition(9)
    want = sorted(range(5000), key=lambda k: hashlib.md5(f"42|{k}".encode()).hexdigest())
    for n in (1, 15, 700, 4999):
        assert sorted(r["k"] for r in P.seeded_sample(df, ["k"], n).collect()) == sorted(want[:n])
    assert P.seeded_sample(df, ["k"], 5000).count() == 5000 and P.seeded_sample(df, ["k"], 9000).count() == 5000
    same = spark.range(60).selectExpr("1 AS k")                      # ties: still exactly n
    assert P.seeded_sample(same, ["k"], 25).count() == 25


def test_row_order_is_gapless_over_files(spark):
    path = tempfile.mkdtemp(prefix="wardstat-order-") + "/t"
    spark.range(1000).repartition(6).write.parquet(path)
    rows = IO.with_row_order(spark, path).collect()
    assert sorted(r["row_order"] for r in rows) == list(range(1000))
    by = sorted(rows, key=lambda r: r["row_order"])
    assert [(r["file_path"], r["row_index"]) for r in by] == sorted((r["file_path"], r["row_index"]) for r in rows)
    assert len({r["file_path"] for r in rows}) == 6


def test_pair_cells_equal_crosstabs(spark):
    rows = [(str(i % 3), str(i % 5) if i % 4 else None, i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "a string, b string, c int")
    cells = A.pair_cells(df, ["a", "b", "c"], [("a", "b"), ("c", "b")])
    got = {(r["col_a"], r["col_b"], r["a"], r["b"]): r["n"] for r in cells.collect()}
    want = {}
    for a, b, c in rows:
        for k in (("a", "b", a, b or "nan"), ("c", "b", str(c), b or "nan")):
            want[k] = want.get(k, 0) + 1
    assert got == want
    assert "Generate explode" not in cells._jdf.queryExecution().executedPlan().toString()


def test_ranking_puts_undefined_scores_last(spark):
    df = spark.createDataFrame([(1.0, 1.0, 5.0, 0), (2.0, 0.0, 5.0, 1), (3.0, 1.0, 5.0, 1)], "x double, y double, flat double, t int")
    got = [(r["feature"], r["rank"]) for r in A.rank_numeric(df, ["flat", "y", "x"], "t").collect()]
    assert got == [("x", 1), ("y", 2), ("flat", 3)]


def test_tuning_report_selects_one_row(spark):
    rows = [(m, "validation", i, i % 3 == 0, 0.3 + (0.4 if (i % 3 == 0) == (m == "good") else 0.0) + i / 1000) for m in ("good", "bad") for i in range(60)]
    s = spark.createDataFrame([(m, sp, k, int(y), p) for m, sp, k, y, p in rows], "model string, split string, key long, y int, prob double")
    r = M.tuning_report(s).collect()
    assert len(r) == 2 * 51 + 1
    chosen = [x for x in r if x["selected"]]
    assert len(chosen) == 1 and chosen[0]["model"] == "good" and chosen[0]["f1"] == 1.0
    zero = next(x for x in r if x["model"] == "always_zero")
    assert (zero["tp"], zero["fp"], zero["fn"], zero["tn"], zero["roc_auc"]) == (0, 0, 20, 40, 0.5)
    auc = {x["model"]: x["roc_auc"] for x in r}
    assert auc["good"] == 1.0 and math.isclose(auc["bad"], 0.0, abs_tol=0.05)


def test_correlations_equal_numpy_pairwise(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    a = rng.normal(1e6, 1.0, 400)
    b = a * 0.5 + rng.normal(0, 0.3, 400)
    rows = [(float(x) if i % 5 else None, float(y) if i % 7 else float("inf"), 3.0, int(i % 11)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, flat double, d int").repartition(5)
    got = {(r["col_a"], r["col_b"]): r["r"] for r in P.corr_matrix(df).collect()}
    v = np.array([[np.nan if x is None or not np.isfinite(x) else x for x in r] for r in rows], float)
    for i, x in enumerate(df.columns):
        for j, y in enumerate(df.columns):
            both = ~np.isnan(v[:, i]) & ~np.isnan(v[:, j])
            if x == y:
                assert got[x, y] == 1.0
            elif "flat" in (x, y):
                assert got[x, y] is None
            else:
                assert math.isclose(got[x, y], np.corrcoef(v[both, i], v[both, j])[0, 1], abs_tol=1e-9)
    assert all(r["r"] is None for r in P.corr_matrix(df.where("false"), ["a", "b"]).collect() if r["col_a"] != r["col_b"])


def test_assignment_order_is_restored(spark):
    assign = spark.createDataFrame([(5, "b"), (2, "a"), (9, "a"), (1, "b")], "patient_id long, split string").repartition(3)
    base = spark.createDataFrame([(1, 0), (2, 1), (5, None), (9, 1)], "patient_id long, treatment_outcome int")
    rows = SP.join_one_to_one(SP.with_assignment_order(assign, ["split", "patient_id"]), base, "patient_id").collect()
    assert [(r["assignment_order"], r["patient_id"]) for r in rows] == [(0, 2), (1, 9), (2, 1)]


def test_score_alignment_counts_unmatched_keys(spark):
    from wardstat.operators import validate as VA
    a = spark.createDataFrame([(1, 0.5), (2, 0.25), (None, 0.1)], "k long, p double")
    b = spark.createDataFrame([(1, 0.5), (3, 0.25), (4, 0.5)], "k long, q double")
    r = VA.score_alignment(a, b, ["k"], "p", "q").first()
    assert tuple(r) == (1, 2, 2, 0.0, 0)
    assert tuple(VA.score_alignment(a.where("k = 1"), b, ["k"], "p", "q").first()) == (1, 0, 2, 0.0, 0)
    assert tuple(VA.score_alignment(a.where("k = 1"), b.where("k = 1"), ["k"], "p", "q").first()) == (1, 0, 0, 0.0, 1)
    assert tuple(VA.score_alignment(a.where("false"), b.where("false"), ["k"], "p", "q").first()) == (0, 0, 0, None, None)
