"""Exact quantiles / modes against numpy and pandas brute force."""
import numpy as np
import pandas as pd
import pytest

from wardstat.functions import stats


def _pd_quantile(vals, p):
    s = pd.Series(vals, dtype="float64").dropna()
    return float(s.quantile(p)) if len(s) else None


@pytest.mark.parametrize("seed", [0, 1])
def test_exact_quantiles_match_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    n = 3001
    a = np.round(rng.normal(50, 10, n), 1)          # many ties
    b = rng.integers(0, 5, n).astype(float)         # heavy ties
    b[rng.random(n) < 0.2] = np.nan                 # NULLs
    c = np.where(rng.random(n) < 0.5, 7.0, rng.exponential(3, n))   # one value holds half the rows
    pdf = pd.DataFrame({"a": a, "b": b, "c": c})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0, 0.37]
    got = {(r["column"], r["p"]): r["value"] for r in stats.exact_quantiles(df, ["a", "b", "c"], probs).collect()}
    for col in "abc":
        for p in probs:
            assert got[(col, p)] == pytest.approx(_pd_quantile(pdf[col], p), abs=1e-9)


def test_median_even_count_and_all_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, None)], "x double, y double")
    got = {r["column"]: r["value"] for r in stats.exact_quantiles(df, ["x", "y"], [0.5]).collect()}
    assert got["x"] == 2.5 and got["y"] is None


def test_mode_ties_pick_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "g string")
    m = {r["column"]: r["mode"] for r in stats.modes(df, ["g"]).collect()}
    assert m == {"g": "a"}


def test_ordering_prefix_matches_cumsum(spark):
    from wardstat.functions.ordering import global_prefix
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.integers(0, 50, 500), "v": rng.integers(0, 10, 500), "id": np.arange(500)})
    df = spark.createDataFrame(pdf)
    out = global_prefix(df, ["k", "id"], ["v"], partitions=7).toPandas().sort_values("row_index")
    exp = pdf.sort_values(["k", "id"]).reset_index(drop=True)
    assert list(out["id"]) == list(exp["id"])
    assert list(out["cum_v"]) == list(exp["v"].cumsum())


def test_few_bins_give_the_same_values(spark, monkeypatch):
    monkeypatch.setattr(stats, "BINS", 64)
    rng = np.random.default_rng(11)
    n = 5000
    pdf = pd.DataFrame({"a": np.round(rng.normal(0, 1, n), 2), "b": np.where(rng.random(n) < 0.4, 3.0, rng.random(n)),
                        "c": np.exp(rng.normal(0, 60, n))})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r["column"], r["p"]): r["value"] for r in stats.exact_quantiles(df, ["a", "b", "c"], probs).collect()}
    for col in "abc":
        for p in probs:
            assert got[(col, p)] == pytest.approx(_pd_quantile(pdf[col], p), rel=1e-12)


def test_quantiles_with_nan_and_infinities(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, nan, nan, nan)], "x double")
    assert stats.exact_quantiles(df, ["x"], [0.5]).first()["value"] == 1.5
    df = spark.createDataFrame([(x,) for x in (-inf, 1.0, 2.0, 3.0, inf, 1.7e308, -1.7e308)], "x double")
    got = [r["value"] for r in stats.exact_quantiles(df, ["x"], [0.0, 0.5, 1.0]).collect()]
    assert got == [-inf, 2.0, inf]
