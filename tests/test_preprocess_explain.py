"""Train-only preprocessing contract, one-hot unseen categories, exact Shapley values."""
import itertools
import math

import numpy as np
import pytest

from wardstat.functions import vocab as V
from wardstat.operators import explain as EX
from wardstat.operators import preprocess as PP


def test_predictor_contract(spark):
    cols = ["patient_id"] + list(reversed(V.PREDICTORS))
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in cols))
    assert PP.validate_predictors(df).columns == ["patient_id"] + V.PREDICTORS
    with pytest.raises(ValueError, match="missing"):
        PP.validate_predictors(df.drop("age"))
    with pytest.raises(ValueError, match="unexpected"):
        PP.validate_predictors(df.withColumn("extra", df["age"]))


def test_unseen_category_encodes_to_zeros(spark):
    from pyspark.ml.functions import vector_to_array
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "g string, x double")
    test = spark.createDataFrame([("b", 1.0), ("zzz", 2.0)], "g string, x double")
    model = PP.one_hot_pipeline(["g"], ["x"]).fit(train)
    rows = model.transform(test).select(vector_to_array("features").alias("f")).collect()
    assert rows[0]["f"] == [1.0, 0.0, 1.0]       # x, g=a, g=b
    assert rows[1]["f"] == [2.0, 0.0, 0.0]       # unseen -> all zeros


def _brute_shapley(x, tree, nf):
    """Exact Shapley values of v(S) = path-dependent expectation, by subset enumeration."""
    def v(S):
        def rec(node):
            if "leaf" in node:
                return node["leaf"]
            f, thr = node["f"], node["thr"]
            if f in S:
                return rec(node["l"] if x[f] <= thr else node["r"])
            return (node["l"]["cover"] * rec(node["l"]) + node["r"]["cover"] * rec(node["r"])) / node["cover"]
        return rec(tree)
    phi = np.zeros(nf)
    players = list(range(nf))
    for i in players:
        others = [j for j in players if j != i]
        for k in range(len(others) + 1):
            for S in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(nf - k - 1) / math.factorial(nf)
                phi[i] += w * (v(set(S) | {i}) - v(set(S)))
    return phi, v(set())


def test_tree_contributions_equal_brute_force_shapley():
    # depth-3 tree with a repeated feature on one path
    t = {"f": 0, "thr": 0.5, "cover": 100,
         "l": {"f": 1, "thr": 2.0, "cover": 60,
               "l": {"f": 0, "thr": 0.2, "cover": 25, "l": {"leaf": 1.0, "cover": 10}, "r": {"leaf": -2.0, "cover": 15}},
               "r": {"leaf": 3.0, "cover": 35}},
         "r": {"f": 2, "thr": 1.0, "cover": 40, "l": {"leaf": 0.5, "cover": 30}, "r": {"leaf": -1.0, "cover": 10}}}
    rows, nid = [], [0]

    def add(node):
        my = nid[0]
        nid[0] += 1
        rec = {"treeID": 0, "id": my, "prediction": node.get("leaf", 0.0), "cover": float(node["cover"]),
               "left": -1, "right": -1, "feature": -1, "cats": [0.0], "num_categories": -1}
        rows.append(rec)
        if "leaf" not in node:
            rec["feature"], rec["cats"] = node["f"], [node["thr"]]
            rec["left"] = add(node["l"])
            rec["right"] = add(node["r"])
        return my

    add(t)
    import pandas as pd
    trees = EX.compile_trees(pd.DataFrame(rows), pd.DataFrame({"treeID": [0], "weights": [0.7]}))
    X = np.array([[0.1, 1.0, 5.0], [0.3, 3.0, 0.0], [0.9, 0.0, 0.5], [0.9, 9.0, 2.0]])
    phi, base = EX.tree_contributions_batch(X, trees)
    for r in range(len(X)):
        exp, b = _brute_shapley(X[r], t, 3)
        assert np.allclose(phi[r], 0.7 * exp, atol=1e-12)
        assert base == pytest.approx(0.7 * b)
