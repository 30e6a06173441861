"""Findings of round 3: tasks of the raw table, one run of the rules, compiled projections, dates."""
import datetime

import pytest
from pyspark.sql import functions as F

from wardstat import session
from wardstat.functions import exprs as X
from wardstat.sources import tables as T


def _orders(spark, path, n):
    spark.range(n).select(F.col("id").alias("o_orderkey")).coalesce(1).write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_raw_rows_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    sf = _orders(spark, tmp_path, 1000)
    monkeypatch.setattr(T, "RAW_ROWS_PER_TASK", 100)
    df = T.patients_raw(spark, sf)
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10           # one file, yet ten tasks
    assert df.agg(F.countDistinct("row_ord")).first()[0] == 1000


def test_raw_table_of_no_orders(spark, tmp_path):
    assert T.patients_raw(spark, _orders(spark, tmp_path, 0)).count() == 0


def test_clustered_rules_run_once(spark, tmp_path):
    """A projection after ``clustered`` is not run for the sample of the ranges."""
    seen = spark.sparkContext.accumulator(0)

    def mark(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    stored = spark.range(2000).select((F.col("id") * 7 % 2000).alias("patient_id"))
    stored.write.parquet(f"{tmp_path}/in")
    df = session.clustered(spark.read.parquet(f"{tmp_path}/in"), "patient_id").mapInArrow(mark, "patient_id long")
    out = session.write_table(df, "clustered-test")
    assert out.count() == 2000 and seen.value == 2000
    ranges = out.groupBy(F.input_file_name()).agg(F.min("patient_id"), F.max("patient_id")).collect()
    ends = sorted((r[1], r[2]) for r in ranges)
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_wide_projections_are_compiled(spark, tmp_path):
    key, value = session.HUGE_METHOD
    spark.conf.unset(key)
    T.patients_raw(spark, _orders(spark, tmp_path, 10))
    assert spark.conf.get(key) == value


@pytest.mark.parametrize("text, day", [("2020-02-23", (2020, 2, 23)), ("2022/06/10", (2022, 6, 10)),
                                       ("October 22, 2021", (2021, 10, 22)), ("12/08/2023", (2023, 12, 8)),
                                       ("not a date", None), ("2020-02/23", None), ("May-1, 2020/", None), ("", None), (None, None)])
def test_dates_by_their_separators(spark, text, day):
    df = spark.createDataFrame([(text,)], "d string")
    plan = df.select(X.parse_mixed_date("d").alias("d"))
    assert plan.first()[0] == (datetime.date(*day) if day else None)


def test_quantiles_do_not_unpivot_the_rows(spark, monkeypatch):
    """Every row of a round's aggregation is a task's count, not a value; results stay exact."""
    import numpy as np
    from wardstat.functions import stats
    monkeypatch.setattr(stats, "long_values", lambda *a, **k: pytest.fail("rows unpivoted"))
    n = 20000
    df = spark.range(0, n, 1, 4).select((F.col("id") % 97).alias("a"), F.when(F.col("id") % 3 > 0, F.sqrt("id")).alias("b`c"),
                                        F.lit(None).cast("double").alias("none"))
    got = {(r[0], r[1]): r[2] for r in stats.exact_quantiles(df, ["a", "none"], [0.25, 0.5]).collect()}
    ids = np.arange(n)
    assert got == {("a", 0.25): np.quantile(ids % 97, 0.25), ("a", 0.5): np.quantile(ids % 97, 0.5), ("none", 0.25): None, ("none", 0.5): None}
    b = df.select(F.col("`b``c`").alias("b"))
    assert stats.exact_quantiles(b, ["b"], [0.9]).first()[2] == pytest.approx(np.quantile(np.sqrt(ids[ids % 3 > 0]), 0.9), rel=1e-12)


def _random_trees(rng, n_trees, depth, features):
    import pandas as pd
    from wardstat.operators import explain as EX
    rows = []

    def add(tree, level, cover, ids):
        my = len(ids)
        ids.append(my)
        r = {"treeID": tree, "id": my, "prediction": float(rng.normal()), "cover": cover, "left": -1, "right": -1,
             "feature": -1, "cats": [0.0], "num_categories": -1}
        rows.append(r)
        if level < depth and (level < 1 or rng.random() < 0.9):
            r["feature"], share = int(rng.integers(0, features)), rng.uniform(0.2, 0.8)
            if r["feature"] == 0:                            # a categorical feature of four values
                r["cats"], r["num_categories"] = [0.0, 2.0], 4
            else:
                r["cats"] = [float(rng.normal())]
            r["left"] = add(tree, level + 1, cover * share, ids)
            r["right"] = add(tree, level + 1, cover * (1 - share), ids)
        return my
    for t in range(n_trees):
        add(t, 0, 100.0, [])
    return EX.compile_trees(pd.DataFrame(rows), pd.DataFrame({"treeID": range(n_trees), "weights": rng.uniform(0.1, 1, n_trees)}))


def test_contributions_are_computed_once_a_pattern(monkeypatch):
    """The Shapley sums run over the 2^d patterns of a leaf, whatever the number of rows; paths too deep
    for a table give the same values row by row."""
    import numpy as np
    from wardstat.operators import explain as EX
    rng = np.random.default_rng(5)
    trees = _random_trees(rng, 6, 5, 4)
    X = np.column_stack([rng.integers(0, 4, 500), rng.normal(size=(500, 3))]).astype(float)
    wide, slot_values = [], EX._slot_values
    monkeypatch.setattr(EX, "_slot_values", lambda t, a: wide.append(a.shape[2]) or slot_values(t, a))
    phi, base = EX.tree_contributions_batch(X, trees)
    assert max(wide) <= 2 ** 5
    monkeypatch.setattr(EX, "PATTERN_BITS", 0)
    by_row, base_by_row = EX.tree_contributions_batch(X, trees)
    assert wide[-1] == 500 and base == pytest.approx(base_by_row)
    assert np.allclose(phi, by_row, atol=1e-12)


def test_contributions_of_a_frame(spark, monkeypatch):
    import numpy as np
    from pyspark.ml.linalg import Vectors
    from wardstat.operators import explain as EX
    monkeypatch.setattr(EX, "ROWS_AT_ONCE", 3)
    rng = np.random.default_rng(8)
    trees = _random_trees(rng, 3, 4, 2)
    X = np.column_stack([rng.integers(0, 4, 10), rng.normal(size=10)]).astype(float)
    keys = [1, 1, None, *range(4, 11)]                       # repeated and missing keys keep their rows
    df = spark.createDataFrame([(k, Vectors.dense(x)) for k, x in zip(keys, X)], ["k", "f"])
    got = EX.tree_contributions(df, "k", "f", trees, ["c", "x"]).collect()
    phi, base = EX.tree_contributions_batch(X, trees)
    want = [(k, f, v) for k, p in zip(keys, phi) for f, v in (("c", p[0]), ("x", p[1]), ("__base__", base))]
    order = lambda rows: sorted(((-1 if k is None else k), f, round(v, 9)) for k, f, v in rows)     # noqa: E731
    assert order(got) == order(want)


def test_splits_are_joined_once_and_never_broadcast(spark, monkeypatch):
    """One stored join serves all splits; neither it nor the target's join is a broadcast; pairs of rows of a
    repeated id stay."""
    from wardstat.functions import vocab as V
    from wardstat.plans import clinical, modeling
    from wardstat.session import cut_lineage
    numeric = {c: (F.col("id") % 50 + i).cast("double") for i, c in enumerate(V.NUMERIC_COLUMNS)}
    text = {c: F.concat(F.lit("v"), F.col("id") % 3) for c in V.CATEGORICAL_COLUMNS}
    rows = spark.range(300).select(F.col("id").alias("patient_id"), *[e.alias(c) for c, e in {**numeric, **text}.items()],
                                   (F.col("id") % 2).cast("int").alias(V.TARGET))
    rows = rows.unionByName(rows.where("patient_id = 10"))
    split = F.when(F.col("patient_id") % 5 == 0, "test").when(F.col("patient_id") % 5 == 1, "validation").otherwise("train")
    monkeypatch.setattr(clinical, "_MEMO", {})
    monkeypatch.setattr(modeling, "patients", lambda *_: cut_lineage(rows))
    monkeypatch.setattr(modeling, "assignments", lambda *_: rows.select("patient_id", V.TARGET, split.alias("split")).where("patient_id < 290"))
    built, memo = [], modeling._memo
    monkeypatch.setattr(modeling, "_memo", lambda s, sf, name, build: memo(s, sf, name, lambda: built.append((name, build())) or built[-1][1]))
    f = modeling.features_of(spark, "none", "test")
    plan = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in built}
    assert "BroadcastHashJoin" not in plan["assigned"] and "SortMergeJoin" in plan["assigned"]
    assert "BroadcastHashJoin" not in plan["features_test"] and "SortMergeJoin" in plan["features_test"]
    assert [name for name, _ in built].count("assigned") == 1
    got = sorted((r["patient_id"], r[V.TARGET]) for r in f.collect())
    assert got == sorted([(i, i % 2) for i in range(0, 290, 5) if i != 10] + [(10, 0)] * 16) and f.columns[-1] == V.TARGET



def test_fill_looks_at_distinct_demands_only(monkeypatch):
    """The same sequences as with every example a candidate, over as many candidates as there are demands."""
    import numpy as np
    from wardstat.llm import packing as P

    def plain(demand, limits):
        rel = demand / limits
        weighted = rel * rel.mean(axis=0)
        order = list(np.lexsort((np.arange(len(rel)), -weighted.sum(axis=1))))
        seq, pos, current, k, room = {}, {}, 0, 0, np.ones(3)
        while order:
            fit = [i for i in order if (rel[i] <= room + 1e-9).all()]
            if not fit:
                current, k, room = current + 1, 0, np.ones(3)
                continue
            i = fit[int(np.argmax(weighted[fit] @ room))]
            seq[i], pos[i], room, k = current, k, room - rel[i], k + 1
            order.remove(i)
        return [seq[i] for i in range(len(rel))], [pos[i] for i in range(len(rel))]
    limits = np.array([2048.0, 128.0, 2048.0])
    rng = np.random.default_rng(2)
    length = rng.integers(1, 40, 400) * rng.choice([1, 50], 400)
    demand = np.column_stack([length, np.ones(400), length - 1]).astype(float)
    widest, flat = [], np.flatnonzero
    monkeypatch.setattr(P.np, "flatnonzero", lambda x: widest.append(len(x)) or flat(x))
    seq, pos = P.fill(demand, limits)
    assert max(widest) <= len(np.unique(length)) < 100
    monkeypatch.setattr(P.np, "flatnonzero", flat)
    assert (list(seq), list(pos)) == plain(demand, limits)
    assert [len(x) for x in P.fill(demand[:0], limits)] == [0, 0]
