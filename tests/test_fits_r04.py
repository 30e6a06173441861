"""Findings of round 4 on the fits."""
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from wardstat import session
from wardstat.functions import vocab as V
from wardstat.operators import models as MO
from wardstat.operators import perceptron as PC
from wardstat.operators import preprocess as PP


@pytest.fixture(scope="module")
def features(spark):
    h = lambda i: F.pmod(F.hash("id", F.lit(i)), F.lit(1000))     # noqa: E731
    return session.cut_lineage(spark.range(0, 900, 1, 2).select(
        F.col("id").alias("patient_id"), *[(h(i) / 10.0).alias(c) for i, c in enumerate(V.FEATURE_NUMERIC)],
        *[F.concat(F.lit("v"), h(50 + i) % 3).alias(c) for i, c in enumerate(V.FEATURE_CATEGORICAL)],
        (h(0) + h(51) % 3 * 200 > 700).cast("int").alias(V.TARGET)))


# ------------------------------------------------------------------ F2
@pytest.mark.parametrize("iterations, near", [(0, 0), (1, 1e-12), (12, 1e-8), (60, 1e-4)])
def test_perceptron_is_spark_mls(spark, features, monkeypatch, iterations, near):
    """The same weights as Spark's own fit over the same tasks, up to the rounding of sums."""
    monkeypatch.setattr(MO, "PLAIN_FIT_ROWS", 0)
    data = MO.oversample_balanced(MO.with_label(features))
    ready = PP.one_hot_pipeline().fit(data)
    n = len(PP.feature_names(ready.transform(features.limit(1))))
    stages = MO.mlp(n, max_iter=iterations)
    want = Pipeline(stages=ready.stages + stages).fit(data).stages[-1]
    model = MO.fit_pipeline(features, MO.mlp(n, max_iter=iterations), "oversample")
    got = model.stages[-1]
    assert got.getLayers() == want.getLayers() and type(got) is type(want)
    assert np.abs(got.weights.toArray() - want.weights.toArray()).max() <= near
    assert MO.positive_probability(model, features).where("probability BETWEEN 0 AND 1").count() == 900


def test_perceptron_of_few_rows_is_spark_mls_own_fit(spark, features):
    data = MO.oversample_balanced(MO.with_label(features))
    stages = MO.mlp(len(PP.feature_names(PP.one_hot_pipeline().fit(data).transform(features.limit(1)))), max_iter=15)
    want = Pipeline(stages=PP.one_hot_pipeline().getStages() + stages).fit(data).stages[-1]
    assert np.allclose(MO.fit_pipeline(features, stages, "oversample").stages[-1].weights.toArray(), want.weights.toArray(), rtol=0, atol=1e-9)


def test_perceptron_of_many_rows_is_dealt_to_all_tasks(spark, features, monkeypatch):
    """Every oversampled row is in the blocks once, in as many tasks as a fit of its rows has."""
    seen = []
    monkeypatch.setattr(MO, "PLAIN_FIT_ROWS", 800)
    monkeypatch.setattr(MO, "LEAST_ROWS_PER_TASK", 100)
    monkeypatch.setattr(MO, "fit_perceptron", lambda e, df: seen.append(df) or PC.fit_perceptron(e, df))
    MO.fit_pipeline(features, MO.mlp(len(PP.feature_names(PP.one_hot_pipeline().fit(features).transform(features.limit(1)))), max_iter=2), "oversample")
    rows = MO.oversample_balanced(MO.with_label(features)).count()
    assert seen[0].rdd.getNumPartitions() == MO.fit_tasks(rows, spark.sparkContext.defaultParallelism) > 2
    blocks = PC.cached_blocks(seen[0], "scaled", "label", len(seen[0].first()["scaled"]), 64)
    sizes = blocks.mapPartitions(lambda p: [[len(y) for _, y in p]]).collect()
    assert sum(map(sum, sizes)) == rows and all(n == 64 for p in sizes for n in p[:-1])


def test_gradient_is_that_of_the_loss():
    r = np.random.default_rng(3)
    sizes, x, y = [5, 4, 3, 2], r.normal(size=(7, 5)), np.array([0, 1, 1, 0, 1, 0, 0])
    w = r.normal(size=5 * 4 + 4 + 4 * 3 + 3 + 3 * 2 + 2)

    def at(w):
        g = np.zeros_like(w)
        return PC.add_gradient(x, y, PC._layers(w, sizes), PC._layers(g, sizes), 0.5), g
    g = at(w)[1]
    for k in range(len(w)):
        e = np.zeros_like(w)
        e[k] = 1e-6
        assert abs((at(w + e)[0] - at(w - e)[0]) / 2e-6 - g[k]) < 1e-7


def test_minimum_of_a_quadratic_and_a_curved_valley():
    def valley(w):
        a, b = w
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])
    assert np.allclose(PC.minimised(valley, np.array([-1.2, 1.0]), 200, 1e-12), [1, 1], atol=1e-4)
    scales = np.array([1.0, 10.0, 1000.0])
    assert np.allclose(PC.minimised(lambda w: (float(scales @ w ** 2), 2 * scales * w), np.ones(3), 100, 1e-14), 0, atol=1e-4)


# ------------------------------------------------------------------ F1
def test_slots_of_a_trie_are_found_as_by_trying_each():
    from wardstat.llm import collocations as C
    r = np.random.default_rng(7)
    slots, taken = C._Slots(100), {0}
    for many in (200, 90, 40, 17, 16, 5, 3, 2, 2, 2):
        offsets = np.concatenate([[0], np.sort(r.choice(np.arange(1, 3000), many - 1, replace=False))])
        window, slot = slots.room(offsets, 0)
        first = next(s for s in range(8 * window, 10 ** 6) if not any(s + x in taken for x in offsets.tolist()))
        assert slot == first
        slots.take(slot + offsets)
        taken |= set((slot + offsets).tolist())
        used = slots.used()
        assert set(np.flatnonzero(used).tolist()) == taken


def test_trie_of_many_phrases_of_common_words():
    """Tries are built on the driver, so their building may not grow faster than the phrases: words with many
    followers are placed by windows, not slot by slot."""
    import time
    from wardstat.llm import collocations as C
    r = np.random.default_rng(1)
    words = np.sort(r.integers(1, 1 << 62, 20_000))
    at = np.unique((20_000 * r.random((400_000, 2)) ** 4).astype(int), axis=0)
    phrases = np.zeros((len(at), C.LONGEST), np.int64)
    phrases[:, :2] = words[at]
    began = time.process_time()
    trie, rows = C.build_trie(phrases[r.permutation(len(phrases))])
    took = time.process_time() - began
    codes = np.hstack([rows[:, :2], np.zeros((len(rows), 1), np.int64)]).ravel()
    *_, (_, pos, state) = C.advance(trie, codes, 2)
    assert np.array_equal(trie.number[state[pos % 3 == 0]], np.arange(len(rows))) and trie.phrases == len(at)
    assert len(trie.base) < 20 * len(at) and took < 8


# ------------------------------------------------------------------ F7
def test_groups_of_a_forest():
    assert MO.forest_groups(11_000, 200) == MO.forest_groups(3_988_638, 200) == MO.forest_groups(0, 200) == [200]
    assert MO.forest_groups(24_000_000, 200) == [40] * 5
    assert sum(MO.forest_groups(24_000_000, 201)) == 201 and max(MO.forest_groups(24_000_000, 201)) * 24_000_000 <= MO.ROWS_AND_TREES
    assert MO.forest_groups(10 ** 12, 3) == [1, 1, 1]


def test_forest_in_groups_is_one_model(spark, features, monkeypatch, tmp_path):
    """No group holds more rows times trees than allowed; the model has all trees, votes with each and can be stored."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import RandomForestClassifier
    fitted, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: fitted.append((self.getNumTrees(), df.count(), m := fit(self, df))) or m)
    monkeypatch.setattr(MO, "ROWS_AND_TREES", 900 * 3)
    model = MO.fit_pipeline(features, MO.random_forest(num_trees=7, max_depth=5), "balanced")
    forest = model.stages[-1]
    assert [f[:2] for f in fitted] == [(3, 900), (2, 900), (2, 900)]
    shapes = [t.toDebugString.split("\n", 1)[1] for _, _, m in fitted for t in m.trees]
    assert [t.toDebugString.split("\n", 1)[1] for t in forest.trees] == shapes and len(set(shapes)) == 7
    assert forest.getNumTrees == 7 and forest.getMaxDepth() == 5 and forest.getFeaturesCol() == "features"
    votes = [m.transform(model.transform(features).select("patient_id", "features")).select(
        "patient_id", "rawPrediction").orderBy("patient_id").collect()
        for _, _, m in fitted]
    raw = model.transform(features).orderBy("patient_id").select("patient_id", "rawPrediction").collect()
    for i, r in enumerate(raw):
        assert np.allclose(r["rawPrediction"].toArray(), sum(v[i]["rawPrediction"].toArray() for v in votes))
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert MO.positive_probability(again, features).exceptAll(MO.positive_probability(model, features)).count() == 0
