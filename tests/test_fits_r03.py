"""Findings of round 3 on the fits: even tasks, encoded once, the forest's node cache, no bound on rows."""
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from wardstat import session
from wardstat.functions import vocab as V
from wardstat.operators import models as MO
from wardstat.operators import preprocess as PP


@pytest.fixture(scope="module")
def features(spark):
    h = lambda i: F.pmod(F.hash("id", F.lit(i)), F.lit(1000))     # noqa: E731
    return session.cut_lineage(spark.range(0, 900, 1, 1).select(
        F.col("id").alias("patient_id"), *[(h(i) / 10.0).alias(c) for i, c in enumerate(V.FEATURE_NUMERIC)],
        *[F.concat(F.lit("v"), h(50 + i) % 3).alias(c) for i, c in enumerate(V.FEATURE_CATEGORICAL)],
        F.when(h(99) < 900, (h(0) + h(51) % 3 * 200 > 600).cast("int")).alias(V.TARGET)))


def _scores(model, df):
    return [tuple(r) for r in MO.positive_probability(model, df).orderBy("patient_id").select("patient_id", "probability").collect()]


def test_tasks_of_a_fit():
    assert MO.fit_tasks(0, 12) == MO.fit_tasks(MO.LEAST_ROWS_PER_TASK, 12) == 1
    assert MO.fit_tasks(66_477, 12) == 7
    assert MO.fit_tasks(3_988_638, 12) == 12 and MO.fit_tasks(24_000_000, 12) == 60
    assert 24_000_000 / 60 <= MO.MOST_ROWS_PER_TASK


def test_rows_of_one_file_are_dealt_to_all_tasks(spark, features, monkeypatch):
    """The rows of a fit are stored encoded, in tasks of the same size, whatever the files of the table."""
    written, write = [], session.write_table
    monkeypatch.setattr(session, "write_table", lambda df, name: written.append((name, df)) or write(df, name))
    monkeypatch.setattr(MO, "LEAST_ROWS_PER_TASK", 100)
    labelled = features.where(F.col(V.TARGET).isNotNull())
    assert labelled.rdd.getNumPartitions() == 1
    m = MO.fit_pipeline(labelled, MO.balanced_gbt(max_iter=2), "balanced")
    (name, matrix), = written
    sizes = [r[0] for r in matrix.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert name == "fit_matrix" and matrix.columns == ["label", "weight", "features"]
    assert len(sizes) == MO.fit_tasks(sum(sizes), spark.sparkContext.defaultParallelism) == 4
    assert sum(sizes) == labelled.count() and max(sizes) - min(sizes) <= 4
    assert len(_scores(m, features)) == 900


@pytest.mark.parametrize("make, settings, scheme", [
    (MO.random_forest, dict(num_trees=6, max_depth=7), "balanced"), (MO.decision_tree, {}, "balanced"),
    (MO.weighted_gbt, dict(max_iter=4, max_depth=4), "positive:2.3")])
def test_models_are_those_of_one_pipeline(spark, features, make, settings, scheme):
    """The stored matrix (its binary attributes included) and the node cache give the same trees."""
    labelled = features.where(F.col(V.TARGET).isNotNull())
    estimator = make(**settings)
    assert estimator.getCacheNodeIds() == (make is MO.random_forest)
    plain = estimator.copy({estimator.cacheNodeIds: False})
    data = MO.add_weights(MO.with_label(labelled), scheme)
    want = Pipeline(stages=PP.one_hot_pipeline().getStages() + [plain]).fit(data)
    got = MO.fit_pipeline(labelled, estimator, scheme)
    assert _scores(got, features) == _scores(want, features)
    assert got.stages[-1].toDebugString.split("\n")[1:] == want.stages[-1].toDebugString.split("\n")[1:]


def test_tuning_fits_on_every_labelled_row(spark, features, monkeypatch):
    monkeypatch.setattr(MO, "FIT_ROWS", 300, raising=False)
    monkeypatch.setattr(MO, "LEAST_ROWS_PER_TASK", 100)
    enc = PP.one_hot_pipeline().fit(features)
    m = MO.encoded_matrix(enc, features, "tuning-test", to_fit=True)
    keys = sorted(r[0] for r in m.select("patient_id").collect())
    assert keys == sorted(r[0] for r in features.where(F.col(V.TARGET).isNotNull()).select("patient_id").collect())
    assert m.rdd.getNumPartitions() > 1
