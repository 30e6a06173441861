"""Models M01-M10 as Spark ML pipelines (distributed training), batch scoring and
model persistence. The positive-class probability is ``vector_to_array(probability)[1]``."""
from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, MultilayerPerceptronClassifier,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V
from .perceptron import fit_perceptron
from .preprocess import feature_names, one_hot_pipeline
from .splits import class_weights

LABEL = "label"


def with_label(df: DataFrame, target: str = V.TARGET) -> DataFrame:
    return df.withColumn(LABEL, F.col(target).cast("double"))


def decision_tree(max_depth=8, min_leaf=10) -> DecisionTreeClassifier:
    """M01 (min_samples_split has no counterpart)."""
    return DecisionTreeClassifier(labelCol=LABEL, featuresCol="features", weightCol="weight",
                                  maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=42)


def random_forest(num_trees=200, max_depth=12, min_leaf=5) -> RandomForestClassifier:
    """M02. The node of each row in each tree is kept from level to level (the same forest), so that a level
    does not walk every row through 200 trees from the root."""
    return RandomForestClassifier(labelCol=LABEL, featuresCol="features", weightCol="weight", numTrees=num_trees,
                                  maxDepth=max_depth, minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt",
                                  cacheNodeIds=True, seed=42)


def weighted_gbt(max_iter=200, max_depth=6, step=0.1, subsample=0.8, colsample=0.8,
                 min_leaf=1) -> GBTClassifier:
    """row/column subsampling 0.8 (column sampling is per node in Spark); no L1/L2/gamma."""
    return GBTClassifier(labelCol=LABEL, featuresCol="features", weightCol="weight", maxIter=max_iter,
                         maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                         featureSubsetStrategy=str(colsample), minInstancesPerNode=min_leaf, seed=42)


def balanced_gbt(max_iter=100, max_depth=3) -> GBTClassifier:
    """M04."""
    return GBTClassifier(labelCol=LABEL, featuresCol="features", weightCol="weight", maxIter=max_iter,
                         maxDepth=max_depth, stepSize=0.1, subsamplingRate=0.8, seed=42)


def mlp(n_features: int, max_iter=100) -> list:
    """Inputs standardised by the train split, then dense 128-64-32 hidden layers, L-BFGS
    (no dropout / batch norm / weights)."""
    return [StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
            MultilayerPerceptronClassifier(labelCol=LABEL, featuresCol="scaled",
                                           layers=[n_features, 128, 64, 32, 2], maxIter=max_iter, seed=42)]


def add_weights(train: DataFrame, scheme: str) -> DataFrame:
    """'balanced' -> n / (2 n_c) per class (J12); 'positive:<w>' -> w for y=1 else 1."""
    if scheme == "balanced":
        return class_weights(train, LABEL)
    if scheme.startswith("positive:"):
        w = float(scheme.split(":", 1)[1])
        return train.withColumn("weight", F.when(F.col(LABEL) == 1, w).otherwise(1.0))
    return train.withColumn("weight", F.lit(1.0))


def oversample_balanced(train: DataFrame, seed: int = 42) -> DataFrame:
    """Seeded oversampling of the minority class to balance an unweighted learner.
    Each minority row is replicated floor(r) times plus one more with probability frac(r)
    (deterministic hash), so the work stays a per-row projection."""
    counts = {r[0]: r[1] for r in train.groupBy(LABEL).count().collect()}
    if len(counts) < 2:
        return train
    major = max(counts, key=counts.get)
    minor = min(counts, key=counts.get)
    ratio = counts[major] / counts[minor]
    whole = int(ratio)
    frac = ratio - whole
    u = F.pmod(F.hash(F.lit(seed), *[F.col(c) for c in train.columns]), F.lit(1000000)) / 1000000.0
    reps = F.when(F.col(LABEL) == minor, F.lit(whole) + F.when(u < frac, 1).otherwise(0)).otherwise(1)
    return train.withColumn("__r", F.explode(F.sequence(F.lit(1), reps))).drop("__r")


LEAST_ROWS_PER_TASK = 10_000    # of a fit: fewer are not worth a task, as every tree level is a job
PLAIN_FIT_ROWS = 50_000         # of a perceptron that Spark ML's own passes fit in seconds
MOST_ROWS_PER_TASK = 400_000    # of a fit: a task's rows are kept in memory between the levels


def fit_tasks(rows: int, cores: int) -> int:
    """Tasks of a fit over ``rows``: a whole number for each core, fewer only for small tables."""
    per_core = -(-rows // (cores * MOST_ROWS_PER_TASK))
    return max(1, min(cores * max(1, per_core), -(-rows // LEAST_ROWS_PER_TASK)))


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the tasks of a fit: a stored table is split by files and bytes, so small
    tables are one task, whatever the cores. Tables of one task stay as they are."""
    n = fit_tasks(df.count(), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(n) if n > 1 else df


def fit_pipeline(train_feats: DataFrame, estimator, weight_scheme: str = "none") -> PipelineModel:
    """Encoder (fit on train) + estimator (or a list of stages), trained on the train split only. The
    encoded rows of the trees are stored, as they are read several times before the first tree; a
    perceptron of many rows caches its own."""
    from ..session import write_table
    stages = estimator if isinstance(estimator, list) else [estimator]
    if weight_scheme == "oversample":
        data = oversample_balanced(with_label(train_feats))
        *before, last = stages
        if not isinstance(last, MultilayerPerceptronClassifier) or data.count() <= PLAIN_FIT_ROWS:
            return Pipeline(stages=one_hot_pipeline().getStages() + stages).fit(data)
        ready = Pipeline(stages=one_hot_pipeline().getStages() + before).fit(data)
        return PipelineModel(stages=[*ready.stages, fit_perceptron(last, ready.transform(dealt(data)))])
    data = add_weights(with_label(train_feats), weight_scheme)
    enc = one_hot_pipeline().fit(data)
    matrix = write_table(enc.transform(dealt(data)).select(LABEL, "weight", "features"), "fit_matrix")
    if isinstance(stages[-1], RandomForestClassifier) and len(stages) == 1:
        return PipelineModel(stages=[*enc.stages, fit_forest(stages[0], matrix)])
    fitted = Pipeline(stages=stages).fit(matrix)
    return PipelineModel(stages=enc.stages + fitted.stages)


ROWS_AND_TREES = 1_000_000_000      # rows times trees of a forest that are fitted at once


def forest_groups(rows: int, trees: int) -> list[int]:
    """Trees fitted at once: Spark holds a sample count and the nodes of every row for each of them, in
    memory or on disk, which for a whole forest grow with rows times trees."""
    at_once = max(1, min(trees, ROWS_AND_TREES // max(rows, 1)))
    k = -(-trees // at_once)
    return [trees // k + (i < trees % k) for i in range(k)]


def fit_forest(estimator: RandomForestClassifier, matrix: DataFrame) -> RandomForestClassificationModel:
    """The estimator fitted in groups of trees, one after the other, each with a seed of its own and over
    all rows; the model holds the trees of all groups. A small table's forest is one group."""
    groups = forest_groups(matrix.count(), estimator.getNumTrees())
    if len(groups) == 1:
        return estimator.fit(matrix)
    parts = [estimator.copy({estimator.numTrees: n, estimator.seed: estimator.getSeed() + i}).fit(matrix)
             for i, n in enumerate(groups)]
    trees = [t._java_obj for p in parts for t in p.trees]
    sc = matrix.sparkSession.sparkContext
    cls = sc._jvm.org.apache.spark.ml.classification
    held = sc._gateway.new_array(cls.DecisionTreeClassificationModel, len(trees))
    for i, t in enumerate(trees):
        held[i] = t
    # a model of given trees has no constructor in Python
    joined = cls.RandomForestClassificationModel(parts[0].uid, held, parts[0].numFeatures, parts[0].numClasses)
    model = RandomForestClassificationModel(parts[0]._java_obj.copyValues(joined, sc._jvm.org.apache.spark.ml.param.ParamMap()))
    return model.copy({model.numTrees: len(trees), model.seed: estimator.getSeed()})


def positive_probability(model: PipelineModel, df: DataFrame, key: str = "patient_id",
                         target: str = V.TARGET, cutoff: float = V.CUTOFF) -> DataFrame:
    """(key, actual_target, probability, predicted_class, predicted_outcome)."""
    scored = model.transform(df)
    p = vector_to_array("probability")[1]
    cls = (p >= cutoff).cast("int")
    return scored.select(key, F.col(target).alias("actual_target"), p.alias("probability"),
                         cls.alias("predicted_class"),
                         F.when(cls == 1, V.OUTCOME_LABELS[1]).otherwise(V.OUTCOME_LABELS[0]).alias("predicted_outcome"))


def feature_importance(model: PipelineModel, sample: DataFrame, top: int = 15) -> DataFrame:
    """Encoded feature importances (model metadata, at most #features rows), top n."""
    tree = model.stages[-1]
    names = feature_names(model.transform(sample.limit(1)))
    imp = tree.featureImportances.toArray().tolist()
    rows = sorted(zip(names, [float(v) for v in imp]), key=lambda t: -t[1])[:top]
    return sample.sparkSession.createDataFrame(rows, "feature string, importance double")


# ------------------------------------------------------------------ tuning
def encoded_matrix(encoder: PipelineModel, features: DataFrame, name: str, key: str = "patient_id",
                   target: str = V.TARGET, to_fit: bool = False) -> DataFrame:
    """(key, label, features): the encoder applied once and written, so that no fit encodes again.
    ``to_fit``: all labelled rows, ordered by key in the tasks of a fit."""
    from ..session import write_table
    m = with_label(encoder.transform(features), target).select(key, LABEL, "features")
    if to_fit:
        m = m.where(F.col(LABEL).isNotNull())
        n = features.where(F.col(target).isNotNull()).count()
        cores = features.sparkSession.sparkContext.defaultParallelism
        m = m.repartition(fit_tasks(n, cores), key).sortWithinPartitions(key)
    return write_table(m, name)


def fit_all(matrix: DataFrame, estimators: dict[str, tuple]) -> dict:
    """{name: model}: estimators (estimator, weight scheme) fitted at the same time over one stored
    matrix; the jobs of the fits share the cluster."""
    from concurrent.futures import ThreadPoolExecutor
    from pyspark import inheritable_thread_target

    def fit(item):
        name, (estimator, scheme) = item
        data = add_weights(matrix, scheme).select(LABEL, "weight", "features").persist()
        try:
            return name, estimator.fit(data)
        finally:
            data.unpersist()
    with ThreadPoolExecutor(max(1, len(estimators))) as pool:
        return dict(pool.map(inheritable_thread_target(matrix.sparkSession)(fit), estimators.items()))


def score_all(models: dict, matrix: DataFrame, split: str, key: str = "patient_id") -> DataFrame:
    """Long score table (model, split, key, y, prob) of all models over one matrix."""
    out = None
    for name, m in models.items():
        part = m.transform(matrix).select(F.lit(name).alias("model"), F.lit(split).alias("split"), F.col(key).alias("key"),
                                          F.col(LABEL).cast("int").alias("y"), vector_to_array("probability")[1].alias("prob"))
        out = part if out is None else out.unionByName(part)
    return out
