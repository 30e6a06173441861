"""Registered queries: evaluation (E01-E13) and association.

Metric inputs are a long score table built from ``orders`` without a model: three
deterministic pseudo-scores (price, customer, priority) for the label
y = (o_orderkey % 3 = 0), over a 60/20/20 stratified split of all orders.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vocab as V
from ..operators import association as A
from ..operators import metrics as M
from ..operators import splits as SP
from ..sources import tables as T
from .clinical import _memo, engineered
from .registry import register

MODEL_ORDER = [("price", 1), ("customer", 2), ("priority", 3)]
HIGH = 0.9


def model_probs(o):
    return {"price": F.round(F.col("o_totalprice") / 500000.0, 2),
            "customer": F.round((F.col("o_custkey") % 100) / 100.0, 2),
            "priority": F.when(F.col("o_orderpriority").startswith("1"), 0.9).otherwise(0.2)}


def scores(spark, sf):
    def build():
        o = T.table(spark, sf, "orders")
        base = o.select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 3 == 0).cast("int").alias("y"))
        assign = SP.stratified_split_3(base, "key", "y", seed=42).select("key", "split")
        out = None
        for name, e in model_probs(o).items():
            part = o.select(F.lit(name).alias("model"), F.col("o_orderkey").alias("key"),
                            (F.col("o_orderkey") % 3 == 0).cast("int").alias("y"), e.cast("double").alias("prob"))
            out = part if out is None else out.unionByName(part)
        return out.join(assign, "key").select("model", "split", "key", "y", "prob")
    return _memo(spark, sf, "scores", build)


def cumulative(spark, sf):
    """The distinct scores with their running counts: written once, read by AUC, AP, curves and summary."""
    return _memo(spark, sf, "cumulative", lambda: M.cumulative(scores(spark, sf)))


def model_order(spark):
    return spark.createDataFrame(MODEL_ORDER, "model string, position int")


@register("confusion_matrix")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(scores(spark, sf))


@register("threshold_metrics")
def threshold_metrics(spark, sf):
    return M.threshold_metrics(scores(spark, sf))


@register("tuning_report")
def tuning_report(spark, sf):
    """M09's report over the validation rows of the pseudo-scores, which SQL can follow."""
    return M.tuning_report(scores(spark, sf).where("split = 'validation'"))


@register("roc_auc")
def roc_auc(spark, sf):
    return M.roc_auc(scores(spark, sf), cumulative(spark, sf))


@register("average_precision")
def average_precision(spark, sf):
    return M.average_precision(scores(spark, sf), cumulative(spark, sf))


@register("roc_curve")
def roc_curve(spark, sf):
    return M.roc_curve(scores(spark, sf), cumulative(spark, sf))


@register("pr_curve")
def pr_curve(spark, sf):
    return M.pr_curve(scores(spark, sf), cumulative(spark, sf))


@register("classification_report")
def classification_report(spark, sf):
    return M.classification_report(scores(spark, sf))


def summary(spark, sf):
    return _memo(spark, sf, "summary", lambda: M.summary_metrics(scores(spark, sf), cum=cumulative(spark, sf)))


@register("generalization_gap")
def generalization_gap(spark, sf):
    return M.generalization_gap(summary(spark, sf))


@register("model_comparison")
def model_comparison(spark, sf):
    return M.model_comparison(summary(spark, sf))


def sweep(spark, sf):
    s = scores(spark, sf).where(F.col("split") == "validation")
    return M.threshold_sweep(s).join(F.broadcast(model_order(spark)).withColumnRenamed("position", "config"), "model")


@register("threshold_sweep")
def threshold_sweep(spark, sf):
    return sweep(spark, sf)


@register("select_threshold")
def select_threshold(spark, sf):
    return M.select_threshold(sweep(spark, sf), "config").select("model", "config", "threshold", "precision",
                                                                 "recall", "f1", "qualifies")


@register("select_model")
def select_model(spark, sf):
    return M.select_model(summary(spark, sf), model_order(spark))


@register("rank_models")
def rank_models(spark, sf):
    return M.rank_models(summary(spark, sf))


@register("always_zero")
def always_zero(spark, sf):
    """The reference scorer (probability 0 for every row) through the same metrics."""
    s = scores(spark, sf).where(F.col("model") == "price").withColumn("model", F.lit("always_zero")) \
        .withColumn("prob", F.lit(0.0))
    return M.summary_metrics(s)


# ------------------------------------------------------------------ association
@register("crosstab")
def crosstab(spark, sf):
    return A.crosstab(T.table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@register("cramers_v")
def cramers_v(spark, sf):
    return A.cramers_v(T.table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


CAT_FEATURES = V.CATEGORICAL_COLUMNS + V.ENGINEERED_CATEGORICAL
NUM_FEATURES = V.NUMERIC_COLUMNS + ["liver_risk", "polypharmacy", "elderly_high_dose", "de_ritis_ratio"]


def labelled_eng(spark, sf):
    return engineered(spark, sf).where(F.col(V.TARGET).isNotNull())


@register("association_matrix")
def association_matrix(spark, sf):
    return A.association_matrix(labelled_eng(spark, sf), CAT_FEATURES)


@register("rank_numeric")
def rank_numeric(spark, sf):
    return A.rank_numeric(labelled_eng(spark, sf), NUM_FEATURES, V.TARGET)


@register("rank_categorical")
def rank_categorical(spark, sf):
    return A.rank_categorical(labelled_eng(spark, sf), CAT_FEATURES, V.TARGET)


@register("high_corr_pairs")
def high_corr_pairs(spark, sf):
    """Over the patients' numeric columns, and two of ``lineitem`` that do go together."""
    e = A.high_corr_pairs(labelled_eng(spark, sf), NUM_FEATURES, HIGH)
    price = T.table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", (F.col("l_quantity") * 1.1 + F.col("l_tax")).alias("loaded_quantity"))
    return e.unionByName(A.high_corr_pairs(price, price.columns, HIGH))
