"""Evaluation E01-E13 over a long score table (model, split, key, y, prob).

Everything starts from one aggregation to distinct scores per (model, split) —
the row-level table is scanned once. Curves and rank statistics need running sums
in score order; those come from ``ordering.global_prefix`` (range-partitioned
prefix sums), never from a single-partition window over rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordering import global_prefix
from ..session import write_table

GROUP = ["model", "split"]


def _div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def confusion_matrix(scores: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """Tn, fp, fn, tp per (model, split) at ``prob >= cutoff``."""
    pred = F.col("prob") >= cutoff
    y = F.col("y")
    return scores.groupBy(*GROUP).agg(
        F.sum(F.when(~pred & (y == 0), 1).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when(pred & (y == 0), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(~pred & (y == 1), 1).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when(pred & (y == 1), 1).otherwise(0)).cast("long").alias("tp"))


def with_rates(cm: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, f1 from confusion counts; zero division -> 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec = _div(tp, tp + fp)
    rec = _div(tp, tp + fn)
    return cm.select("*", _div(tp + tn, tp + tn + fp + fn).alias("accuracy"), prec.alias("precision"),
                     rec.alias("recall"), _div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def threshold_metrics(scores: DataFrame, cutoff: float = 0.5) -> DataFrame:
    return with_rates(confusion_matrix(scores, cutoff))


def score_counts(scores: DataFrame) -> DataFrame:
    """(model, split, prob, n_pos, n_neg): the distinct-score table everything else uses."""
    return scores.groupBy(*GROUP, "prob").agg(
        F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).cast("long").alias("n_pos"),
        F.sum(F.when(F.col("y") == 0, 1).otherwise(0)).cast("long").alias("n_neg"))


def cumulative(scores: DataFrame) -> DataFrame:
    """Distinct scores with, per (model, split): pos/neg totals, counts strictly below and
    at-or-above each score (ascending prefix sums made group-local)."""
    # the rows are read once; the sums, totals and starts below read the distinct scores only
    pref = write_table(global_prefix(score_counts(scores), GROUP + ["prob"], ["n_pos", "n_neg"]), "score_prefix")
    sums = pref.groupBy(*GROUP).agg(F.sum("n_pos").alias("pos_total"), F.sum("n_neg").alias("neg_total"),
                                    F.min(F.col("cum_n_pos") - F.col("n_pos")).alias("__p0"),
                                    F.min(F.col("cum_n_neg") - F.col("n_neg")).alias("__n0"))
    j = pref.join(F.broadcast(sums), GROUP)                    # one row per (model, split)
    pos_below = F.col("cum_n_pos") - F.col("n_pos") - F.col("__p0")
    neg_below = F.col("cum_n_neg") - F.col("n_neg") - F.col("__n0")
    return j.select(*GROUP, "prob", "n_pos", "n_neg", "pos_total", "neg_total",
                    pos_below.alias("pos_below"), neg_below.alias("neg_below"),
                    (F.col("pos_total") - pos_below).alias("tp_at"), (F.col("neg_total") - neg_below).alias("fp_at"))


def roc_auc(scores: DataFrame, cum: DataFrame | None = None) -> DataFrame:
    """Tie-aware ROC-AUC (average-rank Mann-Whitney)."""
    c = cum if cum is not None else cumulative(scores)
    below = F.col("pos_below") + F.col("neg_below")
    cnt = F.col("n_pos") + F.col("n_neg")
    rank_sum = F.sum(F.col("n_pos") * (below + (cnt + 1) / 2.0))
    g = c.groupBy(*GROUP, "pos_total", "neg_total").agg(rank_sum.alias("__r"))
    p, n = F.col("pos_total").cast("double"), F.col("neg_total").cast("double")   # p * n leaves 64 bits
    return g.select(*GROUP, F.when((p == 0) | (n == 0), F.lit(None).cast("double"))
                    .otherwise((F.col("__r") - p * (p + 1) / 2.0) / (p * n)).alias("roc_auc"))


def average_precision(scores: DataFrame, cum: DataFrame | None = None) -> DataFrame:
    """Sum over distinct thresholds (descending) of (R_n - R_{n-1}) * P_n."""
    c = cum if cum is not None else cumulative(scores)
    prec = F.col("tp_at") / (F.col("tp_at") + F.col("fp_at"))
    return c.groupBy(*GROUP, "pos_total").agg(F.sum(F.col("n_pos") * prec).alias("__s")).select(
        *GROUP, F.when(F.col("pos_total") == 0, F.lit(0.0)).otherwise(F.col("__s") / F.col("pos_total"))
        .alias("average_precision"))


def roc_curve(scores: DataFrame, cum: DataFrame | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, from (0, 0) at an infinite threshold."""
    c = cum if cum is not None else cumulative(scores)
    start = c.select(*GROUP).distinct().select(*GROUP, F.lit(float("inf")).alias("threshold"),
                                                    F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(c.select(*GROUP, F.col("prob").alias("threshold"),
                    _div(F.col("fp_at"), F.col("neg_total")).alias("fpr"),
                    _div(F.col("tp_at"), F.col("pos_total")).alias("tpr")))


def pr_curve(scores: DataFrame, cum: DataFrame | None = None) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, to precision 1 at recall 0."""
    c = cum if cum is not None else cumulative(scores)
    end = c.select(*GROUP).distinct().select(*GROUP, F.lit(float("inf")).alias("threshold"),
                                                  F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return end.unionByName(c.select(*GROUP, F.col("prob").alias("threshold"),
                    _div(F.col("tp_at"), F.col("tp_at") + F.col("fp_at")).alias("precision"),
                    _div(F.col("tp_at"), F.col("pos_total")).alias("recall")))


def classification_report(scores: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """Per class precision/recall/f1/support, accuracy, macro avg, weighted avg."""
    m = with_rates(confusion_matrix(scores, cutoff))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    c1 = m.select(*GROUP, F.lit("1").alias("label"), _div(tp, tp + fp).alias("precision"),
                  _div(tp, tp + fn).alias("recall"), _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
                  (tp + fn).alias("support"))
    c0 = m.select(*GROUP, F.lit("0").alias("label"), _div(tn, tn + fn).alias("precision"),
                  _div(tn, tn + fp).alias("recall"), _div(2 * tn, 2 * tn + fn + fp).alias("f1"),
                  (tn + fp).alias("support"))
    per = c0.unionByName(c1)
    agg = per.groupBy(*GROUP).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("n"))
    acc = m.select(*GROUP, "accuracy")
    a = agg.join(acc, GROUP)
    rows = [a.select(*GROUP, F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1"), F.col("n").alias("support")),
            a.select(*GROUP, F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                     F.col("mf").alias("f1"), F.col("n").alias("support")),
            a.select(*GROUP, F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"),
                     F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support"))]
    out = per
    for r in rows:
        out = out.unionByName(r)
    return out.withColumn("support", F.col("support").cast("long"))


def summary_metrics(scores: DataFrame, cutoff: float = 0.5, cum: DataFrame | None = None) -> DataFrame:
    """(model, split) -> accuracy, precision, recall, f1, roc_auc, average_precision."""
    cum = cum if cum is not None else cumulative(scores)
    m = threshold_metrics(scores, cutoff).select(*GROUP, "accuracy", "precision", "recall", "f1")
    return m.join(roc_auc(scores, cum), GROUP).join(average_precision(scores, cum), GROUP)


METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]


def model_comparison(summary: DataFrame, splits=("validation", "test")) -> DataFrame:
    """One row per model, every metric for each split (conditional aggregation = pivot
    with a fixed value list, so no extra pass to discover the pivot values)."""
    aggs = [F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s in splits for m in METRICS]
    return summary.groupBy("model").agg(*aggs)


def generalization_gap(summary: DataFrame, metrics=("accuracy", "f1", "roc_auc")) -> DataFrame:
    """Train - validation and validation - test per model and metric."""
    aggs = []
    for m in metrics:
        v = {s: F.max(F.when(F.col("split") == s, F.col(m))) for s in ("train", "validation", "test")}
        aggs += [(v["train"] - v["validation"]).alias(f"{m}_train_minus_validation"),
                 (v["validation"] - v["test"]).alias(f"{m}_validation_minus_test")]
    return summary.groupBy("model").agg(*aggs)


def threshold_sweep(scores: DataFrame, start: int = 30, stop: int = 80) -> DataFrame:
    """E02 at thresholds i/100 for i in [start, stop] in one pass over the rows.

    Each distinct score gets the index of the largest threshold it reaches, computed
    exactly against the DOUBLE thresholds i/100.0 (floor(prob*100) alone is off by one
    for values like 0.29); counts per index are summed from the top (suffix sums over
    at most stop-start+2 rows per group)."""
    sc = score_counts(scores)
    c0 = F.floor(F.col("prob") * 100).cast("int")
    c = (F.when(((c0 + 1) / 100.0) <= F.col("prob"), c0 + 1)
         .when((c0 / 100.0) > F.col("prob"), c0 - 1).otherwise(c0))
    idx = F.least(F.greatest(c, F.lit(start - 1)), F.lit(stop)) - start
    per = sc.groupBy(*GROUP, idx.alias("idx")).agg(F.sum("n_pos").alias("p"), F.sum("n_neg").alias("n"))
    tot = sc.groupBy(*GROUP).agg(F.sum("n_pos").alias("pos_total"), F.sum("n_neg").alias("neg_total"))
    # threshold grid: every (model, split) group expanded to its fixed 51 indexes
    grid = tot.select(*GROUP, F.explode(F.sequence(F.lit(0), F.lit(stop - start))).alias("idx"))
    w = Window.partitionBy(*GROUP).orderBy(F.col("idx").desc()).rowsBetween(Window.unboundedPreceding, 0)
    full = (grid.join(per, GROUP + ["idx"], "left").na.fill(0, ["p", "n"])
            .withColumn("tp", F.sum("p").over(w)).withColumn("fp", F.sum("n").over(w)))
    # per includes idx = -1 rows (below every threshold); they never count as predicted positive.
    j = full.join(F.broadcast(tot), GROUP)
    cm = j.select(*GROUP, ((F.col("idx") + start) / 100.0).alias("threshold"),
                  F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
                  (F.col("pos_total") - F.col("tp")).cast("long").alias("fn"),
                  (F.col("neg_total") - F.col("fp")).cast("long").alias("tn"))
    return with_rates(cm)


def select_threshold(sweep: DataFrame, order_col: str = "config") -> DataFrame:
    """Qualifying rows (precision >= .50 and recall >= .10) first, then highest f1,
    first in (config, threshold) order."""
    q = ((F.col("precision") >= 0.5) & (F.col("recall") >= 0.1)).cast("int")
    return sweep.withColumn("qualifies", q).orderBy(F.col("qualifies").desc(), F.col("f1").desc(),
                                                    F.col(order_col), F.col("threshold")).limit(1)


def select_model(summary: DataFrame, order: DataFrame, split: str = "validation",
                 eligible: list[str] | None = None) -> DataFrame:
    """Highest validation AUC among eligible models, f1 tie-break, first listed on a
    full tie; gap to the runner-up."""
    s = summary.where(F.col("split") == split).join(F.broadcast(order), "model")
    if eligible is not None:
        s = s.where(F.col("model").isin(eligible))
    w = Window.orderBy(F.col("roc_auc").desc(), F.col("f1").desc(), F.col("position"))
    # one row per model: tiny window
    r = s.withColumn("rank", F.row_number().over(w)).withColumn("runner_up_auc", F.lead("roc_auc").over(w))
    return r.where("rank = 1").select("model", "roc_auc", "f1",
                                      (F.col("roc_auc") - F.col("runner_up_auc")).alias("gap_to_runner_up"))


def rank_models(summary: DataFrame, metric: str = "roc_auc", split: str = "validation") -> DataFrame:
    """Models ranked by a metric (1 = best, ties share a rank)."""
    s = summary.where(F.col("split") == split)
    return s.select("model", metric, F.rank().over(Window.orderBy(F.col(metric).desc())).alias("rank"))


def tuning_report(scores: DataFrame, start: int = 30, stop: int = 80) -> DataFrame:
    """Every model (configuration) at every threshold with its ROC-AUC, the always-zero
    baseline, and ``selected`` = 1 for the row that E11 chooses among the configurations.

    ``scores``: one long table of all configurations on one split, so the sweep and the AUC are
    one aggregation each over all of them."""
    base = (scores.groupBy(*GROUP).agg(F.count_if(F.col("y") == 1).alias("fn"), F.count_if(F.col("y") == 0).alias("tn"))
            .groupBy("split").agg(F.first("fn").alias("fn"), F.first("tn").alias("tn")))
    zero = with_rates(base.select(F.lit("always_zero").alias("model"), "split", F.lit(0.5).alias("threshold"),
                                  F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"), "fn", "tn"))
    sweep = threshold_sweep(scores, start, stop).join(F.broadcast(roc_auc(scores)), GROUP)      # one row per model
    chosen = select_threshold(sweep, "model").select("model", "split", "threshold", F.lit(1).alias("selected"))
    # no score separates anything for the baseline: half
    both = sweep.unionByName(zero.withColumn("roc_auc", F.lit(0.5)))
    return both.join(F.broadcast(chosen), ["model", "split", "threshold"], "left").withColumn(
        "selected", F.coalesce("selected", F.lit(0)))
