"""Registered queries: filters, splits, joins (J01-J16), V16, the prediction log
and the batch twin of request validation (R01)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vocab as V
from ..operators import analytics as AN
from ..operators import splits as SP
from ..sources import tables as T
from ..streaming import requests as RQ
from .clinical import cleaned, engineered, patients, _memo
from .profiling import pseudo_scores
from .registry import register

LOOKUP_ID = 100
HISTORY_ID = 100
HINT_MODEL = "request_score_hint"    # the score that a request carries


def labelled(spark, sf):
    return patients(spark, sf).where(F.col(V.TARGET).isNotNull())


def assignments(spark, sf):
    """J05 on the labelled stored patients: (patient_id, treatment_outcome, split)."""
    return _memo(spark, sf, "assignments",
                 lambda: SP.stratified_split_3(labelled(spark, sf), "patient_id", V.TARGET, seed=42))


@register("labelled_filter")
def labelled_filter(spark, sf):
    return SP.labelled_filter(cleaned(spark, sf))[1]


@register("leakage_projection")
def leakage_projection(spark, sf):
    return SP.leakage_projection(engineered(spark, sf))


@register("stratified_split_2")
def stratified_split_2(spark, sf):
    return SP.stratified_split_2(T.table(spark, sf, "orders"), "o_orderkey", "o_orderstatus", 0.2, 42)


@register("stratified_split_3")
def stratified_split_3(spark, sf):
    return assignments(spark, sf)


@register("stratified_split_3b")
def stratified_split_3b(spark, sf):
    return SP.stratified_split_3b(labelled(spark, sf), "patient_id", V.TARGET, seed=42)


@register("split_assignments")
def split_assignments(spark, sf):
    a = assignments(spark, sf)
    return SP.split_assignments(a.where("split = 'train'"), a.where("split = 'validation'"),
                                a.where("split = 'test'"), "patient_id")


@register("join_one_to_one")
def join_one_to_one(spark, sf):
    a = SP.with_assignment_order(assignments(spark, sf).select("patient_id", "split"), ["split", "patient_id"])
    return SP.join_one_to_one(a, patients(spark, sf), "patient_id")


@register("join_left_check")
def join_left_check(spark, sf):
    return SP.join_left_check(cleaned(spark, sf), patients(spark, sf), "patient_id", V.TARGET)


@register("join_scores")
def join_scores(spark, sf):
    o = T.table(spark, sf, "orders")
    truth = pseudo_scores(spark, sf).select("key", "y")
    mk = lambda e: o.select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 3 == 0).cast("int").alias("y"),
                            e.alias("prob"))
    scores = {"price": mk(F.round(F.col("o_totalprice") / 500000.0, 2)),
              "customer": mk(F.round((F.col("o_custkey") % 100) / 100.0, 2)),
              "priority": mk(F.when(F.col("o_orderpriority").startswith("1"), 0.9).otherwise(0.2))}
    return SP.join_scores(truth, scores, ["key", "y"])


@register("split_summary")
def split_summary(spark, sf):
    return SP.split_summary(assignments(spark, sf), V.TARGET)


@register("class_weights")
def class_weights(spark, sf):
    a = assignments(spark, sf).where("split = 'train'")
    return SP.class_weights(a, V.TARGET).select("patient_id", V.TARGET, "weight")


@register("split_integrity")
def split_integrity(spark, sf):
    return SP.split_integrity(assignments(spark, sf), labelled(spark, sf), "patient_id")


# ------------------------------------------------------------------ requests and prediction log
def requests(spark, sf):
    return RQ.requests_from_events(T.table(spark, sf, "events"))


@register("stream_validate_requests")
def stream_validate_requests(spark, sf):
    """R01 batch twin."""
    return RQ.validate_requests(requests(spark, sf)).select("request_id", "status", "patient_id")


def prediction_log(spark, sf):
    """Valid requests scored with the request's carried score (value / 50; values
    above 50 give invalid probabilities that must not reach the log)."""
    def build():
        v = RQ.validate_requests(requests(spark, sf)).where("status = 'ok'")
        scored = RQ.score_requests(v, patients(spark, sf).select("patient_id"), F.col("score_hint") / 50.0)
        return RQ.assign_prediction_ids(RQ.prediction_rows(scored, HINT_MODEL), previous_max=0)
    return _memo(spark, sf, "prediction_log", build)


@register("prediction_log")
def prediction_log_q(spark, sf):
    return prediction_log(spark, sf)


@register("latest_predictions")
def latest_predictions(spark, sf):
    return AN.latest_predictions(prediction_log(spark, sf))


@register("prediction_context")
def prediction_context(spark, sf):
    return AN.prediction_context(prediction_log(spark, sf), patients(spark, sf))


@register("prediction_history")
def prediction_history(spark, sf):
    return AN.prediction_history(prediction_log(spark, sf), patients(spark, sf), HISTORY_ID)


@register("point_lookup")
def point_lookup(spark, sf):
    return SP.point_lookup(patients(spark, sf), LOOKUP_ID)
