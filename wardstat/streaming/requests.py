"""Prediction requests: validation (R01), the prediction log (S08), and their stream
forms (R02, R03). Batch and stream share the same transform functions.

Requests arrive as raw JSON text. The request source used for checks is derived from
``events`` (one request per event; the body form depends on the event type).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V

# Shared SQL text (Spark and DuckDB) turning an event row into a raw request body.
REQUEST_BODY_SQL = """CASE event_type
  WHEN 'click' THEN '{"patient_id": ' || CAST(user_id + 1 AS STRING) || '}'
  WHEN 'view' THEN '{"patient_id": " ' || CAST(user_id + 1 AS STRING) || ' "}'
  WHEN 'purchase' THEN CASE user_id % 4 WHEN 0 THEN '{"patient_id": true}' WHEN 1 THEN '{"patient_id": "abc"}'
                       WHEN 2 THEN '{"patient_id": -' || CAST(user_id AS STRING) || '}' ELSE '{"patient_id": 3.5}' END
  WHEN 'error' THEN '{"patient_id": 0}'
  ELSE props END"""


def requests_from_events(events: DataFrame) -> DataFrame:
    """(request_id, received_at, body, score_hint) per event."""
    return events.select(F.col("event_id").alias("request_id"), F.col("ts").alias("received_at"),
                         F.expr(REQUEST_BODY_SQL).alias("body"), F.col("value").alias("score_hint"))


def validate_requests(req: DataFrame, body: str = "body") -> DataFrame:
    """Status in {missing_id, not_integer, not_positive, ok} and the parsed id.
    Booleans are rejected; digit strings are accepted after strip; other numbers must be integers."""
    b = F.col(body)
    present = b.rlike(r'"patient_id"\s*:')
    is_string = b.rlike(r'"patient_id"\s*:\s*"')
    v = F.get_json_object(b, "$.patient_id")
    digits = F.trim(v).rlike(r"^[0-9]+$")
    int_literal = v.rlike(r"^-?[0-9]+$")
    pid = (F.when(is_string & digits, F.trim(v).try_cast("long"))
           .when(~is_string & int_literal, v.try_cast("long")))
    status = (F.when(~present | b.isNull(), F.lit("missing_id"))
              .when(pid.isNull(), F.lit("not_integer"))
              .when(pid <= 0, F.lit("not_positive"))
              .otherwise(F.lit("ok")))
    return req.select("*", status.alias("status"), F.when(status == "ok", pid).alias("patient_id"))


def valid_probability(p: Column) -> Column:
    """V17 predicate that gates the sink: finite and inside [0, 1]."""
    return p.isNotNull() & ~F.isnan(p) & (p >= 0) & (p <= 1)


def score_requests(valid: DataFrame, patients: DataFrame, score: Column) -> DataFrame:
    """R02 core: valid requests LEFT JOIN patients (unknown id -> not_found), score, gate
    invalid probabilities. ``score`` is evaluated over the joined row."""
    p = patients.select("patient_id", F.lit(True).alias("__found"), *[c for c in patients.columns
                                                                      if c != "patient_id"])
    j = valid.join(p, "patient_id", "left")
    scored = j.withColumn("probability_effective", score)
    return scored.withColumn(
        "outcome_status",
        F.when(F.col("__found").isNull(), F.lit("not_found"))
        .when(~valid_probability(F.col("probability_effective")), F.lit("unavailable"))
        .otherwise(F.lit("scored")))


def prediction_rows(scored: DataFrame, model_name: str, model_version: str = "1",
                    time_col: str = "received_at") -> DataFrame:
    """S08 projection (without ids): model name/version, probability, cutoff, class, outcome text."""
    ok = scored.where(F.col("outcome_status") == "scored")
    cls = (F.col("probability_effective") >= V.CUTOFF).cast("int")
    return ok.select(
        "request_id", "patient_id", F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.col("probability_effective").cast("double").alias("probability_effective"),
        F.lit(V.CUTOFF).alias("cutoff"), cls.alias("predicted_class"),
        F.when(cls == 1, V.OUTCOME_LABELS[1]).otherwise(V.OUTCOME_LABELS[0]).alias("predicted_outcome"),
        F.col(time_col).alias("predicted_at"))


def assign_prediction_ids(rows: DataFrame, previous_max: int = 0) -> DataFrame:
    """id = previous max + 1-based position in (predicted_at, patient_id) order — computed
    with the distributed global-order helper, not a single-partition window."""
    from ..functions.ordering import global_prefix
    out = global_prefix(rows, ["predicted_at", "patient_id", "request_id"], index_col="__idx")
    return out.select((F.col("__idx") + 1 + F.lit(int(previous_max))).cast("long").alias("prediction_id"),
                      *[c for c in rows.columns if c != "request_id"])
