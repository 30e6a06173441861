"""Registered queries: sources/sinks (S01-S10), profiling (P01-P11), validation."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions import vocab as V
from ..operators import profile as P
from ..operators import validate as VA
from ..operators.cleaning import attach_row
from ..session import ensure_checkpoint_dir
from ..sources import io as IO
from ..sources import tables as T
from ..sources.fixture import ORDER_COL
from .clinical import RAW_TO_CANON, cleaned, patients, raw
from .registry import register

LINEITEM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def scratch_path(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ sources and sinks
@register("csv_ingest")
def csv_ingest(spark, sf):
    src = scratch_path(spark, "nation-csv")
    T.table(spark, sf, "nation").write.mode("overwrite").option("header", True).csv(src)
    out = scratch_path(spark, "nation-parquet")
    return IO.csv_to_parquet(spark, src, out)


@register("csv_ingest_orders")
def csv_ingest_orders(spark, sf):
    """The ingest over a table that grows with the scale factor."""
    src = scratch_path(spark, "orders-csv")
    T.table(spark, sf, "orders").write.mode("overwrite").option("header", True).csv(src)
    return IO.csv_to_parquet(spark, src, scratch_path(spark, "orders-parquet"))


@register("parquet_scan")
def parquet_scan(spark, sf):
    return T.table(spark, sf, "lineitem")


@register("pruned_scan")
def pruned_scan(spark, sf):
    return T.table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")


@register("table_shape")
def table_shape(spark, sf):
    return IO.table_shapes(spark, sf, T.TABLES)


@register("parquet_sink")
def parquet_sink(spark, sf):
    df = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return IO.write_parquet_and_read(df, scratch_path(spark, "lineitem-sink"))


@register("csv_sink")
def csv_sink(spark, sf):
    df = T.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return IO.write_csv_and_read(df, scratch_path(spark, "orders-csv"))


@register("table_load")
def table_load(spark, sf):
    return IO.load_table(patients(spark, sf), IO.PATIENTS_SCHEMA, scratch_path(spark, "patients"))


@register("row_order")
def row_order(spark, sf):
    return IO.with_row_order(spark, f"{sf.rstrip('/')}/orders.parquet").select("o_orderkey", "row_order")


@register("head_n")
def head_n(spark, sf):
    return T.table(spark, sf, "orders").orderBy("o_orderkey").limit(5)


# ------------------------------------------------------------------ profiling
def raw_numeric(r):
    return [c for c in P.numeric_columns(r) if c not in (ORDER_COL, "Patient_ID")]


@register("column_profile")
def column_profile(spark, sf):
    """``lineitem`` and the raw patient table."""
    line, r = T.table(spark, sf, "lineitem"), raw(spark, sf).drop(ORDER_COL)
    return P.column_profile(line).unionByName(P.column_profile(r))


@register("null_profile")
def null_profile(spark, sf):
    return P.null_profile(raw(spark, sf).drop(ORDER_COL))


@register("exact_dup_count")
def exact_dup_count(spark, sf):
    return P.exact_dup_count(raw(spark, sf).drop(ORDER_COL))


@register("numeric_describe")
def numeric_describe(spark, sf):
    """The measures of ``lineitem`` and all numeric columns of the raw patient table, infinities included."""
    r = raw(spark, sf)
    return P.numeric_describe(T.table(spark, sf, "lineitem"), LINEITEM_NUM).unionByName(P.numeric_describe(r, raw_numeric(r)))


@register("value_counts")
def value_counts(spark, sf):
    return P.value_counts(raw(spark, sf), "Gender")


@register("inf_profile")
def inf_profile(spark, sf):
    r = raw(spark, sf)
    return P.inf_profile(r, raw_numeric(r))


@register("seeded_sample")
def seeded_sample(spark, sf):
    return P.seeded_sample(T.table(spark, sf, "orders"), ["o_orderkey"], 1000, seed=42)


@register("histogram")
def histogram(spark, sf):
    r = raw(spark, sf)
    return P.histogram(T.table(spark, sf, "lineitem"), LINEITEM_NUM).unionByName(P.histogram(r, raw_numeric(r)))


@register("corr_matrix")
def corr_matrix(spark, sf):
    """Infinities of the raw table count as missing."""
    r = raw(spark, sf)
    return P.corr_matrix(T.table(spark, sf, "lineitem"), LINEITEM_NUM).unionByName(P.corr_matrix(r, raw_numeric(r)))


@register("key_profile")
def key_profile(spark, sf):
    return P.key_profile(raw(spark, sf), "Patient_ID", exclude=[ORDER_COL])


@register("constant_columns")
def constant_columns(spark, sf):
    return P.constant_columns(raw(spark, sf).drop(ORDER_COL))


# ------------------------------------------------------------------ validation
@register("key_integrity")
def key_integrity(spark, sf):
    return VA.key_integrity(T.table(spark, sf, "orders"), "o_orderkey")


@register("integer_key")
def integer_key(spark, sf):
    return VA.integer_key(raw(spark, sf), "patient_id_1")


@register("shape_expectation")
def shape_expectation(spark, sf):
    shapes = IO.table_shapes(spark, sf, ["region", "nation", "orders", "lineitem"])
    exp = spark.createDataFrame([("region", 5, 2), ("nation", 25, 3), ("orders", None, 6), ("lineitem", None, 11)],
                                "dataset string, exp_rows long, exp_cols long")
    return VA.shape_expectation(shapes, exp)


@register("lineage_audit")
def lineage_audit(spark, sf):
    r = raw(spark, sf)
    c = patients(spark, sf)
    row = attach_row(
        r.agg(F.count(F.lit(1)).alias("raw_rows"), F.countDistinct("Patient_ID").alias("raw_keys")),
        c.agg(F.count(F.lit(1)).alias("clean_rows"), F.countDistinct("patient_id").alias("clean_keys")))
    row = row.select("*", (F.col("raw_rows") - F.col("clean_rows")).alias("row_reduction"),
                     (F.col("raw_rows") - F.col("raw_keys")).alias("repeated_key_rows"),
                     F.lit(len(c.columns)).alias("clean_cols"))
    return VA.with_overall(VA._checks(row, [("row_reduction_equals_repeated_keys", "row_reduction", "repeated_key_rows"),
                            ("clean_rows_equal_distinct_keys", "clean_rows", "clean_keys"),
                            ("clean_keys_equal_raw_keys", "clean_keys", "raw_keys"),
                            ("clean_column_count", "clean_cols", 31)]))


@register("key_set_diff")
def key_set_diff(spark, sf):
    return VA.key_set_diff(T.table(spark, sf, "orders"), "o_custkey", T.table(spark, sf, "customer"), "c_custkey")


@register("value_agreement")
def value_agreement(spark, sf):
    return VA.value_agreement(patients(spark, sf), cleaned(spark, sf), "patient_id", "treatment_outcome")


@register("value_agreement_samples")
def value_agreement_samples(spark, sf):
    return VA.value_disagreements(patients(spark, sf), cleaned(spark, sf), "patient_id", "bmi")


@register("conversion_failures")
def conversion_failures(spark, sf):
    """All numeric measurements of the raw table, and the two that come as text."""
    text = ["Dosage", "Duration_Days"]
    r = raw(spark, sf).select(ORDER_COL, *RAW_TO_CANON, *[X.placeholder_to_null(c).alias(c) for c in text])
    return VA.conversion_failures(r, [*RAW_TO_CANON, *text], X.to_number, ORDER_COL)


@register("non_finite_values")
def non_finite_values(spark, sf):
    return VA.non_finite_values(raw(spark, sf), list(RAW_TO_CANON))


@register("domain_check")
def domain_check(spark, sf):
    return VA.domain_check(T.table(spark, sf, "labels"), ["quality", "toxic"])


@register("text_length_check")
def text_length_check(spark, sf):
    return VA.text_length_check(patients(spark, sf), V.TEXT_LIMITS)


@register("date_only_check")
def date_only_check(spark, sf):
    e = VA.date_only_check(T.table(spark, sf, "events"), "ts").select(F.lit("events.ts").alias("column"), "*")
    o = VA.date_only_check(T.table(spark, sf, "orders"), "o_orderdate").select(
        F.lit("orders.o_orderdate").alias("column"), "*")
    return e.unionByName(o)


@register("null_profile_diff")
def null_profile_diff(spark, sf):
    return VA.null_profile_diff(patients(spark, sf), cleaned(spark, sf))


@register("binary_distribution")
def binary_distribution(spark, sf):
    return VA.binary_distribution(patients(spark, sf), V.OUTCOME_COLUMNS)


@register("load_parity")
def load_parity(spark, sf):
    src = patients(spark, sf)
    stored = IO.load_table(src, IO.PATIENTS_SCHEMA, scratch_path(spark, "patients-parity"))
    return VA.load_parity(src, stored, "patient_id", V.OUTCOME_COLUMNS)


def pseudo_scores(spark, sf):
    """Deterministic score table from ``orders`` for metric checks without a model."""
    return T.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 3 == 0).cast("int").alias("y"),
        F.round(F.col("o_totalprice") / 500000.0, 2).alias("prob"))


@register("probability_validity")
def probability_validity(spark, sf):
    s = pseudo_scores(spark, sf)
    return VA.probability_validity(s, "prob", expected_rows=T.table(spark, sf, "orders"))


@register("score_alignment")
def score_alignment(spark, sf):
    a = pseudo_scores(spark, sf)
    b = T.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % 3 == 0).cast("int").alias("y"),
        (F.col("o_totalprice") * 0.000002).alias("prob_raw"))
    return VA.score_alignment(a, b, ["key", "y"], "prob", "prob_raw", atol=0.005, rtol=0.0)
