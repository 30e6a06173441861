"""Cleaning operators C02-C32 as lazy DataFrame plans.

Order is part of the semantics: consolidate -> dedup -> drop -> rename ->
placeholders -> dictionaries -> parse -> units -> inf -> ranges -> BMI -> dates ->
outcomes -> (impute -> cap). Everything up to the outcomes is one projection chain
around a single shuffle (the keep-first dedup); imputation and capping add one
statistics layer each, joined back as a broadcast one-row frame.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import exprs as X
from ..functions import stats
from ..functions import vocab as V
from ..session import cut_lineage, write_table
from ..sources.fixture import ORDER_COL


def find_column(df: DataFrame, candidates) -> str | None:
    """Case-insensitive name resolution (planning time only)."""
    lower = {c.lower(): c for c in df.columns}
    for n in candidates:
        if n.lower() in lower:
            return lower[n.lower()]
    return None


# ---------------------------------------------------------------- C04-C06
def consolidate(df: DataFrame) -> DataFrame:
    """C04 coalesce_fill (age, gender, drug), C05 unit_fill (weight), C06 split_pair_fill (BP).
    Runs on every raw row, before dedup and before placeholder nulling."""
    c = lambda n: find_column(df, [n])
    out = df
    for prim, sec in (("age", "age_1"), ("gender", "gender_1"), ("drug_name", "drug_name_1")):
        p, s = c(prim), c(sec)
        if p and s:
            out = out.withColumn(p, F.coalesce(F.col(p), F.col(s)))
    kg, lbs = c("weight_kg"), c("weight_lbs")
    if kg and lbs:
        out = out.withColumn(kg, F.coalesce(F.col(kg), F.col(lbs) / V.POUNDS_PER_KG))
    bp = c("blood_pressure")
    if bp:
        text = F.trim(F.col(bp))
        for i, target in ((1, c("systolic_bp")), (2, c("diastolic_bp"))):
            if target:
                part = F.nullif(F.regexp_extract(text, V.BLOOD_PRESSURE_PATTERN, i), F.lit("")).cast("double")
                out = out.withColumn(target, F.coalesce(F.col(target), part))
    return out


def fill_counts(df: DataFrame) -> DataFrame:
    """Report of C04-C06: one row per filled column with the number of values filled."""
    c = lambda n: find_column(df, [n])
    bp = F.trim(F.col(c("blood_pressure")))
    sys_p = F.nullif(F.regexp_extract(bp, V.BLOOD_PRESSURE_PATTERN, 1), F.lit(""))
    dia_p = F.nullif(F.regexp_extract(bp, V.BLOOD_PRESSURE_PATTERN, 2), F.lit(""))
    pairs = [
        ("age", F.col(c("age")).isNull() & F.col(c("age_1")).isNotNull()),
        ("gender", F.col(c("gender")).isNull() & F.col(c("gender_1")).isNotNull()),
        ("drug_name", F.col(c("drug_name")).isNull() & F.col(c("drug_name_1")).isNotNull()),
        ("weight_kg", F.col(c("weight_kg")).isNull() & F.col(c("weight_lbs")).isNotNull()),
        ("systolic_bp", F.col(c("systolic_bp")).isNull() & sys_p.isNotNull()),
        ("diastolic_bp", F.col(c("diastolic_bp")).isNull() & dia_p.isNotNull()),
    ]
    row = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(n) for n, cond in pairs])
    stack = ", ".join(f"'{n}', `{n}`" for n, _ in pairs)
    return row.select(F.expr(f"stack({len(pairs)}, {stack}) AS (column, filled)"))


# ---------------------------------------------------------------- C07
def dedup_keep_first(df: DataFrame, key: str, order: str = ORDER_COL) -> DataFrame:
    """Keep the first row per key in source order.

    Skew-safe form: ``min(order)`` per key is a partial (map-side) aggregation over
    two longs, so a key holding a third of all rows collapses to one row per map task;
    the rows are then selected with a semi-join on (key, order), which hash-partitions
    on both columns, so a hot key's rows spread over all reducers.
    """
    firsts = df.groupBy(F.col(key).alias("__key")).agg(F.min(order).alias("__first"))
    # the missing key is a key too: its first row stays
    return df.join(firsts, F.col(key).eqNullSafe(F.col("__key")) & (F.col(order) == F.col("__first")), "left_semi")


# ---------------------------------------------------------------- C02, C08
def drop_columns(df: DataFrame, names=V.DROP_COLUMNS) -> DataFrame:
    existing = [n for n in names if n in df.columns]
    return df.drop(*existing)


def canonical_schema(df: DataFrame, keep_order_col: bool = True) -> DataFrame:
    """Alias-list name resolution, fail on a missing required column, project the
    31 columns in order (the raw name matching happens at planning time)."""
    lower = {c.lower(): c for c in df.columns}
    sel, missing = [], []
    for target in V.FINAL_COLUMNS:
        src = target if target in df.columns else None
        if src is None:
            for alias in V.ALIASES.get(target, [target]):
                if alias in lower:
                    src = lower[alias]
                    break
        if src is None:
            missing.append(target)
        else:
            sel.append(F.col(f"`{src}`").alias(target))
    if missing:
        raise ValueError(f"no column for {missing}")
    if keep_order_col and ORDER_COL in df.columns:
        sel = [F.col(ORDER_COL)] + sel
    return df.select(*sel)


def schema_diff(df: DataFrame) -> DataFrame:
    """C02 precondition report: required names missing / unexpected raw names."""
    spark = df.sparkSession
    lower = {c.lower() for c in df.columns if c != ORDER_COL}
    expected_raw = {a for t in V.FINAL_COLUMNS for a in V.ALIASES.get(t, [t])}
    expected_raw |= {d.lower() for d in V.DROP_COLUMNS}
    rows = []
    for t in V.FINAL_COLUMNS:
        if not any(a in lower for a in V.ALIASES.get(t, [t])):
            rows.append(("missing", t))
    for c in sorted(lower - expected_raw):
        rows.append(("unexpected", c))
    return spark.createDataFrame(rows, "kind string, name string")


# ---------------------------------------------------------------- C09-C27
_CANON = {
    "gender": X.canonical_gender, "ethnicity": X.canonical_ethnicity, "drug_name": X.canonical_drug,
    "route": X.canonical_route, "diagnosis": X.canonical_diagnosis, "smoking_status": X.canonical_smoking,
    "alcohol_use": X.normalize_text,
}


def normalize_values(df: DataFrame, bounded_bmi: bool, binary=X.binary_from_text) -> DataFrame:
    """C09-C27 on the canonical 31 columns; a pure projection chain."""
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    out = df.select(*[X.placeholder_to_null(c).alias(c) if c in text_cols else F.col(c) for c in df.columns])
    exprs = {}
    for c, fn in _CANON.items():
        exprs[c] = fn(c)
    for c in V.NUMERIC_COLUMNS:
        if c == "dosage_mg":
            e = X.extract_dosage(c)
        elif c == "duration_days":
            e = X.duration_days(c)
        elif c in text_cols:
            e = X.to_number(c)
        else:
            e = F.col(c).cast("double")
        exprs[c] = e
    out = out.select(*[exprs.get(c, F.col(c)).alias(c) for c in out.columns])
    # units, non-finite, ranges
    out = out.withColumn("height_cm", X.feet_to_cm("height_cm"))
    out = out.select(*[
        X.in_range_or_null(X.finite_or_null(c), *V.RANGES[c]).alias(c) if c in V.RANGES else F.col(c)
        for c in out.columns])
    out = out.withColumn("bmi", X.recompute_bmi("bmi", "weight_kg", "height_cm", bounded=bounded_bmi))
    out = out.withColumn("admission_date", X.parse_mixed_date("admission_date"))
    for c in ("treatment_outcome", "adverse_event"):
        out = out.withColumn(c, binary(c) if c in text_cols else X.keep_zero_one(c))
    out = out.withColumn("readmission_30d",
                         binary(F.col("readmission_30d")) if "readmission_30d" in text_cols
                         else X.keep_zero_one("readmission_30d"))
    return out


def _prepared(raw: DataFrame) -> DataFrame:
    key = find_column(raw, V.KEY_CANDIDATES)
    if key is None:
        raise ValueError(f"none of {V.KEY_CANDIDATES} is a column")
    df = consolidate(raw)
    df = dedup_keep_first(df, key)
    df = drop_columns(df)
    return canonical_schema(df)


def clean_deterministic(raw: DataFrame) -> DataFrame:
    """C02-C27 with numeric-aware binary mapping and bounded BMI; no imputation."""
    return normalize_values(_prepared(raw), bounded_bmi=True, binary=X.binary_from_any)


def clean_rules(raw: DataFrame) -> DataFrame:
    """C02-C27 as the full cleaning job applies them (strict labels, unbounded BMI)."""
    return normalize_values(_prepared(raw), bounded_bmi=False, binary=X.binary_from_text)


# ---------------------------------------------------------------- C28-C31
def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Attach a one-row statistics frame to every row. The stats side is a global
    aggregate (exactly one row), so this broadcast is bounded by construction."""
    return df.join(F.broadcast(row))


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL -> exact column median, all columns from one statistics layer."""
    med = stats.quantile_row(df, cols, [0.5], names={(c, 0.5): f"{c}__med" for c in cols})
    j = attach_row(df, med)
    return j.select(*[F.coalesce(F.col(c), F.col(f"{c}__med")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def impute_mode(df: DataFrame, cols: list[str], cast_back: dict | None = None) -> DataFrame:
    """NULL category -> most frequent value (ties -> smallest)."""
    m = stats.mode_row(df, cols)
    cast_back = cast_back or {}
    j = attach_row(df, m)
    out = []
    for c in df.columns:
        if c in cols:
            fill = F.col(c + "__mode")
            if c in cast_back:
                fill = fill.cast(cast_back[c])
            out.append(F.coalesce(F.col(c), fill).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def iqr_limits(df: DataFrame, cols: list[str]) -> DataFrame:
    """q1, q3, iqr, lower, upper per column (one row per column)."""
    q = stats.exact_quantiles(df, cols, [0.25, 0.75])
    lim = q.groupBy("column").agg(F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
                                  F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"))
    return (lim.withColumn("iqr", F.col("q3") - F.col("q1"))
            .withColumn("lower", F.col("q1") - V.IQR_FACTOR * F.col("iqr"))
            .withColumn("upper", F.col("q3") + V.IQR_FACTOR * F.col("iqr")))


def _limits_row(limits: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for c in cols:
        for f in ("lower", "upper"):
            aggs.append(F.max(F.when(F.col("column") == c, F.col(f))).alias(f"{c}__{f}"))
    return cut_lineage(limits.agg(*aggs))


def clip(c, lower, upper):
    """NULL-safe clip: NULL stays NULL (greatest/least would skip it)."""
    c = X.col(c)
    return F.when(c.isNull(), c).otherwise(F.least(F.greatest(c, lower), upper))


def iqr_cap(df: DataFrame, cols: list[str], limits: DataFrame | None = None) -> DataFrame:
    """Clip to [q1 - 1.5 IQR, q3 + 1.5 IQR]."""
    limits = limits if limits is not None else iqr_limits(df, cols)
    row = _limits_row(limits, cols)
    j = attach_row(df, row)
    return j.select(*[clip(c, F.col(f"{c}__lower"), F.col(f"{c}__upper")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def iqr_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """C30 report: q1, q3, iqr, limits, #below, #above, min/max after capping."""
    limits = iqr_limits(df, cols)
    lv = stats.long_values(df, cols).join(F.broadcast(limits), "column")
    capped = F.least(F.greatest(F.col("value"), F.col("lower")), F.col("upper"))
    return lv.groupBy("column", "q1", "q3", "iqr", "lower", "upper").agg(
        F.sum(F.when(F.col("value") < F.col("lower"), 1).otherwise(0)).cast("long").alias("below"),
        F.sum(F.when(F.col("value") > F.col("upper"), 1).otherwise(0)).cast("long").alias("above"),
        F.min(capped).alias("min_after"), F.max(capped).alias("max_after"))


def clean_full(raw: DataFrame, bmi_imputation: str = "median") -> DataFrame:
    """C02-C30. Statistics: pass 1 medians + modes (after range nulling),
    pass 2 quartiles on imputed values.

    The rule-cleaned table is written once (parquet, checkpoint folder) before the
    statistics passes (each pass would otherwise re-run the regex projection and
    the dedup shuffle), and again after imputation."""
    return impute_and_cap(write_table(clean_rules(raw), "clean_rules"), bmi_imputation)


def impute_and_cap(df: DataFrame, bmi_imputation: str = "median") -> DataFrame:
    """C28-C30 on a rule-cleaned (C02-C27) table that is already materialized."""
    numeric = [c for c in V.NUMERIC_COLUMNS if not (c == "bmi" and bmi_imputation == "mode")]
    categorical = list(V.CATEGORICAL_COLUMNS) + (["bmi"] if bmi_imputation == "mode" else [])
    df = impute_median(df, numeric)
    df = write_table(impute_mode(df, categorical, cast_back={"bmi": "double"}), "imputed")
    return iqr_cap(df, V.IQR_COLUMNS)
