"""Validation, audit and reconciliation operators V02-V18.

Each returns check rows ``(check, observed, expected, passed)`` or a small report
table; every count is one partial aggregate over the full table, key-set
differences are anti-joins (shuffled on the key), never Python sets.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .cleaning import attach_row
from .profile import null_profile


def _checks(row: DataFrame, checks: list[tuple[str, str, object]]) -> DataFrame:
    """row: one-row frame; checks: (name, observed column, expected literal or column name).
    One ``inline`` over the single row, so the aggregate behind it is evaluated once."""
    structs = []
    for name, obs, exp in checks:
        e = f"`{exp}`" if isinstance(exp, str) else repr(exp)
        structs.append(f"named_struct('check', '{name}', 'observed', CAST(`{obs}` AS BIGINT), "
                       f"'expected', CAST({e} AS BIGINT))")
    out = row.select(F.expr(f"inline(array({', '.join(structs)}))"))
    return out.withColumn("passed", F.coalesce((F.col("observed") == F.col("expected")), F.lit(False)).cast("int"))


def with_overall(checks: DataFrame) -> DataFrame:
    """The check rows and their verdict: ``overall`` passes when all of them do."""
    # aggregated check rows: a handful
    total = checks.agg(F.sum("passed").alias("observed"), F.count(F.lit(1)).alias("expected"))
    return checks.unionByName(total.select(F.lit("overall").alias("check"), F.col("observed").cast("long").alias("observed"),
                                           F.col("expected").cast("long").alias("expected"),
                                           (F.col("observed") == F.col("expected")).cast("int").alias("passed")))


def key_integrity(df: DataFrame, key: str) -> DataFrame:
    """Key non-null and unique."""
    row = df.agg(F.sum(F.when(F.col(key).isNull(), 1).otherwise(0)).alias("null_keys"),
                 (F.count(F.col(key)) - F.countDistinct(key)).alias("duplicate_keys"))
    return _checks(row, [("null_keys", "null_keys", 0), ("duplicate_keys", "duplicate_keys", 0)])


def integer_key(df: DataFrame, key: str) -> DataFrame:
    """Key numeric and integer-valued (non-null values with a fractional part)."""
    k = F.col(key).cast("string").try_cast("double")
    row = df.agg(F.sum(F.when(k.isNotNull() & ((k % 1) != 0), 1).otherwise(0)).alias("non_integer"),
                 F.sum(F.when(F.col(key).isNotNull() & k.isNull(), 1).otherwise(0)).alias("non_numeric"))
    return _checks(row, [("non_integer_keys", "non_integer", 0), ("non_numeric_keys", "non_numeric", 0)])


def shape(df: DataFrame, name: str) -> DataFrame:
    """S04 row: dataset, n_rows, n_cols (count may be answered from parquet footers)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows")).select(
        F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"))


def shape_expectation(shapes: DataFrame, expected: DataFrame) -> DataFrame:
    """Shapes (dataset, n_rows, n_cols) joined to expectations (dataset, exp_rows, exp_cols);
    a NULL expectation is not checked."""
    j = shapes.join(F.broadcast(expected), "dataset", "left")
    ok = ((F.col("exp_rows").isNull() | (F.col("n_rows") == F.col("exp_rows"))) &
          (F.col("exp_cols").isNull() | (F.col("n_cols") == F.col("exp_cols"))))
    return j.select("dataset", "n_rows", "n_cols", "exp_rows", "exp_cols", ok.cast("int").alias("passed"))


def key_set_diff(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> DataFrame:
    """Number of distinct keys only in A and only in B (two anti-joins)."""
    ka = a.select(F.col(a_key).alias("k")).where(F.col("k").isNotNull()).distinct()
    kb = b.select(F.col(b_key).alias("k")).where(F.col("k").isNotNull()).distinct()
    only_a = ka.join(kb, "k", "left_anti").agg(F.count(F.lit(1)).cast("long").alias("only_in_a"))
    only_b = kb.join(ka, "k", "left_anti").agg(F.count(F.lit(1)).cast("long").alias("only_in_b"))
    return attach_row(only_a, only_b)


def value_agreement(a: DataFrame, b: DataFrame, key: str, col: str) -> DataFrame:
    """V07 summary: join by key; NULL = NULL counts as equal."""
    j = a.select(key, F.col(col).alias("a")).join(b.select(key, F.col(col).alias("b")), key)
    return j.agg(F.count(F.lit(1)).cast("long").alias("matched_keys"),
                 F.sum(F.when(~F.col("a").eqNullSafe(F.col("b")), 1).otherwise(0)).cast("long").alias("mismatches"),
                 F.sum(F.when(F.col("a").isNull() & F.col("b").isNull(), 1).otherwise(0)).cast("long").alias("both_null"))


def value_disagreements(a: DataFrame, b: DataFrame, key: str, col: str, n: int = 10) -> DataFrame:
    """V07 samples: first ``n`` mismatching keys in key order."""
    j = a.select(key, F.col(col).alias("value_a")).join(b.select(key, F.col(col).alias("value_b")), key)
    return j.where(~F.col("value_a").eqNullSafe(F.col("value_b"))).orderBy(key).limit(n)


def _per_column(df: DataFrame, cols: list[str], metrics: dict) -> DataFrame:
    """One aggregate over all columns (a single scan), unpivoted to one row per column.
    ``metrics``: name -> fn(column name) -> aggregate Column (cast to BIGINT)."""
    aggs = [fn(c).cast("long").alias(f"{c}__{m}") for c in cols for m, fn in metrics.items()]
    structs = ", ".join("named_struct('column', '{0}', {1})".format(
        c, ", ".join(f"'{m}', `{c}__{m}`" for m in metrics)) for c in cols)
    return df.agg(*aggs).select(F.expr(f"inline(array({structs}))"))


def _count_if(cond):
    return F.sum(F.when(cond, 1).otherwise(0))


def conversion_failures(df: DataFrame, cols: list[str], convert, order: str, samples: int = 5) -> DataFrame:
    """Non-null originals whose conversion yields NULL, per column: their number and the
    first ``samples`` of them in source order, joined by '|'.

    Counts are one aggregate. Samples: failures only, long form; the rank limit is applied in every
    task before the shuffle, so at most tasks x columns x samples rows move."""
    def text(c):
        x = F.col(c)
        if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
            inf = float("inf")
            return F.when(F.isnan(x), "nan").when(x == inf, "inf").when(x == -inf, "-inf").otherwise(x.cast("string"))
        return x.cast("string")
    failed = {c: F.col(c).isNotNull() & convert(text(c)).isNull() for c in cols}
    counts = _per_column(df, cols, {"failures": lambda c: _count_if(failed[c])})
    found = df.select(order, F.explode(F.array_compact(F.array(*[
        F.when(failed[c], F.struct(F.lit(c).alias("column"), text(c).alias("value"))) for c in cols]))).alias("f"))
    w = Window.partitionBy("f.column").orderBy(order)
    first = (found.withColumn("nr", F.row_number().over(w)).where(F.col("nr") <= samples)
             .groupBy(F.col("f.column").alias("column")).agg(F.array_sort(F.collect_list(F.struct("nr", "f.value"))).alias("s")))
    first = first.select("column", F.array_join("s.value", "|").alias("samples"))
    # one row per column on both sides
    return counts.join(F.broadcast(first), "column", "left").select(
        "column", F.coalesce("failures", F.lit(0)).cast("long").alias("failures"), F.coalesce("samples", F.lit("")).alias("samples"))


def non_finite_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Non-null values that are NaN or +-inf, per column."""
    return _per_column(df, cols, {"non_finite": lambda c: _count_if(
        F.col(c).isNotNull() & (F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))))})


def domain_check(df: DataFrame, cols: list[str], allowed=(0, 1)) -> DataFrame:
    """Values outside {allowed, NULL}, per column."""
    return _per_column(df, cols, {"outside": lambda c: _count_if(F.col(c).isNotNull() & ~F.col(c).isin(*allowed))})


def text_length_check(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Max length per text column vs its limit, number of values over it."""
    out = _per_column(df, list(limits), {
        "max_length": lambda c: F.max(F.length(c)),
        "over_limit": lambda c: _count_if(F.length(c) > limits[c])})
    lim = F.create_map(*[x for c, v in limits.items() for x in (F.lit(c), F.lit(v))])
    return out.select("column", lim[F.col("column")].cast("long").alias("limit"), "max_length", "over_limit")


def date_only_check(df: DataFrame, col: str) -> DataFrame:
    """Values with a time-of-day part (would be lost in a DATE column)."""
    ts = F.col(col).try_cast("timestamp")
    return df.agg(F.count(F.col(col)).cast("long").alias("non_null"),
                  F.sum(F.when(F.col(col).isNotNull() & ts.isNull(), 1).otherwise(0)).cast("long")
                  .alias("conversion_failures"),
                  F.sum(F.when(F.date_trunc("day", ts) != ts, 1).otherwise(0)).cast("long").alias("with_time_of_day"))


def null_profile_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per column NULL count before vs after (full outer on column name)."""
    b = null_profile(before).select("column", F.col("missing").alias("missing_before"))
    a = null_profile(after).select("column", F.col("missing").alias("missing_after"))
    return b.join(a, "column", "full").select("column", "missing_before", "missing_after",
                                               (F.coalesce("missing_after", F.lit(0)) -
                                                F.coalesce("missing_before", F.lit(0))).alias("change"))


def binary_distribution(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count of 0 / 1 / NULL per binary column."""
    return _per_column(df, cols, {"n_zero": lambda c: _count_if(F.col(c) == 0),
                                  "n_one": lambda c: _count_if(F.col(c) == 1),
                                  "n_null": lambda c: _count_if(F.col(c).isNull())})


def load_parity(source: DataFrame, stored: DataFrame, key: str, binary_cols: list[str]) -> DataFrame:
    """Row count, distinct keys, null counts and 0/1/NULL distributions equal on both
    sides. Each side is one aggregate (one scan) unpivoted to (metric, value)."""
    def metrics(df):
        named = [("rows", F.count(F.lit(1))), ("distinct_keys", F.countDistinct(key))]
        named += [(f"nulls:{c}", _count_if(F.col(f"`{c}`").isNull())) for c in df.columns]
        for c in binary_cols:
            named += [(f"{c}:0", _count_if(F.col(c) == 0)), (f"{c}:1", _count_if(F.col(c) == 1)),
                      (f"{c}:null", _count_if(F.col(c).isNull()))]
        row = df.agg(*[e.cast("long").alias(f"m{i}") for i, (_, e) in enumerate(named)])
        structs = ", ".join(f"named_struct('metric', '{n}', 'value', m{i})" for i, (n, _) in enumerate(named))
        return row.select(F.expr(f"inline(array({structs}))"))
    s = metrics(source).withColumnRenamed("value", "source_value")
    t = metrics(stored).withColumnRenamed("value", "stored_value")
    return s.join(t, "metric", "full").select(
        "metric", "source_value", "stored_value",
        F.coalesce(F.col("source_value") == F.col("stored_value"), F.lit(False)).cast("int").alias("passed"))


def probability_validity(scores: DataFrame, prob: str, expected_rows: DataFrame | None = None) -> DataFrame:
    """Probabilities that are not finite, below 0 or above 1."""
    p = F.col(prob)
    row = scores.agg(F.count(F.lit(1)).alias("rows"),
                     F.sum(F.when(p.isNull() | F.isnan(p) | p.isin(float("inf"), float("-inf")), 1).otherwise(0))
                     .alias("not_finite"),
                     F.sum(F.when(p < 0, 1).otherwise(0)).alias("below_zero"),
                     F.sum(F.when((p > 1) & ~F.isnan(p) & (p != float("inf")), 1).otherwise(0)).alias("above_one"))
    checks = [("not_finite", "not_finite", 0), ("below_zero", "below_zero", 0), ("above_one", "above_one", 0)]
    if expected_rows is not None:
        row = attach_row(row, expected_rows.agg(F.count(F.lit(1)).alias("expected_rows")))
        checks.append(("row_count", "rows", "expected_rows"))
    return _checks(row, checks)


def score_alignment(a: DataFrame, b: DataFrame, keys: list[str], col_a: str, col_b: str,
                    atol: float = 1e-12, rtol: float = 0.0) -> DataFrame:
    """Composite-key full join; max abs difference of the matched rows; all within
    atol + rtol*|b|. A key of one side only (a NULL key never matches) is counted and is not close."""
    x = a.select(*keys, F.col(col_a).alias("__a"), F.lit(True).alias("__in_a"))
    y = b.select(*keys, F.col(col_b).alias("__b"), F.lit(True).alias("__in_b"))
    j = x.join(y, keys, "full")
    left, right = F.coalesce("__in_a", F.lit(False)), F.coalesce("__in_b", F.lit(False))
    d = F.abs(F.col("__a") - F.col("__b"))
    return j.agg(F.count_if(left & right).alias("joined_rows"),
                 F.count_if(left & ~right).alias("only_left"), F.count_if(right & ~left).alias("only_right"),
                 F.max(F.when(left & right, d)).alias("max_abs_diff"),
                 F.min(F.when(left & right & (d <= atol + rtol * F.abs(F.col("__b"))), 1).otherwise(0)).cast("int").alias("all_close"))
