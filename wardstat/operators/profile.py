"""Profiling operators P01-P11; each returns a table, computed in one pass per layer.

Per-column statistics use one wide aggregate (count / sum(CASE) / min / max / corr are
all partial-aggregatable), then ``stack`` to unpivot. Exact distinct counts go
through a (column, value) long form, so 41 columns cost one shuffle, not 41 jobs.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, ByteType, StringType)

from ..functions import stats
from .cleaning import attach_row

_NUMERIC = (DoubleType, FloatType, IntegerType, LongType, ShortType, ByteType, DecimalType)
MISSING_LABEL = "<MISSING>"


def role(dtype) -> str:
    if isinstance(dtype, _NUMERIC):
        return "numeric"
    if isinstance(dtype, (StringType, BooleanType)):
        return "categorical"
    return "unsupported"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def _unpivot_row(row: DataFrame, names: list[str], fields: list[str]) -> DataFrame:
    """Row with columns ``{name}__{field}`` -> one row per name with ``fields``."""
    n = len(names)
    structs = ", ".join(
        "named_struct('column', '{0}', {1})".format(
            nm, ", ".join(f"'{f}', `{nm}__{f}`" for f in fields)) for nm in names)
    return row.select(F.expr(f"inline(array({structs}))"))


def column_profile(df: DataFrame) -> DataFrame:
    """Column, dtype, role, non_null, n_distinct (exact)."""
    cols = df.columns
    lv = stats.long_values(df, cols, cast="string")
    distinct = lv.groupBy("column", "value").agg(F.count(F.lit(1)).alias("c")).groupBy("column").agg(
        F.count(F.lit(1)).cast("long").alias("n_distinct"), F.sum("c").cast("long").alias("non_null"))
    spark = df.sparkSession
    meta = spark.createDataFrame([(f.name, f.dataType.simpleString(), role(f.dataType), i) for i, f in enumerate(df.schema.fields)],
                                 "column string, dtype string, role string, position int")
    return (meta.join(F.broadcast(distinct), "column", "left")   # one row per column on both sides
            .select("column", "dtype", "role", F.coalesce("non_null", F.lit(0)).cast("long").alias("non_null"),
                    F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct")))


def null_profile(df: DataFrame) -> DataFrame:
    """Column, missing, missing_pct (0 when the table is empty)."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.sum(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)).alias(f"{c}__missing") for c in cols])
    out = _unpivot_row(row.select("*", *[F.col("__n").alias(f"{c}__n") for c in cols]), cols, ["missing", "n"])
    return out.select("column", F.col("missing").cast("long").alias("missing"),
                      F.when(F.col("n") > 0, F.round(100.0 * F.col("missing") / F.col("n"), 6))
                      .otherwise(F.lit(0.0)).alias("missing_pct"))


def exact_dup_count(df: DataFrame) -> DataFrame:
    """Rows that are full copies of an earlier row = sum(count - 1) over full-row groups."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    return g.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("long").alias("exact_duplicates"))


def numeric_describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, q25, q50, q75, max per numeric column."""
    cols = cols or numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    base = _unpivot_row(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    q = stats.exact_quantiles(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), cols, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
                                   for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return base.join(F.broadcast(qw), "column", "left").select(
        "column", F.col("count").cast("long").alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Value (NULL as '<MISSING>'), count, pct of all rows."""
    v = F.coalesce(F.col(col).cast("string"), F.lit(MISSING_LABEL))
    counts = df.groupBy(v.alias("value")).agg(F.count(F.lit(1)).cast("long").alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("__total"))
    return attach_row(counts, total).select(
        "value", "count", F.round(100.0 * F.col("count") / F.col("__total"), 6).alias("pct"))


def inf_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per numeric column: count of +inf and of -inf."""
    cols = cols or numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.sum(F.when(x == float("inf"), 1).otherwise(0)).alias(f"{c}__pos_inf"),
                 F.sum(F.when(x == float("-inf"), 1).otherwise(0)).alias(f"{c}__neg_inf")]
    out = _unpivot_row(df.agg(*aggs), cols, ["pos_inf", "neg_inf"])
    return out.select("column", F.col("pos_inf").cast("long").alias("pos_inf"),
                      F.col("neg_inf").cast("long").alias("neg_inf"))


def seeded_sample(df: DataFrame, key_cols: list[str], n: int = 100_000, seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if there are fewer), seeded, without replacement: the first in the
    order of md5(seed || key).

    Rows are counted by the first digits of the hash (16^L about sqrt(N) buckets); buckets before
    the one in which n is reached are taken whole, and only that bucket is ranked. The driver
    sees one count, no row."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols]))
    total = df.count()
    if total <= n:
        return df
    digits = max(1, round(math.log(math.sqrt(total), 16)))
    tagged = df.withColumn("__h", key).withColumn("__b", F.substring("__h", 1, digits))
    counts = tagged.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    cum = counts.withColumn("__cum", F.sum("__n").over(Window.orderBy("__b")))                 # over sqrt(N) buckets
    edge = cum.where(F.col("__cum") >= n).agg(F.min_by(F.struct("__b", (F.lit(n) - F.col("__cum") + F.col("__n")).alias("take")), "__b").alias("e"))
    j = attach_row(tagged, edge)                                                             # one row
    whole = j.where(F.col("__b") < F.col("e.__b"))
    part = (j.where(F.col("__b") == F.col("e.__b")).withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy("__h")))
            .where(F.col("__r") <= F.col("e.take")))
    return whole.select(*df.columns).unionByName(part.select(*df.columns))


def histogram(df: DataFrame, cols: list[str] | None = None, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max] per column, last bin closed; NULL/inf dropped."""
    cols = cols or numeric_columns(df)
    lv = stats.long_values(df, cols).where(~F.isnan("value") & ~F.col("value").isin(float("inf"), float("-inf")))
    mm = lv.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    # mm has one row per column: bounded broadcast.
    counts = (lv.join(F.broadcast(mm), "column").groupBy("column", b.alias("bin"))
              .agg(F.count(F.lit(1)).cast("long").alias("count")))
    every = mm.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))    # columns x bins rows
    return (every.join(F.broadcast(counts), ["column", "bin"], "left")
            .withColumn("count", F.coalesce("count", F.lit(0)).cast("long"))
            .select("column", "bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins)
                    .alias("bin_start"), "count"))


def pearson(a: str, b: str):
    """Pearson r over the rows that have both values; NULL (no error) where one of them is constant."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson r for every pair of columns, mirrored, diagonal 1.0. Rows where either side is
    NULL or not finite do not count (pairwise-complete); a constant side gives NULL.

    One pass after the means: a batch of rows is a matrix, and the sums of all pairs are four matrix
    products (numpy in Arrow batches); a task passes on columns x columns sums. Values are
    centred first, so the sums do not cancel."""
    cols = cols or numeric_columns(df)
    k = len(cols)
    ids = [f"x{i}" for i in range(k)]
    x = df.select(*[F.when(~F.isnan(c) & ~c.isin(float("inf"), float("-inf")), c).alias(i)
                    for i, c in zip(ids, (F.col(f"`{c}`").cast("double") for c in cols))])
    means = [m or 0.0 for m in x.agg(*[F.avg(i) for i in ids]).first()]          # one row

    def sums(batches):
        import numpy as np
        import pyarrow as pa
        total = np.zeros((4, k, k))
        for batch in batches:
            v = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) if batch.num_rows else np.zeros((0, k))
            there = ~np.isnan(v)
            v = np.where(there, v - np.array(means), 0.0)
            there = there.astype(float)
            total += np.stack([there.T @ there, v.T @ there, (v * v).T @ there, v.T @ v])
        i, j = np.triu_indices(k, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(z) for z in (i, j, total[0][i, j], total[1][i, j], total[1][j, i], total[2][i, j], total[2][j, i], total[3][i, j])],
            ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])
    part = x.mapInArrow(sums, "i long, j long, n double, sx double, sy double, sxx double, syy double, sxy double")
    g = part.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n = F.col("n")
    sx, sy = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), n), F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)
    sxy = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    # a constant side leaves rounding only
    flat = (sx <= 1e-14 * F.col("sxx")) | (sy <= 1e-14 * F.col("syy"))
    names = F.array(*[F.lit(c) for c in cols])
    upper = g.select(names[F.col("i").cast("int")].alias("col_a"), names[F.col("j").cast("int")].alias("col_b"),
                     F.when(~flat, F.try_divide(sxy, F.sqrt(F.greatest(sx, F.lit(0.0))) * F.sqrt(F.greatest(sy, F.lit(0.0))))).alias("r"))
    lower = upper.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "r")
    spark = df.sparkSession
    diag = spark.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, r double")
    return upper.unionByName(lower).unionByName(diag)


def key_profile(df: DataFrame, key: str, exclude: list[str] | None = None) -> DataFrame:
    """P10: rows, distinct keys, extra rows beyond first, non-identical estimate."""
    cols = [c for c in df.columns if c not in (exclude or [])]
    counts = df.agg(F.count(F.lit(1)).cast("long").alias("total_rows"),
                    F.countDistinct(key).cast("long").alias("distinct_keys"))
    dups = exact_dup_count(df.select(*cols))
    j = attach_row(counts, dups)
    extra = F.col("total_rows") - F.col("distinct_keys")
    return j.select("total_rows", "distinct_keys", extra.alias("extra_key_rows"), "exact_duplicates",
                    F.greatest(extra - F.col("exact_duplicates"), F.lit(0)).alias("non_identical_repeats"))


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with <= 1 distinct value, NULL counted as a value.

    One aggregate, no value shuffle: a column has at most one distinct value exactly
    when it is all-NULL, or has no NULLs and min = max. ``n_values`` is exact for the
    reported (constant) columns."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"{c}__nn"), F.min(x).cast("string").alias(f"{c}__lo"),
                 F.max(x).cast("string").alias(f"{c}__hi")]
    row = df.agg(*aggs)
    structs = ", ".join(
        f"named_struct('column', '{c}', 'nn', `{c}__nn`, 'lo', `{c}__lo`, 'hi', `{c}__hi`, 'n', __n)" for c in cols)
    r = row.select(F.expr(f"inline(array({structs}))"))
    has_null = F.col("n") > F.col("nn")
    n_values = (F.when(F.col("nn") == 0, 0).when(F.col("lo") == F.col("hi"), 1).otherwise(2)
                + F.when(has_null, 1).otherwise(0))
    return r.select("column", n_values.cast("long").alias("n_values")).where(F.col("n_values") <= 1)
