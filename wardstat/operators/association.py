"""Association and feature ranking A01-A06.

Contingency tables stay long (a, b, n) — never collected. The rows of a table are grouped to
their distinct combinations once; all feature pairs are grouping sets over these.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .profile import corr_matrix, pearson

NULL_LABEL = "nan"


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency counts in long form (rows with NULL on either side dropped)."""
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
            .agg(F.count(F.lit(1)).cast("long").alias("n")))


def _v_from_cells(cells: DataFrame, group: list[str]) -> DataFrame:
    """Bias-corrected Cramer's V from long cells (group..., a, b, n).
    chi2 = t * (sum n^2 / (r_a * c_b) - 1), identical to the all-cells definition."""
    ra = cells.groupBy(*group, "a").agg(F.sum("n").alias("ra"))
    cb = cells.groupBy(*group, "b").agg(F.sum("n").alias("cb"))
    j = cells.join(ra, group + ["a"]).join(cb, group + ["b"])
    g = j.groupBy(*group).agg(F.sum((F.col("n") / F.col("ra")) * (F.col("n") / F.col("cb"))).alias("s"),
                              F.sum("n").alias("t"), F.countDistinct("a").alias("r"),
                              F.countDistinct("b").alias("k"))
    t, r, k = F.col("t").cast("double"), F.col("r").cast("double"), F.col("k").cast("double")
    chi2 = t * (F.col("s") - 1.0)
    phi2 = chi2 / t
    phi2c = F.when(t > 1, F.greatest(F.lit(0.0), phi2 - (k - 1) * (r - 1) / (t - 1))).otherwise(phi2)
    rc = F.when(t > 1, r - (r - 1) * (r - 1) / (t - 1)).otherwise(r)
    kc = F.when(t > 1, k - (k - 1) * (k - 1) / (t - 1)).otherwise(k)
    denom = F.least(kc - 1, rc - 1)
    v = F.when(denom <= 0, F.lit(0.0)).otherwise(F.sqrt(phi2c / denom))
    return g.select(*group, v.alias("cramers_v"))


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row (col_a, col_b, cramers_v)."""
    cells = crosstab(df, a, b).withColumn("pair", F.lit(f"{a}|{b}"))
    return _v_from_cells(cells, ["pair"]).select(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), "cramers_v")


def pair_cells(df: DataFrame, cols: list[str], pairs: list[tuple[str, str]], null_as_text: bool = True) -> DataFrame:
    """(col_a, col_b, a, b, n) of the given column pairs. Rows are first grouped to their distinct
    combinations of all columns; the pairs are grouping sets over these."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_LABEL)) if null_as_text else F.col(c).cast("string") for c in cols]
    ids = [f"g{i}" for i in range(len(cols))]
    combos = df.select(*[t.alias(i) for t, i in zip(text, ids)]).groupBy(*ids).agg(F.count(F.lit(1)).alias("m"))
    at = {c: i for i, c in enumerate(cols)}
    sets = combos.groupingSets([[ids[at[x]], ids[at[y]]] for x, y in pairs], *ids).agg(
        F.sum("m").cast("long").alias("n"), F.grouping_id().alias("gid"))
    # grouping_id: a bit for every column that is not in the set, the first column's is the highest
    every = (1 << len(cols)) - 1
    out = F.array(*[F.when(F.col("gid") == every - (1 << (len(cols) - 1 - at[x])) - (1 << (len(cols) - 1 - at[y])), F.struct(
        F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(ids[at[x]]).alias("a"), F.col(ids[at[y]]).alias("b"))) for x, y in pairs])
    cells = sets.select("n", F.array_compact(out)[0].alias("c")).select("c.*", "n")
    return cells.where(F.col("a").isNotNull() & F.col("b").isNotNull())


def association_matrix(df: DataFrame, cols: list[str], null_as_text: bool = True) -> DataFrame:
    """V for all pairs (upper triangle computed once, mirrored), diagonal 1.0."""
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i + 1:]]
    upper = _v_from_cells(pair_cells(df, cols, pairs, null_as_text), ["col_a", "col_b"])
    lower = upper.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "cramers_v")
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, cramers_v double")
    return upper.unionByName(lower).unionByName(diag)


def _ranked(df: DataFrame, score: str) -> DataFrame:
    """Adds ``rank`` (1 = strongest, undefined scores last, ties by name); one row per feature."""
    order = Window.orderBy(F.col(score).desc_nulls_last(), "feature")
    return df.withColumn("rank", F.row_number().over(order)).orderBy("rank")


def rank_numeric(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Features by |Pearson r| with the target, descending."""
    r = df.agg(*[pearson(c, target).alias(c) for c in features])
    structs = ", ".join(f"named_struct('feature', '{c}', 'r', `{c}`)" for c in features)
    return _ranked(r.select(F.expr(f"inline(array({structs}))")).select("feature", "r", F.abs("r").alias("abs_r")), "abs_r")


def rank_categorical(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Features by Cramer's V with the target, descending; only the target's pairs are counted."""
    cells = pair_cells(df, [target, *features], [(target, f) for f in features])
    return _ranked(_v_from_cells(cells, ["col_a", "col_b"]).select(F.col("col_b").alias("feature"), "cramers_v"), "cramers_v")


def high_corr_pairs(df: DataFrame, cols: list[str], threshold: float = 0.9) -> DataFrame:
    """Pairs i<j with |r| > threshold."""
    order = {c: i for i, c in enumerate(cols)}
    m = corr_matrix(df, cols)
    idx = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    return m.where((idx[F.col("col_a")] < idx[F.col("col_b")]) & (F.abs("r") > threshold))
