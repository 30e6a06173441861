"""Filters, stratified splits and joins.

Stratified split: each class c of N labelled rows gets an exact quota
(test = ceil(f*N); per class floor(test*n_c/N) plus one for the classes with the
largest remainders), and takes its first ``quota`` rows in md5(seed|stage|key) order.

Scale plan (no window over a whole class): rows are bucketed by the first L hex
digits of that md5 (16^L ~ sqrt(N) buckets). Bucket counts are a small aggregate;
cumulative counts over buckets give, per class, the buckets that lie wholly inside
the quota, and at most one boundary bucket, whose rows alone are ranked. The result
is row-for-row the same as ``row_number() OVER (PARTITION BY label ORDER BY md5)``.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..functions.ordering import global_prefix
from ..session import write_table
from .cleaning import attach_row
from .validate import _checks as checks


def labelled_filter(df: DataFrame, target: str = V.TARGET) -> tuple[DataFrame, DataFrame]:
    """Rows with a known target, plus a (kept, removed) report row."""
    kept = df.where(F.col(target).isNotNull())
    report = df.agg(F.sum(F.when(F.col(target).isNotNull(), 1).otherwise(0)).cast("long").alias("kept"),
                    F.sum(F.when(F.col(target).isNull(), 1).otherwise(0)).cast("long").alias("removed"))
    return kept, report


def leakage_projection(df: DataFrame, drop=V.LEAKAGE_COLUMNS) -> DataFrame:
    """Drop id, target, date and post-outcome columns; assert they are gone."""
    out = df.drop(*[c for c in drop if c in df.columns])
    left = [c for c in drop if c in out.columns]
    if left:
        raise ValueError(f"leakage columns still present: {left}")
    return out


def split_hash(key_col: str, seed: int, stage: str):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(stage), F.col(key_col).cast("string")))


def class_quotas(counts: dict, fraction: float) -> dict:
    """Exact per-class quotas from per-class counts (a handful of numbers)."""
    n = sum(counts.values())
    total = math.ceil(fraction * n) if n else 0
    rows = []
    for lab, c in counts.items():
        share = total * c / n if n else 0.0
        rows.append([lab, c, int(math.floor(share)), share - math.floor(share)])
    extra = total - sum(r[2] for r in rows)
    for i, r in enumerate(sorted(rows, key=lambda r: (-r[3], str(r[0])))):
        if i < extra:
            r[2] += 1
    return {r[0]: r[2] for r in rows}


def stratified_select(df: DataFrame, key: str, label: str, fraction: float, seed: int, stage: str) -> DataFrame:
    """Adds boolean ``selected``: exactly the class quotas, first in hash order."""
    spark = df.sparkSession
    # hashed once; counts, buckets and both arms below read the stored slim rows
    df_columns, hashed = df.columns, write_table(df.withColumn("__h", split_hash(key, seed, stage)), "split_hash")
    counts = {r[0]: r[1] for r in hashed.groupBy(label).count().collect()}   # one row per class
    quotas = class_quotas(counts, fraction)
    n = max(sum(counts.values()), 1)
    digits = int(max(1, round(math.log(math.sqrt(n), 16))))      # 16^L ~ sqrt(N) buckets
    tagged = hashed.withColumn("__b", F.substring("__h", 1, digits))
    qdf = spark.createDataFrame([(k, int(v)) for k, v in quotas.items()],
                                f"__label {df.schema[label].dataType.simpleString()}, __quota long")
    buckets = tagged.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    # the bucket in which a class reaches its quota, and the rows to take there: buckets are in
    # hash order, so one row per class says everything, and the broadcast stays that small
    edges = (buckets.withColumn("__cum", F.sum("__n").over(w))
             .join(F.broadcast(qdf), F.col(label).eqNullSafe(F.col("__label")))
             .where(F.col("__cum") >= F.col("__quota"))
             .groupBy("__label", "__quota").agg(F.min_by(F.struct("__b", (F.col("__cum") - F.col("__n")).alias("__before")),
                                                         "__b").alias("__edge"))
             .select("__label", F.col("__edge.__b").alias("__bb"),
                     (F.col("__quota") - F.col("__edge.__before")).alias("__take")))
    j = tagged.join(F.broadcast(edges), F.col(label).eqNullSafe(F.col("__label")))
    plain = j.where(F.col("__b") != F.col("__bb")).withColumn("selected", F.col("__b") < F.col("__bb"))
    wb = Window.partitionBy(label).orderBy("__h")
    edge = (j.where(F.col("__b") == F.col("__bb"))
            .withColumn("selected", F.row_number().over(wb) <= F.col("__take")))
    cols = df_columns + ["selected"]
    return plain.select(*cols).unionByName(edge.select(*cols))


def stratified_split_2(df: DataFrame, key: str, label: str, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """(key, label, split in {train, test})."""
    s = stratified_select(df.select(key, label), key, label, test_fraction, seed, "test")
    return s.select(key, label, F.when(F.col("selected"), "test").otherwise("train").alias("split"))


def stratified_split_3(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """20 % test, then 25 % of the rest as validation (60/20/20)."""
    s1 = write_table(stratified_select(df.select(key, label), key, label, 0.2, seed, "test"), "split_stage")
    test = s1.where("selected").select(key, label, F.lit("test").alias("split"))
    rest = s1.where(~F.col("selected")).select(key, label)
    s2 = stratified_select(rest, key, label, 0.25, seed, "validation")
    return test.unionByName(s2.select(key, label, F.when(F.col("selected"), "validation")
                                      .otherwise("train").alias("split")))


def stratified_split_3b(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """40 % holdout, then the holdout halved into validation / test."""
    s1 = write_table(stratified_select(df.select(key, label), key, label, 0.4, seed, "holdout"), "split_stage")
    train = s1.where(~F.col("selected")).select(key, label, F.lit("train").alias("split"))
    hold = s1.where("selected").select(key, label)
    s2 = stratified_select(hold, key, label, 0.5, seed, "halve")
    return train.unionByName(s2.select(key, label, F.when(F.col("selected"), "test")
                                       .otherwise("validation").alias("split")))


def split_assignments(train: DataFrame, validation: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Union of key lists with a split label."""
    return (train.select(key, F.lit("train").alias("split"))
            .unionByName(validation.select(key, F.lit("validation").alias("split")))
            .unionByName(test.select(key, F.lit("test").alias("split"))))


def assert_unique(df: DataFrame, key, what: str) -> None:
    """One-to-one precondition (Catalyst has no join-cardinality validation)."""
    dup = df.groupBy(*([key] if isinstance(key, str) else key)).count().where("count > 1").limit(1).count()
    if dup:
        raise ValueError(f"{what}: duplicate keys in {key}")


def with_assignment_order(assign: DataFrame, order: list[str]) -> DataFrame:
    """Numbers the assignments (0-based) in the order of ``order``, by distributed prefix sums."""
    return global_prefix(assign, order, index_col="assignment_order")


def join_one_to_one(assign: DataFrame, base: DataFrame, key: str, target: str = V.TARGET) -> DataFrame:
    """Assignments JOIN base on key; fail on duplicates either side; keep labelled rows. The
    equi-join is left to AQE (broadcast if small at runtime, else sort-merge). Numbered assignments
    (``assignment_order``) come back in their order, by a distributed sort."""
    assert_unique(assign, key, "assignments")
    assert_unique(base, key, "base")
    out = assign.join(base, key).where(F.col(target).isNotNull())
    return out.orderBy("assignment_order") if "assignment_order" in assign.columns else out


def join_left_check(reference: DataFrame, new: DataFrame, key: str, col: str) -> DataFrame:
    """Labelled reference LEFT JOIN new targets; count unmatched and disagreeing."""
    ref = reference.where(F.col(col).isNotNull()).select(key, F.col(col).alias("ref"))
    j = ref.join(new.select(key, F.col(col).alias("new"), F.lit(1).alias("__m")), key, "left")
    return j.agg(F.count(F.lit(1)).cast("long").alias("reference_rows"),
                 F.sum(F.when(F.col("__m").isNull(), 1).otherwise(0)).cast("long").alias("missing_in_new"),
                 F.sum(F.when(F.col("__m").isNotNull() & ~F.col("ref").eqNullSafe(F.col("new")), 1).otherwise(0))
                 .cast("long").alias("target_mismatches"))


def join_scores(truth: DataFrame, scores: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Truth JOIN each score table on (key, target), renaming score columns; full coverage required."""
    assert_unique(truth, keys, "truth")
    out = truth
    for name, s in scores.items():
        assert_unique(s, keys, name)
        if truth.join(s, keys, "left_anti").limit(1).count() or s.join(truth, keys, "left_anti").limit(1).count():
            raise ValueError(f"{name}: scores and truth do not cover the same keys")
        out = out.join(s.withColumnRenamed("prob", f"{name}_probability"), keys)
    return out


def split_summary(assign: DataFrame, label: str) -> DataFrame:
    """Per split rows, #0, #1 and their percentages."""
    g = assign.groupBy("split").agg(F.count(F.lit(1)).cast("long").alias("rows"),
                                    F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("long").alias("n_zero"),
                                    F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("n_one"))
    return g.select("split", "rows", "n_zero", "n_one",
                    F.round(100.0 * F.col("n_zero") / F.col("rows"), 6).alias("pct_zero"),
                    F.round(100.0 * F.col("n_one") / F.col("rows"), 6).alias("pct_one"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class attached to every row."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    tot = per.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k"))
    w = attach_row(per, tot).select(label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias("weight"))
    # one row per class: bounded broadcast
    return df.join(F.broadcast(w), label)


SPLITS = {"train": 1, "validation": 2, "test": 4}                  # bit of each split


def split_integrity(assign: DataFrame, labelled: DataFrame, key: str, test: float = 0.2, validation: float = 0.25) -> DataFrame:
    """No key in two splits, every labelled key exactly once, labels valid, and each split as
    large as its fraction of the labelled keys asks (test rounded up, then validation of the rest).

    Each side is aggregated once by key (the splits of a key are the bits of one number) and the
    two meet in one full outer join on the same partitioning; one row of sums makes all checks."""
    bit = F.lit(0)
    for name, b in SPLITS.items():
        bit = F.when(F.col("split") == name, b).otherwise(bit)
    a = assign.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.bit_or(bit).alias("bits"), F.count_if(F.coalesce(bit, F.lit(0)) == 0).alias("bad"),
                                *[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in SPLITS])
    lab = labelled.groupBy(key).agg(F.lit(True).alias("known"))
    j = a.join(lab, key, "full")

    def both(x, y):
        return F.count_if(F.col("bits").bitwiseAND(SPLITS[x] | SPLITS[y]) == (SPLITS[x] | SPLITS[y]))
    pairs = [("train", "validation"), ("train", "test"), ("validation", "test")]
    row = j.agg(*[both(x, y).alias(f"overlap_{x}_{y}") for x, y in pairs],
                F.count_if(F.col("n") > 1).alias("keys_assigned_more_than_once"),
                F.count_if(F.col("n").isNull()).alias("labelled_keys_missing"),
                F.count_if(F.col("known").isNull()).alias("assigned_keys_not_labelled"),
                F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_split_labels"),
                *[F.coalesce(F.sum(f"n_{s}"), F.lit(0)).alias(f"rows_{s}") for s in SPLITS], F.count("known").alias("labelled"))
    row = row.withColumn("exp_test", F.ceil(F.col("labelled") * F.lit(test)))
    row = row.withColumn("exp_validation", F.ceil((F.col("labelled") - F.col("exp_test")) * F.lit(validation)))
    row = row.withColumn("exp_train", F.col("labelled") - F.col("exp_test") - F.col("exp_validation"))
    zero = [f"overlap_{x}_{y}" for x, y in pairs] + ["keys_assigned_more_than_once", "labelled_keys_missing",
                                                     "assigned_keys_not_labelled", "invalid_split_labels"]
    return checks(row, [(c, c, 0) for c in zero] + [(f"rows_{s}", f"rows_{s}", f"exp_{s}") for s in SPLITS])


def point_lookup(patients: DataFrame, patient_id: int, cols=V.PREDICTORS) -> DataFrame:
    """Predictor columns of one patient (filter pushed into the parquet scan;
    row-group min/max statistics skip the rest when the table is written sorted by key)."""
    return patients.where(F.col("patient_id") == int(patient_id)).select("patient_id", *cols)
