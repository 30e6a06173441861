"""Feature engineering F01-F09: CASE ladders, flags and the capped De Ritis ratio.

Missing values compare false (flags -> 0) and fall to 'Unknown' (ladders). The two
statistics layers (dosage median + ratio median, then ratio quartiles) are computed
with the distributed exact-quantile helper and attached as one-row broadcasts.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stats
from ..functions import vocab as V
from .cleaning import attach_row


def kidney_stage(egfr="egfr") -> Column:
    e = F.col(egfr)
    return (F.when(e >= 90, "Normal").when((e >= 60) & (e < 90), "Mild")
            .when((e >= 30) & (e < 60), "Moderate").when(e < 30, "Severe").otherwise("Unknown"))


def bmi_category(bmi="bmi") -> Column:
    b = F.col(bmi)
    return (F.when(b < 18.5, "Underweight").when((b >= 18.5) & (b < 25), "Normal")
            .when((b >= 25) & (b < 30), "Overweight").when(b >= 30, "Obese").otherwise("Unknown"))


def age_group(age="age") -> Column:
    a = F.col(age)
    return (F.when(a < 18, "Pediatric").when((a >= 18) & (a < 35), "Young Adult")
            .when((a >= 35) & (a < 65), "Middle Aged").when((a >= 65) & (a < 80), "Senior")
            .when(a >= 80, "Elderly").otherwise("Unknown"))


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def liver_risk(alt="alt_enzyme", ast="ast_enzyme") -> Column:
    return (_flag(F.col(alt) > V.LIVER_LIMIT).cast("boolean") | _flag(F.col(ast) > V.LIVER_LIMIT).cast("boolean")).cast("int")


def polypharmacy(c="concurrent_drugs") -> Column:
    return _flag(F.col(c) >= V.POLYPHARMACY_MIN)


def elderly_high_dose(dosage_median: Column, age="age", dosage="dosage_mg") -> Column:
    return _flag((F.col(age) >= V.ELDERLY_AGE) & (F.col(dosage) > dosage_median))


def raw_ratio(alt="alt_enzyme", ast="ast_enzyme") -> Column:
    r = F.when(F.col(alt) > 0, F.col(ast) / F.col(alt))
    return F.when(F.isnan(r) | r.isin(float("inf"), float("-inf")), F.lit(None).cast("double")).otherwise(r)


def feature_stats(df: DataFrame) -> DataFrame:
    """One row: dosage_median, ratio_median, ratio_q1, ratio_q3, ratio_lower, ratio_upper."""
    base = df.select("dosage_mg", raw_ratio().alias("ratio"))
    med = stats.quantile_row(base, ["dosage_mg", "ratio"], [0.5],
                             names={("dosage_mg", 0.5): "dosage_median", ("ratio", 0.5): "ratio_median"})
    filled = attach_row(base.select("ratio"), med.select("ratio_median")).select(
        F.coalesce("ratio", "ratio_median").alias("ratio_filled"))
    q = stats.quantile_row(filled, ["ratio_filled"], [0.25, 0.75],
                           names={("ratio_filled", 0.25): "ratio_q1", ("ratio_filled", 0.75): "ratio_q3"})
    q = q.select("ratio_q1", "ratio_q3",
                 F.greatest(F.lit(0.0), F.col("ratio_q1") - V.IQR_FACTOR * (F.col("ratio_q3") - F.col("ratio_q1")))
                 .alias("ratio_lower"),
                 (F.col("ratio_q3") + V.IQR_FACTOR * (F.col("ratio_q3") - F.col("ratio_q1"))).alias("ratio_upper"))
    return attach_row(med, q)


def apply_features(df: DataFrame, fstats: DataFrame) -> DataFrame:
    """Seven engineered columns from a one-row stats frame (pure projection after a
    broadcast of that single row)."""
    return with_features(attach_row(df, fstats), df.columns)


def with_features(j: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the engineered ones, from rows that carry the statistics already."""
    ratio = F.coalesce(raw_ratio(), F.col("ratio_median"))
    ratio = F.least(F.greatest(ratio, F.col("ratio_lower")), F.col("ratio_upper"))
    return j.select(*[F.col(c) for c in columns],
                    kidney_stage().alias("kidney_stage"), bmi_category().alias("bmi_category"),
                    age_group().alias("age_group"), liver_risk().alias("liver_risk"),
                    polypharmacy().alias("polypharmacy"),
                    elderly_high_dose(F.col("dosage_median")).alias("elderly_high_dose"),
                    ratio.alias("de_ritis_ratio"))


def engineer_full(df: DataFrame) -> DataFrame:
    """31 -> 38 columns, row count unchanged."""
    return apply_features(df, feature_stats(df))


def feature_summary(eng: DataFrame) -> DataFrame:
    """per engineered category value counts, plus each flag's sum (value='1')."""
    cats = stats.long_values(eng, V.ENGINEERED_CATEGORICAL, cast="string")
    counts = cats.groupBy(F.col("column").alias("feature"), "value").agg(F.count(F.lit(1)).alias("n"))
    flags = eng.agg(*[F.sum(c).cast("long").alias(c) for c in ("liver_risk", "polypharmacy", "elderly_high_dose")])
    flag_rows = flags.select(F.expr("stack(3, 'liver_risk', liver_risk, 'polypharmacy', polypharmacy, "
                                    "'elderly_high_dose', elderly_high_dose) AS (feature, n)"))
    return counts.unionByName(flag_rows.select("feature", F.lit("1").alias("value"), "n"))
