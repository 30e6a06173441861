"""Train-only preprocessing T01-T10: ``fit(train) -> stats``, ``apply(df, stats) -> df``.

Stats are one-row DataFrames (bounded by construction) attached with a broadcast;
the learned values never become driver-side literals, so the same fitted frame
serves train, validation, test and streaming scoring.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions import stats
from ..functions import vocab as V
from . import features as FE
from .cleaning import attach_row, clip, iqr_limits, _limits_row


@dataclass
class FittedStats:
    medians: DataFrame      # one row: <col>__med
    modes: DataFrame        # one row: <col>__mode
    iqr: DataFrame          # one row: <col>__lower/<col>__upper
    features: DataFrame     # one row: dosage_median, ratio_* (see features.feature_stats)
    row: DataFrame          # all of them as one row, which apply() attaches once


def validate_predictors(df: DataFrame, extra_ok=("patient_id",)) -> DataFrame:
    """T05 contract: exactly the 26 base predictors in any order (plus the key)."""
    cols = [c for c in df.columns if c not in extra_ok]
    missing = [c for c in V.PREDICTORS if c not in cols]
    extra = [c for c in cols if c not in V.PREDICTORS]
    if missing:
        raise ValueError(f"input is missing expected predictors: {missing}")
    if extra:
        raise ValueError(f"input contains unexpected predictors: {extra}")
    keep = [c for c in extra_ok if c in df.columns]
    return df.select(*keep, *V.PREDICTORS)


def normalize(df: DataFrame) -> DataFrame:
    """Numeric -> DOUBLE with +-inf/NaN as NULL; categorical placeholders -> NULL."""
    out = []
    for c in df.columns:
        if c in V.NUMERIC_COLUMNS:
            out.append(X.finite_or_null(F.col(c).cast("double")).alias(c))
        elif c in V.CATEGORICAL_COLUMNS:
            out.append(X.placeholder_to_null(F.col(c).cast("string")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _impute(df: DataFrame, med: DataFrame, mode: DataFrame) -> DataFrame:
    j = attach_row(attach_row(df, med), mode)
    sel = []
    for c in df.columns:
        if c in V.NUMERIC_COLUMNS:
            sel.append(F.coalesce(F.col(c), F.col(f"{c}__med")).alias(c))
        elif c in V.CATEGORICAL_COLUMNS:
            sel.append(F.coalesce(F.col(c), F.col(f"{c}__mode")).alias(c))
        else:
            sel.append(F.col(c))
    return j.select(*sel)


def _clip(df: DataFrame, lim_row: DataFrame) -> DataFrame:
    j = attach_row(df, lim_row)
    return j.select(*[clip(c, F.col(f"{c}__lower"), F.col(f"{c}__upper")).alias(c) if c in V.IQR_COLUMNS
                      else F.col(c) for c in df.columns])


def fit_medians(train: DataFrame) -> DataFrame:
    """Exact medians of the 19 numeric predictors; fail if any is undefined."""
    med = stats.quantile_row(train, V.NUMERIC_COLUMNS, [0.5], names={(c, 0.5): f"{c}__med" for c in V.NUMERIC_COLUMNS})
    row = med.first()
    undefined = [c for c in V.NUMERIC_COLUMNS if row[f"{c}__med"] is None]
    if undefined:
        raise ValueError(f"unable to learn training medians for: {undefined}")
    return med


def fit_modes(train: DataFrame) -> DataFrame:
    """Modes of the 7 categorical predictors (ties -> smallest); fail if none."""
    m = stats.mode_row(train, V.CATEGORICAL_COLUMNS)
    row = m.first()
    undefined = [c for c in V.CATEGORICAL_COLUMNS if row[f"{c}__mode"] is None]
    if undefined:
        raise ValueError(f"unable to learn a training mode for: {undefined}")
    return m


def fit(train: DataFrame) -> FittedStats:
    """T01-T04 on the train split only."""
    from ..session import cut_lineage, write_table
    base = write_table(normalize(validate_predictors(train)), "train_base")
    med = fit_medians(base)
    mode = fit_modes(base)
    imputed = write_table(_impute(base, med, mode), "train_imputed")
    lim = iqr_limits(imputed, V.IQR_COLUMNS)              # T03
    lim_row = _limits_row(lim, V.IQR_COLUMNS)
    clipped = _clip(imputed, lim_row)
    fstats = FE.feature_stats(clipped)                    # T04
    # Materialize the four one-row frames once: every later apply() (validation, test,
    # each streaming micro-batch) then reads a tiny file instead of re-deriving them.
    kept = [cut_lineage(x) for x in (med, mode, lim_row, fstats)]
    row = kept[0]
    for x in kept[1:]:
        row = attach_row(row, x)
    return FittedStats(*kept, cut_lineage(row))


def apply(df: DataFrame, st: FittedStats, extra_ok=("patient_id",)) -> DataFrame:
    """Normalize -> impute -> cap -> 7 engineered features (33 predictors + key)."""
    base = normalize(validate_predictors(df, extra_ok))
    j = attach_row(base, st.row)                               # one row for all steps
    kept = [F.col(c) for c in st.row.columns]
    filled = j.select(*[F.coalesce(F.col(c), F.col(f"{c}__med" if c in V.NUMERIC_COLUMNS else f"{c}__mode")).alias(c)
                        if c in V.NUMERIC_COLUMNS or c in V.CATEGORICAL_COLUMNS else F.col(c) for c in base.columns], *kept)
    clipped = filled.select(*[clip(c, F.col(f"{c}__lower"), F.col(f"{c}__upper")).alias(c) if c in V.IQR_COLUMNS else F.col(c)
                              for c in base.columns], *kept)
    return FE.with_features(clipped, base.columns)


def iqr_table(st: FittedStats) -> DataFrame:
    cols = V.IQR_COLUMNS
    structs = ", ".join(f"named_struct('column', '{c}', 'lower', `{c}__lower`, 'upper', `{c}__upper`)" for c in cols)
    return st.iqr.select(F.expr(f"inline(array({structs}))"))


# ------------------------------------------------------------------ encoding
def one_hot_pipeline(cat_cols=V.FEATURE_CATEGORICAL, num_cols=V.FEATURE_NUMERIC) -> Pipeline:
    """T07 + T10: train categories in alphabetical order, unseen -> all zeros (the dropped
    last slot of ``handleInvalid='keep'`` is the unknown bucket), numeric first."""
    idx = StringIndexer(inputCols=cat_cols, outputCols=[f"{c}__idx" for c in cat_cols],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    # The indexer's extra "unknown" index is the encoder's last category; dropLast
    # removes exactly that slot (the encoder itself must not add another one).
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cat_cols], outputCols=[f"{c}__ohe" for c in cat_cols],
                        dropLast=True)
    asm = VectorAssembler(inputCols=list(num_cols) + [f"{c}__ohe" for c in cat_cols], outputCol="features")
    return Pipeline(stages=[idx, ohe, asm])


def feature_names(df_with_features: DataFrame, col: str = "features") -> list[str]:
    """Ordered encoded feature names from the ML attribute metadata (no data pass)."""
    meta = df_with_features.schema[col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    return [a["name"] for a in sorted(attrs, key=lambda a: a["idx"])]


def feature_values(encoded: DataFrame, key: str, names: list[str], col: str = "features") -> DataFrame:
    """T10, long: (key, position, name, value) of every non-zero entry of the assembled vector;
    ``names`` are the encoded names in their order (as many as the model has features)."""
    from pyspark.ml.functions import vector_to_array
    at = encoded.select(key, F.posexplode(vector_to_array(col)).alias("position", "value"))
    return at.where(F.col("value") != 0).select(
        key, "position", F.get(F.array(*[F.lit(n) for n in names]), F.col("position")).alias("name"), "value")


def one_hot_long(encoded: DataFrame, key: str, cat_cols=V.FEATURE_CATEGORICAL, drop_first: bool = False) -> DataFrame:
    """Long form of the one-hot block: (key, feature, category) for every 1 entry.
    ``drop_first`` (T08) removes the alphabetically first train category."""
    entries = []
    for c in cat_cols:
        meta = next(f.metadata for f in encoded.schema.fields if f.name == f"{c}__idx")
        labels = [v for v in meta["ml_attr"]["vals"] if v != "__unknown"]
        i = F.col(f"{c}__idx").cast("int")
        known = (i >= (1 if drop_first else 0)) & (i < len(labels))
        entries.append(F.when(known, F.struct(F.lit(c).alias("feature"),
                                              F.array(*[F.lit(v) for v in labels])[i].alias("category"))))
    return encoded.select(key, F.inline(F.array_compact(F.array(*entries))))


def standard_scale(train: DataFrame, df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """(x - mean) / population std fitted on train; zero std -> divide by 1."""
    st = train.agg(*[F.avg(c).alias(f"{c}__mean") for c in cols], *[F.stddev_pop(c).alias(f"{c}__std") for c in cols])
    j = attach_row(df, st)
    return j.select(key, *[((F.col(c) - F.col(f"{c}__mean")) /
                            F.when(F.col(f"{c}__std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__std"))).alias(c)
                           for c in cols])
