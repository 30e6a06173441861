"""The analytics catalog (Q01-Q06, S11) and the prediction-log reports.

Grouped reports are one hash aggregate each: values fall into numbered bands (the number is
the group key and the sort key, its label is looked up afterwards), and ``tally`` counts the
known, missing and positive rows of each 0/1 measure. Ranked reports are top-k sorts.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Labels, bounds (label, upper bound, whether it belongs to the band), limits.
OUTCOME_LABELS = ["Ineffective (0)", "Effective (1)", "Unknown"]
AGE_BANDS = [("Under 30", 30, False), ("30-50", 50, True), (">50-65", 65, True), ("Over 65", None, True)]
DOSAGE_BANDS = [("Low (<100mg)", 100, False), ("Medium (100-500mg)", 500, True), ("High (>500mg)", None, True)]
UNKNOWN, UNKNOWN_DRUG = "Unknown", "Unknown Drug"
ELDERLY_ABOVE, CREATININE_ABOVE, DRUGS_FROM = 65, 1.5, 5
MIN_DRUG_RECORDS, TOP_DRUGS, TOP_DRUG_AGES, TOP_PATIENTS = 100, 10, 15, 20
LATEST, CONTEXT = 100, 200

# measure -> (0/1 column, name of its positive rows)
MEASURES = {"outcome": ("treatment_outcome", "effective"), "adverse": ("adverse_event", "adverse")}


def band_number(value: Column, bands: list[tuple]) -> Column:
    """Position of the first band that takes the value; NULL comes after all bands."""
    inside = [F.lit(True) if top is None else (value <= top if closed else value < top) for _, top, closed in bands]
    hits = [F.when(value.isNotNull() & c, F.lit(i)) for i, c in enumerate(inside)]
    return F.coalesce(*hits, F.lit(len(bands)))


def band_label(number: str, labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), F.col(number) + 1)


def tally(df: DataFrame, keys: dict[str, Column], measures: list[str]) -> DataFrame:
    """Keys, total_records and for each measure its known, missing and observed counts and rate."""
    aggs = [F.count(F.lit(1)).alias("total_records")]
    for m in measures:
        col, hit = MEASURES[m]
        aggs += [F.count(col).alias(f"known_{m}_count"), F.count_if(F.col(col) == 1).alias(f"observed_{hit}_count")]
    out = df.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(*aggs)
    for m in measures:
        known, hits = F.col(f"known_{m}_count"), F.col(f"observed_{MEASURES[m][1]}_count")
        out = out.withColumn(f"missing_{m}_count", F.col("total_records") - known) \
                 .withColumn(f"observed_{MEASURES[m][1]}_rate_pct", percent(hits, known))
    return out


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, 2))


def drug_group() -> Column:
    name = F.trim("drug_name")
    return F.when(F.length(name) > 0, name).otherwise(F.lit(UNKNOWN_DRUG))


def banded_report(df: DataFrame, name: str, value: str, bands: list[tuple], measures: list[str],
                  columns: list[str]) -> DataFrame:
    """One row per band in band order, the unknown band last."""
    out = tally(df, {"band": band_number(F.col(value), bands)}, measures)
    labels = [b[0] for b in bands] + [UNKNOWN]
    return out.orderBy("band").select(band_label("band", labels).alias(name), "total_records", *columns)


def outcome_distribution(patients: DataFrame) -> DataFrame:
    """Q01."""
    y = F.col("treatment_outcome")
    number = F.when(y.isin(0, 1), y.cast("int")).otherwise(F.lit(2))
    groups = tally(patients, {"band": number}, ["outcome"])
    everything = F.sum("total_records").over(Window.partitionBy())          # over three rows at most
    return (groups.withColumn("pct_of_all_records", percent(F.col("total_records"), everything)).orderBy("band")
            .select(band_label("band", OUTCOME_LABELS).alias("treatment_outcome_group"), "total_records",
                    "known_outcome_count", "missing_outcome_count", "pct_of_all_records"))


def effectiveness_by_age(patients: DataFrame) -> DataFrame:
    """Q02."""
    return banded_report(patients, "age_group", "age", AGE_BANDS, ["outcome"],
                         ["known_outcome_count", "missing_outcome_count", "observed_effective_rate_pct"])


def rates_by_dosage(patients: DataFrame) -> DataFrame:
    """Q06."""
    return banded_report(patients, "dosage_category", "dosage_mg", DOSAGE_BANDS, ["outcome", "adverse"],
                         ["known_outcome_count", "missing_outcome_count", "known_adverse_count",
                          "missing_adverse_count", "observed_effective_rate_pct", "observed_adverse_rate_pct"])


def ranked(df: DataFrame, rate: str, names: list[str], top: int) -> DataFrame:
    """The ``top`` groups by rate (unknown rates last), size and name."""
    return df.orderBy(F.col(rate).desc_nulls_last(), F.col("total_records").desc(), *names).limit(top)


def top_drugs(patients: DataFrame, min_records: int = MIN_DRUG_RECORDS, top: int = TOP_DRUGS) -> DataFrame:
    """Q03: drugs with enough records by observed effectiveness."""
    groups = tally(patients, {"drug_group": drug_group()}, ["outcome"]).where(
        (F.col("drug_group") != UNKNOWN_DRUG) & (F.col("total_records") >= min_records))
    return ranked(groups, "observed_effective_rate_pct", ["drug_group"], top).select(
        "drug_group", "total_records", "known_outcome_count", "missing_outcome_count", "observed_effective_count",
        "observed_effective_rate_pct")


def adverse_by_drug_age(patients: DataFrame, top: int = TOP_DRUG_AGES) -> DataFrame:
    """Q04."""
    elderly = F.col("age") > ELDERLY_ABOVE
    category = F.coalesce(F.when(elderly, "Elderly"), F.when(~elderly, "Non-Elderly"), F.lit(UNKNOWN))
    groups = tally(patients, {"drug_group": drug_group(), "age_category": category}, ["adverse"])
    return ranked(groups, "observed_adverse_rate_pct", ["drug_group", "age_category"], top).select(
        "drug_group", "age_category", "total_records", "known_adverse_count", "missing_adverse_count",
        "observed_adverse_count", "observed_adverse_rate_pct")


def high_risk_patients(patients: DataFrame, top: int = TOP_PATIENTS) -> DataFrame:
    """Q05."""
    risky = patients.where((F.col("age") > ELDERLY_ABOVE) & (F.col("creatinine") > CREATININE_ABOVE)
                           & (F.col("concurrent_drugs") >= DRUGS_FROM))
    return risky.orderBy(F.desc("creatinine"), "patient_id").limit(top).select(
        "patient_id", "age", "bmi", "creatinine", "concurrent_drugs", "treatment_outcome", "adverse_event")


# Query ids and titles of the catalog.
CATALOG = [
    ("Q1", "Treatment outcome distribution", outcome_distribution),
    ("Q2", "Treatment effectiveness by age group", effectiveness_by_age),
    ("Q3", "Top 10 drugs by observed treatment effectiveness (min 100 records)", top_drugs),
    ("Q4", "Adverse-event rates by drug and age category (top 15)", adverse_by_drug_age),
    ("Q5", "High-risk patients (age > 65, creatinine > 1.5, concurrent_drugs >= 5)", high_risk_patients),
    ("Q6", "Treatment and adverse-event rates by dosage category", rates_by_dosage),
]


def query_suite(spark: SparkSession, patients: DataFrame, export_dir: str) -> DataFrame:
    """Run the catalog in order, write each report (20 rows at most) as one CSV file with a
    header to ``export_dir``/<id>, and return (query_id, title, position, n_rows as written)."""
    out = None
    for position, (qid, title, report) in enumerate(CATALOG, start=1):
        path = f"{export_dir.rstrip('/')}/{qid.lower()}"
        report(patients).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        part = spark.read.option("header", True).csv(path).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(qid).alias("query_id"), F.lit(title).alias("title"), F.lit(position).alias("position"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ prediction log
_LOGGED = ["model_name", "model_version", "probability_effective", "cutoff", "predicted_class", "predicted_outcome"]


def newest_first(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("predicted_at"), F.desc("prediction_id"))


def latest_predictions(log: DataFrame, top: int = LATEST) -> DataFrame:
    """J15."""
    return newest_first(log).limit(top).select("prediction_id", "patient_id", *_LOGGED, "predicted_at")


def with_observed(log: DataFrame, patients: DataFrame, *columns: str) -> DataFrame:
    """Logged predictions with the wanted columns of their patient and what was observed."""
    seen = patients.select("patient_id", *columns, F.col("treatment_outcome").alias("observed_treatment_outcome"),
                           F.col("adverse_event").alias("observed_adverse_event"),
                           F.col("readmission_30d").alias("observed_readmission_30d"))
    return log.join(seen, "patient_id")


def prediction_context(log: DataFrame, patients: DataFrame, top: int = CONTEXT) -> DataFrame:
    """J13."""
    about = ["age", "gender", "drug_name", "dosage_mg", "concurrent_drugs", "creatinine"]
    return newest_first(with_observed(log, patients, *about)).limit(top).select(
        "prediction_id", "predicted_at", "patient_id", *about, "observed_treatment_outcome", "observed_adverse_event",
        *_LOGGED)


def prediction_history(log: DataFrame, patients: DataFrame, patient_id: int) -> DataFrame:
    """All predictions of one patient."""
    one = F.col("patient_id") == patient_id
    return newest_first(with_observed(log.where(one), patients.where(one))).select(
        "prediction_id", "predicted_at", "patient_id", *_LOGGED, "observed_treatment_outcome",
        "observed_adverse_event", "observed_readmission_30d")
