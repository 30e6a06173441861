"""Edge cases of the cleaning / feature expressions (FIXTURES.md §4)."""
import datetime as dt
import math

from pyspark.sql import functions as F

from wardstat.functions import exprs as X
from wardstat.operators import features as FE


def _one(spark, values, fn, typ="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


def test_ladders_never_put_nan_inf_null_in_top_band(spark):
    vals = [float("nan"), float("inf"), float("-inf"), None, 90.0, 89.9, 60.0, 30.0, 29.99]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, egfr double")
    clean = df.select("i", X.finite_or_null("egfr").alias("egfr"))
    got = [r[0] for r in clean.orderBy("i").select(FE.kidney_stage()).collect()]
    assert got == ["Unknown"] * 4 + ["Normal", "Mild", "Mild", "Moderate", "Severe"]


def test_band_borders(spark):
    df = spark.createDataFrame([(18.5, 18.0, 4.0), (25.0, 35.0, 8.0), (30.0, 65.0, 8.01), (24.99, 80.0, 3.99)],
                               "bmi double, age double, h double")
    rows = df.select(FE.bmi_category(), FE.age_group(), X.feet_to_cm("h")).collect()
    assert [r[0] for r in rows] == ["Normal", "Overweight", "Obese", "Normal"]
    assert [r[1] for r in rows] == ["Young Adult", "Middle Aged", "Senior", "Elderly"]
    assert [round(r[2], 4) for r in rows] == [121.92, 243.84, 8.01, 3.99]


def test_flags_treat_missing_as_false(spark):
    df = spark.createDataFrame([(None, None, None), (41.0, None, 5.0), (None, 40.0, 4.0)],
                               "alt_enzyme double, ast_enzyme double, concurrent_drugs double")
    rows = df.select(FE.liver_risk(), FE.polypharmacy()).collect()
    assert [tuple(r) for r in rows] == [(0, 0), (1, 1), (0, 0)]


def test_placeholders_and_dictionaries(spark):
    vals = [" N/A ", "--", "", "unknown", "<MISSING>", "Male", " F ", "MAL", "xyz", None]
    got = _one(spark, vals, lambda c: X.canonical_gender(X.placeholder_to_null(c)), "string")
    assert got == [None] * 5 + ["male", "female", "male", "xyz", None]


def test_dosage_extraction(spark):
    vals = ["100 mg", "50mg", "2x50mg", "500", "0.5 mg daily", "1,000 mg", "as needed", "80 mcg", " 25 ", "12.5MG"]
    got = _one(spark, vals, X.extract_dosage, "string")
    assert got == [100.0, 50.0, 50.0, 500.0, 0.5, 0.0, None, None, 25.0, 12.5]


def test_numeric_coercion_rejects_nan_inf_and_suffixes(spark):
    got = _one(spark, ["12", "12d", "NaN", "inf", "-3.5", "1e2", None], X.to_number, "string")
    assert got == [12.0, None, None, None, -3.5, 100.0, None]


def test_duration_labels_are_case_sensitive(spark):
    got = _one(spark, ["ongoing", "Chronic", "lifetime", "30"], X.duration_days, "string")
    assert got == [365.0, None, 365.0, 30.0]


def test_binary_mappings(spark):
    vals = ["0", "no", "Yes", "Effective", "ineffective", "1.0", "2", "?", None]
    assert _one(spark, vals, X.binary_from_text, "string") == [0, 0, 1, 1, 0, None, None, None, None]
    assert _one(spark, vals, X.binary_from_any, "string") == [0, 0, 1, 1, 0, 1, None, None, None]
    assert _one(spark, [0.0, 1.0, 3.0, None], X.keep_zero_one) == [0, 1, None, None]


def test_mixed_dates(spark):
    vals = ["2020-02-23", "2022/06/10", "October 22, 2021", "12/08/2023", "not a date", None]
    got = _one(spark, vals, X.parse_mixed_date, "string")
    assert got == [dt.date(2020, 2, 23), dt.date(2022, 6, 10), dt.date(2021, 10, 22), dt.date(2023, 12, 8), None, None]


def test_bmi_recompute_bounded_and_unbounded(spark):
    df = spark.createDataFrame([(None, 70.0, 170.0), (None, 299.0, 50.0), (22.0, 70.0, 170.0), (None, 70.0, None)],
                               "bmi double, weight_kg double, height_cm double")
    unb = [r[0] for r in df.select(X.recompute_bmi("bmi", "weight_kg", "height_cm", False)).collect()]
    bnd = [r[0] for r in df.select(X.recompute_bmi("bmi", "weight_kg", "height_cm", True)).collect()]
    assert round(unb[0], 6) == round(70 / 1.7 ** 2, 6) and unb[1] > 100 and unb[2] == 22.0 and unb[3] is None
    assert round(bnd[0], 6) == round(70 / 1.7 ** 2, 6) and bnd[1] is None and bnd[2] == 22.0


def test_snake_case(spark):
    got = _one(spark, ["  Hello World-2 ", "a__b  c"], X.snake_case, "string")
    assert got == ["hello_world2", "a_b_c"]


def test_strip_takes_tabs_and_newlines(spark):
    from wardstat.functions import exprs as X
    df = spark.createDataFrame([("\tMale\n", "N/A\t", "\n yes ")], "g string, p string, b string")
    r = df.select(X.canonical_gender("g").alias("g"), X.placeholder_to_null("p").alias("p"),
                  X.binary_from_any("b").alias("b")).first()
    assert (r["g"], r["p"], r["b"]) == (X.V.GENDER_MAP["male"], None, 1)
