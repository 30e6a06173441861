"""Analytics catalog and log reports on small tables: band bounds, unknowns, ties, empty input."""
import datetime as dt

import pytest

from wardstat.operators import analytics as AN
from wardstat.session import shared_path
from wardstat.streaming import service as SV

SCHEMA = ("patient_id long, age double, gender string, drug_name string, dosage_mg double, concurrent_drugs double, "
          "creatinine double, bmi double, treatment_outcome int, adverse_event int, readmission_30d int")


def patient(i, age=40.0, drug="A", dose=100.0, drugs=1.0, creatinine=1.0, y=1, adverse=0):
    return (i, age, "F", drug, dose, drugs, creatinine, 22.0, y, adverse, 0)


@pytest.fixture(scope="module")
def people(spark):
    rows = [patient(1, age=29.9, dose=99.9), patient(2, age=30.0, y=0), patient(3, age=50.0, dose=500.0),
            patient(4, age=50.1, dose=500.1, y=None), patient(5, age=65.0, drug=" "), patient(6, age=65.1, drug=None),
            patient(7, age=None, dose=None, y=None, adverse=None), patient(8, age=70.0, creatinine=1.6, drugs=5.0),
            patient(9, age=70.0, creatinine=1.5, drugs=9.0), patient(10, age=90.0, creatinine=1.6, drugs=5.0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_bands_follow_their_bounds(people):
    got = [tuple(r) for r in AN.effectiveness_by_age(people).collect()]
    assert got == [("Under 30", 1, 1, 0, 100.0), ("30-50", 2, 2, 0, 50.0), (">50-65", 2, 1, 1, 100.0),
                   ("Over 65", 4, 4, 0, 100.0), ("Unknown", 1, 0, 1, None)]
    assert [(r[0], r[1]) for r in AN.rates_by_dosage(people).collect()] == [
        ("Low (<100mg)", 1), ("Medium (100-500mg)", 7), ("High (>500mg)", 1), ("Unknown", 1)]
    assert [tuple(r) for r in AN.outcome_distribution(people).collect()] == [
        ("Ineffective (0)", 1, 1, 0, 10.0), ("Effective (1)", 7, 7, 0, 70.0), ("Unknown", 2, 0, 2, 20.0)]


def test_ranked_reports(people):
    assert [r["patient_id"] for r in AN.high_risk_patients(people).collect()] == [8, 10]
    assert [r["drug_group"] for r in AN.top_drugs(people, min_records=1).collect()] == ["A"]
    assert AN.top_drugs(people).count() == 0
    by_age = {(r["drug_group"], r["age_category"]): r["total_records"] for r in AN.adverse_by_drug_age(people).collect()}
    assert by_age == {("A", "Non-Elderly"): 4, ("A", "Elderly"): 3, ("A", "Unknown"): 1,
                      ("Unknown Drug", "Non-Elderly"): 1, ("Unknown Drug", "Elderly"): 1}


def test_suite_writes_each_report(spark, people):
    for table, n in ((people, [3, 5, 0, 5, 2, 4]), (people.where("false"), [0] * 6)):
        path = shared_path(spark, "suite")
        got = AN.query_suite(spark, table, path).orderBy("position").collect()
        assert [r["n_rows"] for r in got] == n
        assert spark.read.option("header", True).csv(f"{path}/q1").count() == n[0]


def test_log_reports(spark, people):
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([(i, 1 + i % 3, "m", "1", 0.5, 0.5, 1, "Effective", t) for i in range(1, 8)] +
                                [(8, 999, "m", "1", 0.5, 0.5, 1, "Effective", t)],
                                "prediction_id long, patient_id long, model_name string, model_version string, "
                                "probability_effective double, cutoff double, predicted_class int, "
                                "predicted_outcome string, predicted_at timestamp")
    assert [r["prediction_id"] for r in AN.latest_predictions(log, top=3).collect()] == [8, 7, 6]
    assert [r["prediction_id"] for r in AN.prediction_context(log, people, top=2).collect()] == [7, 6]
    assert [r["prediction_id"] for r in AN.prediction_history(log, people, 2).collect()] == [7, 4, 1]


def test_unreadable_id_ledger_is_an_error(spark):
    missing = shared_path(spark, "no-ledger")
    assert SV._previous_max(spark, missing, 0) == 0
    with pytest.raises(Exception):
        SV._previous_max(spark, missing, 3)
