"""Driver contract smoke test and DuckDB oracle agreement on the smallest tables."""
import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["age_group", "total_records", "known_outcome_count", "missing_outcome_count",
                          "observed_effective_rate_pct"]
    assert len(rows) >= 1


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("key", ["clean_deterministic", "top_drugs", "stratified_split_3", "roc_auc",
                                 "null_profile", "prediction_log", "cramers_v", "apply_stats"])
def test_oracle_agreement(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[key](spark, SF)
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    srows = df.select(*sorted(dcols)).collect()
    idx = [dcols.index(c) for c in sorted(dcols)]
    a = sorted(repr(tuple(_norm(v) for v in r)) for r in srows)
    b = sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in drows)
    assert a == b


def test_csv_ingest_of_a_growing_table(spark):
    test_oracle_agreement(spark, "csv_ingest_orders")
    small, large = (E.queries()["csv_ingest_orders"](spark, f"/root/testdata/{sf}").count() for sf in ("sf0.001", "sf0.01"))
    assert large > small > 1000
