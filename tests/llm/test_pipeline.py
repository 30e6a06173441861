"""The corpus pipeline, stage by stage, on documents with nulls, copies and a clashing column."""
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline as P
from wardstat.llm import simhash, toxicity
from wardstat.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    first = base.orderBy("doc_id").limit(3)
    copies = first.withColumn("doc_id", F.col("doc_id") + 1_000_000)
    edge = spark.createDataFrame([(None, None, "en", None, 0), (2_000_000, "", None, "s", 0), (2_000_001, None, "en", "s", 0)],
                                 base.schema)
    docs = stored(base.unionByName(copies).unionByName(first).unionByName(edge).withColumn("slots", F.lit("x")), "test-docs")

    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "mixing", "packing"]
    stage = dict(P.STAGES)
    kept = stored(stage["toxicity"](spark, docs, SF), "test-kept")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"))
    bad = {r["doc_id"] for r in toxicity.score(docs, model).where(F.col("score") >= toxicity.THRESHOLD).collect()}
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.select("doc_id").collect()) == \
        Counter(r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] not in bad)

    one = stored(stage["near_duplicates"](spark, kept, SF), "test-one")
    assert one.columns == docs.columns
    groups = defaultdict(set)
    for r in simhash.label_documents(kept).collect():
        groups[r["component_id"]].add(r["doc_id"])
    ids = [r["doc_id"] for r in one.select("doc_id").collect()]
    # the row without an id cannot be named and stays; of the others one of each component
    named = [i for i in ids if i is not None]
    assert ids.count(None) == 1 and len(named) == len(groups)
    assert all(sum(i in g for i in named) == 1 for g in groups.values())

    mixed = stored(stage["mixing"](spark, one, SF), "test-mixed")
    assert mixed.columns == docs.columns
    words = {r["doc_id"] for r in one.where(F.trim(F.coalesce("text", F.lit(""))) != "").select("doc_id").collect()}
    taken = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert taken and set(taken) <= words and max(taken.values()) <= 3

    packed = stage["packing"](spark, mixed, SF).collect()
    assert {r["doc_id"] for r in packed} == set(taken)
    per = defaultdict(Counter)
    for r in packed:
        per[r["doc_id"]]["length"] += r["length"]
        per[r["doc_id"]]["tokens"] = r["doc_tokens"]
    assert all(c["length"] == c["tokens"] * taken[i] for i, c in per.items())


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF), "test-empty")
    assert docs.count() == 0
