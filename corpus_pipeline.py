"""Corpus pipeline: toxicity, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; between
stages the documents are written to the shared folder and read back."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardstat.llm import mixing, packing, simhash, toxicity
from wardstat.llm.common import read, stored

ORACLE_SQL = None                  # the stages are beyond SQL; tests compare with brute force


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts toxic go; each row is decided by its text."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_copies), ("mixing", mix_sources),
          ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
