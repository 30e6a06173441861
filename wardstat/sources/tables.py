"""Scans of the input tables and the derived patient fixture."""
from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

from ..session import compiled_projections
from . import fixture

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full parquet scan (S02); Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


RAW_ROWS_PER_TASK = 50_000          # a raw row costs far more time than its bytes in ``orders`` tell


def patients_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order keys are dealt by number of rows first: a scan is split by bytes and row groups, so a
    few tasks would build all the wide rows."""
    compiled_projections(spark)
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    return fixture.patients_raw(keys.repartition(max(1, -(-keys.count() // RAW_ROWS_PER_TASK))))
