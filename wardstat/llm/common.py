"""Helpers shared by the training-data operators."""
from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_table

BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20              # a batch of very long texts ends early
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def take(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns that an operator reads (alias = name), under its own names: further
    columns of the input cannot clash with what the operator adds, not even by case."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{df.columns.index(name)}").alias(alias) for alias, name in columns.items()])


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return take(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, A_Z, a_z)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder of the session and read back: later steps neither recompute
    it nor depend on the executors that made it."""
    return write_table(df, f"llm-{name}")


def per_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]],
              schema: str) -> DataFrame:
    """Map record batches; ``make`` runs once per task and returns the batch function, so
    tables that the function needs are built once per task. Texts may be long, so batches are
    limited to BATCH_ROWS rows and about BATCH_BYTES, and a worker gives back what a batch took."""
    conf = df.sparkSession.conf
    rows = conf.get(_BATCH_CONF)
    if int(rows) > BATCH_ROWS or int(rows) <= 0:
        conf.set(_BATCH_CONF, str(BATCH_ROWS))
    conf.set(_BYTES_CONF, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            yield from fn(b)
            pa.default_memory_pool().release_unused()
    return df.mapInArrow(run, schema)


def logit(p: float) -> float:
    return math.log(p / (1.0 - p))
