"""Distributed global order: dense row index and running sums without a
single-partition window.

The frame is range-partitioned on the order keys (equal keys share a partition),
written once to the checkpoint folder so partition ids stay fixed, per-partition
totals (one row per partition) give prefix offsets, and a window *partitioned by
partition id* finishes each partition independently.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def global_prefix(df: DataFrame, order_cols: list, sum_cols: list[str] = (), partitions: int | None = None,
                  index_col: str = "row_index") -> DataFrame:
    """Adds ``index_col`` (0-based position in the global order) and ``cum_<c>``
    (inclusive running sum) for each ``c`` in ``sum_cols``."""
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    staged = cut_lineage(df.repartitionByRange(n_parts, *ordered).sortWithinPartitions(*ordered)
                         .withColumn("__pid", F.spark_partition_id()))
    totals = staged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"),
                                         *[F.sum(c).alias(f"__tot_{c}") for c in sum_cols])
    # one row per partition: the window over it is tiny
    wt = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", F.coalesce(F.sum("__cnt").over(wt), F.lit(0)).alias("__off"),
                            *[F.coalesce(F.sum(f"__tot_{c}").over(wt), F.lit(0)).alias(f"__off_{c}")
                              for c in sum_cols])
    w = Window.partitionBy("__pid").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, 0)
    local = staged.withColumn("__rn", F.row_number().over(Window.partitionBy("__pid").orderBy(*ordered)))
    for c in sum_cols:
        local = local.withColumn(f"__loc_{c}", F.sum(c).over(w))
    out = local.join(F.broadcast(offsets), "__pid")
    out = out.withColumn(index_col, (F.col("__off") + F.col("__rn") - 1).cast("long"))
    for c in sum_cols:
        out = out.withColumn(f"cum_{c}", F.col(f"__off_{c}") + F.col(f"__loc_{c}"))
    return out.drop("__pid", "__rn", "__off", *[f"__off_{c}" for c in sum_cols], *[f"__loc_{c}" for c in sum_cols])
