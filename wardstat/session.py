"""Session construction and lineage cutting."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # No broadcast from static size estimates: explicit hints mark the sides that are
    # small by construction (one-row stats, one row per column/class/group); AQE may
    # still broadcast a side whose *measured* shuffle output is small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
}

# The JVM never compiles a method of more than 8,000 bytecodes; it stays interpreted. Above that limit
# Spark shall not fuse a stage, but generate one method an expression: the wide projections over the 41
# raw columns are such stages.
HUGE_METHOD = ("spark.sql.codegen.hugeMethodLimit", "8000")


def compiled_projections(spark: SparkSession) -> None:
    """Sets HUGE_METHOD in a session that came without the setting."""
    key, value = HUGE_METHOD
    if spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, value)


def get_spark(master: str | None = None, app: str = "wardstat",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is unset
    (local tests) fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="wardstat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def clustered(df: DataFrame, key: str) -> DataFrame:
    """Range-partitioned and sorted on ``key``, so that in files written from it an equality / range
    filter on the key skips whole files and row groups. The ranges come from a sample for which
    ``df`` is run once more: cluster what is stored, and compute on the clustered rows."""
    return df.repartitionByRange(key).sortWithinPartitions(key)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Materialize a derived table as parquet in the shared checkpoint folder and read it
    back. Unlike an RDD checkpoint, later queries get column pruning, predicate pushdown
    and row-group skipping."""
    path = shared_path(df.sparkSession, f"tables/{name}")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
