"""Sources and sinks S01-S09: CSV ingest, shapes, parquet/CSV sinks, typed table load,
reproducible row order. Writers are partitioned (one file per task), never funnelled
through the driver; readers declare schemas where the input is text."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab as V


def csv_to_parquet(spark: SparkSession, csv_path: str, out_path: str, infer: bool = True) -> DataFrame:
    """Header CSV, type inference over all rows, overwrite, ZSTD parquet; returns the re-read table.
    (``samplingRatio`` 1.0 makes inference look at every row, like a full-file sniff.)"""
    df = (spark.read.option("header", True).option("inferSchema", infer).option("samplingRatio", 1.0)
          .csv(csv_path))
    df.write.mode("overwrite").option("compression", "zstd").parquet(out_path)
    return spark.read.parquet(out_path)


def table_shapes(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """(dataset, n_rows, n_cols) per table. ``count()`` on parquet reads only footers
    (row-group metadata); the column count comes from the schema."""
    out = None
    for n in names:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet")
        part = df.agg(F.count(F.lit(1)).cast("long").alias("n_rows")).select(
            F.lit(n).alias("dataset"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"))
        out = part if out is None else out.unionByName(part)
    return out


def write_parquet_and_read(df: DataFrame, path: str) -> DataFrame:
    """Partitioned parquet write (no index column), read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv_and_read(df: DataFrame, path: str) -> DataFrame:
    """CSV with header; read back with the writer's schema (no inference)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.option("header", True).schema(df.schema).csv(path)


def _patients_schema() -> T.StructType:
    fields = [T.StructField("patient_id", T.LongType(), False)]
    for c in V.FINAL_COLUMNS[1:]:
        if c in V.NUMERIC_COLUMNS:
            t = T.DoubleType()
        elif c == "admission_date":
            t = T.DateType()
        elif c in V.OUTCOME_COLUMNS:
            t = T.IntegerType()
        else:
            t = T.StringType()
        fields.append(T.StructField(c, t, True))
    return T.StructType(fields)


PATIENTS_SCHEMA = _patients_schema()


def load_table(df: DataFrame, schema: T.StructType, path: str, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """Cast to the declared schema, refuse if the target exists (``errorifexists``),
    one all-or-nothing job commit, then read back for verification (V15).
    The same writer takes ``fmt="jdbc"`` with connection ``options``."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for load: {missing}")
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    w = typed.write.mode("errorifexists").format(fmt).options(**(options or {}))
    if fmt == "jdbc":
        w.save()
        return df.sparkSession.read.format("jdbc").options(**(options or {})).load()
    w.save(path)
    return df.sparkSession.read.schema(schema).format(fmt).load(path)


def with_row_order(spark: SparkSession, path: str) -> DataFrame:
    """Reproducible source order from parquet metadata: (file path, row index in the file), and
    ``row_order``, the gapless position over all files in path order. The rows are not moved: the
    rows of each file are counted from the metadata column, one row per file is summed up and
    joined back (AQE broadcasts it while it is small)."""
    df = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))
    files = df.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)          # over files
    starts = files.select("file_path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return df.join(starts, "file_path").withColumn("row_order", (F.col("start") + F.col("row_index")).cast("long")).drop("start")
