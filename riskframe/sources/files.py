"""Scans and sinks (A1-A10): local or distributed files through Spark's
readers and writers only -- nothing is read through the driver."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             num_rows: int | None = None) -> DataFrame:
    """A1: header CSV with an explicit schema (inference only when none is
    given -- it costs an extra pass); ``num_rows`` keeps the first N rows."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    return df.limit(num_rows) if num_rows is not None else df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, num_rows: int | None = None) -> DataFrame:
    """A1 / A5: parquet, csv or json."""
    if fmt == "csv":
        return read_csv(spark, path, schema, num_rows)
    r = spark.read if schema is None else spark.read.schema(schema)
    df = r.format(fmt).load(path)
    return df.limit(num_rows) if num_rows is not None else df


def read_keys(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """A2: only the key columns (the projection reaches the file reader)."""
    return read_table(spark, path, fmt).select(*keys)


def file_inventory(spark: SparkSession, registry: Mapping[str, str]) -> DataFrame:
    """A4: name, path, exists, size_mb for every registered table: a file or a
    directory of part files, under any scheme that Hadoop's file systems know.
    Only an absent path is reported as missing; other errors are raised."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    rows = []
    for name, p in registry.items():
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        size = fs.getContentSummary(path).getLength() if fs.exists(path) else None
        rows.append((name, p, size))
    listed = spark.createDataFrame(rows, "name string, path string, length long")
    return listed.select("name", "path", F.col("length").isNotNull().alias("exists"),
                         F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """A6."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def hand_over_bucketed(df: DataFrame, key: str, buckets: int, path: str, clustered: bool = False) -> DataFrame:
    """``df`` written once under ``path``, bucketed and sorted by ``key``, and read
    back: tables of equal ``buckets`` join on the key without a shuffle, as often
    as they are read.  One task writes a bucket as one sorted file.  ``clustered``:
    the rows already lie in ``buckets`` partitions by ``key`` and move no more."""
    name = f"handover_{uuid.uuid4().hex}"
    ((df if clustered else df.repartition(buckets, key)).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def write_report_csv(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Reports are small (one row per column / model / threshold), so one
    file is fine; data-sized frames keep their partitioning."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv") -> DataFrame:
    """The columns of ``schema`` of a previous report, found by name (a CSV
    report by its header), NULL where the report lacks one; an absent path
    gives an empty frame with that schema."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    try:
        r = spark.read.option("header", True) if fmt == "csv" else spark.read
        found = r.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return found.select(*[(F.col(f.name) if f.name in found.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                          for f in schema.fields])


def write_json_document(df: DataFrame, path: str) -> None:
    """A (one-row) nested document -- struct/array columns -- as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


METRIC_SCHEMA = "run_id string, scope string, split string, metric string, value double"


def metrics_frame(spark: SparkSession, run_id: str, scope: str, split: str,
                  metrics: Mapping[str, float]) -> DataFrame:
    """A10: a run's metrics as long rows (run_id, scope, split, metric, value)."""
    rows = [(run_id, scope, split, k, None if v is None else float(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def long_metrics(wide: DataFrame, run_id: str, scope: str, split_col: str | None = None) -> DataFrame:
    """A10 from a metrics DataFrame (one row per split): unpivot every numeric
    column to (run_id, scope, split, metric, value) -- no collect."""
    ids = [split_col] if split_col else []
    vals = [f.name for f in wide.schema.fields if f.name not in ids and
            isinstance(f.dataType, (T.DoubleType, T.LongType, T.IntegerType, T.FloatType))]
    w = wide.select(*ids, *[F.col(c).cast("double").alias(c) for c in vals])
    long = w.unpivot(ids, vals, "metric", "value")
    split = F.col(split_col).cast("string") if split_col else F.lit("all")
    return long.select(F.lit(run_id).alias("run_id"), F.lit(scope).alias("scope"), split.alias("split"),
                       "metric", "value")


def append_run_metrics(df: DataFrame, path: str) -> None:
    """A10 sink: partitioned by run; a run that is written again replaces its own
    rows and no other run's, so a retried flow leaves one set."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
