"""Shared helpers of the training-data operators: tables written to the shared
folder, row keys, and the driver of Arrow batch functions."""

from __future__ import annotations

import contextlib
import ctypes
import os
import uuid
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{tag}-{uuid.uuid4().hex}"


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.  The written
    table cuts the lineage, survives lost executors, and fixes the values of
    non-deterministic columns such as row ids."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the tables of ``stage`` frames.  Only for tables whose readers have
    all been written themselves: what has been written reads nothing again."""
    for df in frames:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.written)
        path.getFileSystem(conf).delete(path, True)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's modules to the Python workers, once per Spark
    application (the driver serves the archive like any added Python file)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(sc._temp_dir, f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    # whole texts travel in these batches: keep them small beside the heap
    if spark.conf.get(BATCH_ROWS, "10000") == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    _shipped.add(sc.applicationId)


def release_memory() -> None:
    """Hand the worker's freed memory back to the system: workers live on between
    tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):     # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers, which give their
    memory back after each task."""
    ship(df.sparkSession)

    def run(batches):
        yield from function(batches)
        release_memory()
    return df.mapInArrow(run, schema)


def with_row_id(df: DataFrame, name: str = "_row") -> DataFrame:
    """Unique row ids; only stable once the frame has been written (``stage``)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def column_or_null(df: DataFrame, name: str, dtype: str) -> Column:
    """The column cast to ``dtype``, or a typed NULL when the table lacks it."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast(dtype)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def safe_name(taken: Sequence[str], name: str) -> str:
    """``name``, with underscores appended until no input column has it
    (Spark's column names ignore case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def row_key(df: DataFrame) -> DataFrame:
    """``documents`` reduced to (id, key, lang, source, text): id and text hash
    name a row (repeated rows share both); missing columns are NULL."""
    text = column_or_null(df, "text", "string")
    return df.select(column_or_null(df, "doc_id", "long").alias("id"), F.xxhash64(text).alias("key"),
                     column_or_null(df, "lang", "string").alias("lang"),
                     column_or_null(df, "source", "string").alias("source"), text.alias("text"))


BUCKETS = 1 << 20              # hash buckets of a broadcast: its rows at most


def apart(docs: DataFrame, key, rare: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` in two: rows that share no hash bucket with the keys of ``rare``
    (one column), and the others.  The buckets that hold a key are broadcast, at
    most ``BUCKETS`` of them, so only the others' texts need a shuffle."""
    name = safe_name(docs.columns, "_bucket")
    buckets = F.broadcast(rare.select(F.pmod(F.xxhash64(rare.columns[0]), F.lit(BUCKETS)).alias(name)).distinct())
    same = F.pmod(F.xxhash64(key), F.lit(BUCKETS)) == buckets[name]
    return docs.join(buckets, same, "left_anti"), docs.join(buckets, same, "left_semi")


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (id, key) is not in ``rejected``."""
    gone = stage(rejected.select("id", "key").distinct(), "gone")
    i, k = safe_name(docs.columns, "_gone_id"), safe_name(docs.columns, "_gone_key")
    clear, others = apart(docs, F.xxhash64(docs["text"]), gone.select("key"))
    gone = gone.select(gone["id"].alias(i), gone["key"].alias(k))
    return clear.unionByName(others.join(
        gone, others["doc_id"].eqNullSafe(F.col(i)) & (F.xxhash64(others["text"]) == F.col(k)), "left_anti"))
