"""Spark session helpers.

The library never creates a session implicitly: every operator receives
DataFrames and uses ``df.sparkSession``.  ``get_spark`` is a convenience for
scripts, tests and the benchmark.  On a cluster the session is created by the
platform; only ``checkpoint_dir`` is read from it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the operators in this package:
#  * AQE re-plans joins (broadcast of small feature blocks, coalesced
#    partitions, skew-join splitting) from runtime statistics.
#  * The UI is a server: it stays off.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide feature frames: keep codegen for the aggregate blocks (<= ~150 cols)
    "spark.sql.codegen.maxFields": "200",
}


def get_spark(
    app: str = "riskframe",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the configured checkpoint folder.  A scratch folder is set only in
    local mode (tests, scripts), where driver and executors are one process; a
    cluster must name a folder that all of its machines share."""
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir is not set, and master {master!r} is not local: "
                           "name a folder that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="riskframe-ckpt-", dir=os.environ.get("RISKFRAME_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package's modules to the Python workers, once per Spark
    application (the driver serves the archive like any added Python file)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(sc._temp_dir, f"{root.name}-modules.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """For jobs over very many columns: a stage whose generated method is so long
    that the JVM would never compile it (8,000 bytes) runs as several short ones."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back: later
    passes scan only the columns they need, see real sizes, and survive lost
    executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/handover-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
