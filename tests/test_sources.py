import os
import tempfile

from pyspark.sql import functions as F

from paths import SF
from riskframe.sources import files as A


def test_csv_roundtrip_and_fallback(spark):
    d = tempfile.mkdtemp(prefix="rf-src-", dir="/tmp")
    df = spark.createDataFrame([(1, "a", 0.5), (2, "b", None)], "id int, s string, x double")
    A.write_report_csv(df, os.path.join(d, "rep"))
    back = A.read_table(spark, os.path.join(d, "rep"), "csv", schema="id int, s string, x double")
    assert sorted(back.collect()) == sorted(df.collect())
    assert A.read_table(spark, os.path.join(d, "rep"), "csv", schema="id int, s string, x double", num_rows=1).count() == 1
    empty = A.read_or_empty(spark, os.path.join(d, "absent"), "id int, s string")
    assert empty.count() == 0 and empty.columns == ["id", "s"]


def test_json_document_and_run_metrics(spark):
    d = tempfile.mkdtemp(prefix="rf-src-", dir="/tmp")
    doc = spark.range(1).select(F.lit("m1").alias("best"), F.array(F.lit("m1"), F.lit("m2")).alias("ranking"))
    A.write_json_document(doc, os.path.join(d, "rec"))
    assert spark.read.json(os.path.join(d, "rec")).first().ranking == ["m1", "m2"]
    wide = spark.createDataFrame([("train", 0.9, 10), ("test", 0.8, 12)], "split string, auc double, fn long")
    long = A.long_metrics(wide, "run-1", "baseline", "split")
    A.append_run_metrics(long, os.path.join(d, "metrics"))
    A.append_run_metrics(A.metrics_frame(spark, "run-2", "tuned", "test", {"auc": 0.85}), os.path.join(d, "metrics"))
    got = spark.read.parquet(os.path.join(d, "metrics"))
    assert got.count() == 5 and {r.run_id for r in got.select("run_id").distinct().collect()} == {"run-1", "run-2"}


def test_file_inventory_and_key_scan(spark):
    reg = {"orders": f"{SF}/orders.parquet", "missing": f"{SF}/nope.csv"}
    inv = {r.name: r for r in A.file_inventory(spark, reg).collect()}
    assert inv["orders"].exists and inv["orders"].size_mb >= 0 and not inv["missing"].exists
    keys = A.read_keys(spark, f"{SF}/orders.parquet", ["o_orderkey", "o_custkey"])
    assert keys.columns == ["o_orderkey", "o_custkey"]


def test_a_run_written_again_replaces_only_itself(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="rf-src-", dir="/tmp"), "metrics")
    for run, auc in (("run-1", 0.7), ("run-2", 0.8), ("run-1", 0.9)):
        A.append_run_metrics(A.metrics_frame(spark, run, "baseline", "test", {"auc": auc, "ap": None}), path)
    got = {(r.run_id, r.metric): r.value for r in spark.read.parquet(path).collect()}
    assert got == {("run-1", "auc"): 0.9, ("run-1", "ap"): None, ("run-2", "auc"): 0.8, ("run-2", "ap"): None}
    assert spark.read.parquet(path).count() == 4
