"""Registered queries of the scans and sinks (A1, A2, A8, A10) and of the two
table operators that work on them (F13, H6).  The given tables are Parquet; what
is read here as CSV is what Spark has written from them before."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import sig_round_doubles
from ..operators import metrics as K
from ..operators import models as J
from ..operators import profile as P
from ..operators import split as H
from ..session import ensure_checkpoint_dir
from ..sources import files as A
from . import modeling as ML
from . import tables as T

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey bigint, c_mktsegment string, c_acctbal double"
SEED = 42


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _customer_csv(spark: SparkSession, sf: str) -> str:
    path = _folder(spark, "customer-csv")
    rows = T.table(spark, sf, "customer")
    names = [c.split()[0] for c in CUSTOMER.split(", ")]
    A.write_report_csv(rows.select(*[F.col(c) for c in names]), path, single_file=False)
    return path


def q_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A1: a header CSV under an explicit schema."""
    return A.read_csv(spark, _customer_csv(spark, sf), CUSTOMER)


def sql_csv_scan() -> str:
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}
    return "SELECT " + ", ".join(f"CAST({n} AS {kinds[k]}) AS {n}" for n, k in (c.split() for c in CUSTOMER.split(", "))) + " FROM customer"


def q_csv_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A2: only the key column of a CSV."""
    path = _customer_csv(spark, sf)
    return A.read_table(spark, path, "csv", CUSTOMER).select("c_custkey")


def q_report_readback(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV report read back by its header, in another column order and with
    a column it lacks, and an absent report."""
    path = _folder(spark, "report")
    A.write_report_csv(T.table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("clients")), path)
    schema = "clients long, c_mktsegment string, missing double"
    return A.read_or_empty(spark, path, schema).unionByName(A.read_or_empty(spark, f"{path}-absent", schema))


def sql_report_readback() -> str:
    return "SELECT count(*) AS clients, c_mktsegment, CAST(NULL AS DOUBLE) AS missing FROM customer GROUP BY c_mktsegment"


def q_run_metrics_retried(spark: SparkSession, sf: str) -> DataFrame:
    """A10: the same run written twice (a retry), beside another run, read back."""
    app = T.application(spark, sf)
    lab = H.stratified_holdout(H.split_on_target(app)[0].withColumnRenamed("c_custkey", "id").withColumnRenamed("TARGET", "y"), "y", ["id"], 20, SEED)
    model, _ = J.fit("majority", lab.where("is_test = 0"), "y")
    wide = K.classification_metrics(J.score(model, lab.where("is_test = 1"), ["id", "y"]), threshold=0.5)
    path = _folder(spark, "run-metrics")
    for run in ("majority", "other", "majority"):
        A.append_run_metrics(A.long_metrics(wide, run, "baseline"), path)
    back = spark.read.parquet(path).select("run_id", "scope", "split", "metric", "value")
    return sig_round_doubles(back)


def sql_run_metrics_retried() -> str:
    wide = f"SELECT CAST(COLUMNS(*) AS DOUBLE) FROM ({ML.sql_majority()})"
    long = f"({wide}) UNPIVOT INCLUDE NULLS (value FOR metric IN (COLUMNS(*)))"
    return f"SELECT r.run_id, 'baseline' AS scope, 'all' AS split, metric, value FROM {long}, (VALUES ('majority'), ('other')) AS r(run_id)"


def q_holdout(spark: SparkSession, sf: str) -> DataFrame:
    """H6: an unstratified 80/20 split."""
    return H.holdout(H.split_on_target(T.application(spark, sf))[0].select("c_custkey", "TARGET"), ["c_custkey"], 20, SEED)


def sql_holdout() -> str:
    h = f"md5('{SEED}' || ':' || CAST(c_custkey AS VARCHAR))"
    return (f"SELECT c_custkey, TARGET, CAST(row_number() OVER (ORDER BY {h}, c_custkey) <= floor((count(*) OVER () * 20 + 50) / 100) "
            f"AS INTEGER) AS is_test FROM {T.APPLICATION_SQL} WHERE TARGET IS NOT NULL")


def q_all_missing(spark: SparkSession, sf: str) -> DataFrame:
    """customers with the columns that no negative balance has left out."""
    rows = T.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") > 1e9, F.col("c_acctbal")).alias("never"),
                                                F.when(F.col("c_acctbal") < 0, F.col("c_acctbal")).alias("debt"))
    return rows.drop(*P.all_missing_columns(rows))


def sql_all_missing() -> str:
    return "SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN c_acctbal END AS debt FROM customer"


QUERIES = {"csv_scan": q_csv_scan, "csv_keys": q_csv_keys, "report_readback": q_report_readback,
           "run_metrics_retried": q_run_metrics_retried, "holdout": q_holdout, "all_missing": q_all_missing}
ORACLES = {"csv_scan": sql_csv_scan, "csv_keys": lambda: "SELECT c_custkey FROM customer", "report_readback": sql_report_readback,
           "run_metrics_retried": sql_run_metrics_retried, "holdout": sql_holdout, "all_missing": sql_all_missing}
