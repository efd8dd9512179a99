"""Analogue mapping of the provided test tables onto the credit-risk model.

| role                               | table      | key                    |
|------------------------------------|------------|------------------------|
| application (one row per client)   | customer   | c_custkey              |
| previous applications / bureau     | orders     | o_orderkey -> o_custkey|
| monthly history of a credit        | lineitem   | l_orderkey -> order    |
| card / cash balance events         | events     | user_id -> c_custkey   |
| scored table (y, score)            | labels ⋈ documents, customer |   |

TARGET := c_acctbal < 0 (c_acctbal is then excluded from the features).
"Test" clients (TARGET unknown) are the ones whose md5 key hash starts with
'0' or '1' (1/8 of clients); all clients stay in every output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the analogue mapping.
REFERENCE_DATE = "2002-01-01"          # day offsets are counted to this date (<= 0)
TEST_HASH_PREFIXES = ("0", "1")        # md5 first hex digit of test clients
ORDER_STATUS_ACTIVE = "O"              # plays ACTIVE / APPROVED
ORDER_STATUS_CLOSED = "F"              # plays CLOSED / REFUSED
MAX_DUMMIES = 1000                     # most dummy columns that one text column may turn into


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def is_test_client(key: Column | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.substring(F.md5(k.cast("string")), 1, 1).isin(*TEST_HASH_PREFIXES)


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per client: key, TARGET (NULL for test clients), raw features."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(
                "c_custkey",
                F.when(~is_test_client("c_custkey"), (F.col("c_acctbal") < 0).cast("int"))
                .alias("TARGET"),
                "c_nationkey", "n_regionkey", "c_mktsegment"))


def day_offset(ts: str) -> Column:
    """Whole days from the reference date (negative in the past)."""
    return F.datediff(F.col(ts).cast("date"), F.lit(REFERENCE_DATE).cast("date"))


def labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, y, score) for the evaluation operators: documents with a quality
    label, score = squashed length truncated to 2 decimals (ties on purpose;
    ``floor`` instead of ``round`` so no engine-specific half rounding)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (lab.join(d, "doc_id")
            .select(F.col("doc_id").alias("id"),
                    F.col("quality").alias("y"),
                    (F.floor(F.col("n_chars") * 100 / (F.col("n_chars") + 2000)) / 100)
                    .alias("score")))


SCORES_SQL = """(SELECT l.doc_id AS id, l.quality AS y,
       floor(d.n_chars * 100 / (d.n_chars + 2000)) / 100 AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

APPLICATION_SQL = """(SELECT c.c_custkey,
       CASE WHEN substr(md5(CAST(c.c_custkey AS VARCHAR)), 1, 1) IN ('0', '1') THEN NULL
            ELSE CAST(c.c_acctbal < 0 AS INTEGER) END AS TARGET,
       c.c_nationkey, n.n_regionkey, c.c_mktsegment
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
