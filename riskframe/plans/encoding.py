"""Registered queries of the encoding / split layer (B8, B14, B16, B22, C1-C8,
H1-H9) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import sig_round_doubles, sig_sql
from ..operators import encode as E
from ..operators import split as H
from ..operators.aggspec import dummy_mean_exprs
from . import sqlgen as S
from . import tables as T
from .features import ORDER_PRIORITIES, ORDER_STATUSES

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
P_TYPES_SQL = "(SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)"
SEED = 42
CONST_DIGITS = 12   # fitted constants are rounded before use, so both engines apply the same ones


def _const(x):
    """Round a fitted constant to CONST_DIGITS significant digits (Python side)."""
    if x is None or x == 0:
        return x
    from math import floor, log10
    k = CONST_DIGITS - 1 - floor(log10(abs(x)))
    return (floor(x * 10 ** k + 0.3819660113) / 10 ** k) if k >= 0 else floor(x / 10 ** -k + 0.3819660113) * 10 ** -k


# --- one_hot (C1/C2) -----------------------------------------------------------
def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    app = T.application(spark, sf)
    out, _ = E.one_hot_encode(app, E.fit_vocabulary(app, ["c_mktsegment"], max_categories=T.MAX_DUMMIES))
    return out


def sql_one_hot() -> str:
    d = ", ".join(f"CAST(coalesce(c_mktsegment = '{v}', false) AS INTEGER) AS \"c_mktsegment_{v}\"" for v in SEGMENTS)
    return (f"SELECT c_custkey, TARGET, c_nationkey, n_regionkey, {d}, "
            f"CAST(c_mktsegment IS NULL AS INTEGER) AS c_mktsegment_nan FROM {T.APPLICATION_SQL}")


# --- dummy_mean (E10 dummies) -------------------------------------------------------
def q_dummy_mean(spark: SparkSession, sf: str) -> DataFrame:
    o = T.table(spark, sf, "orders")
    vocab = E.fit_vocabulary(o, ["o_orderstatus", "o_orderpriority"], max_categories=T.MAX_DUMMIES)
    return sig_round_doubles(o.groupBy("o_custkey").agg(*dummy_mean_exprs(vocab, "PREV")))


def sql_dummy_mean() -> str:
    dbl: set = set()
    items = S.dummy_means("o_orderstatus", ORDER_STATUSES, "PREV", dbl)
    items += S.dummy_means("o_orderpriority", ORDER_PRIORITIES, "PREV", dbl)
    cols = ["o_custkey"] + [i.rsplit(" AS ", 1)[1].strip('"') for i in items]
    return (f"WITH a AS (SELECT o_custkey, {', '.join(items)} FROM orders GROUP BY o_custkey) "
            + S.outer_select(cols, dbl, "a"))


# --- ordinal (C4) / binary_code (C3) ----------------------------------------------------
def q_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    p = T.table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    out = E.ordinal_encode(p, "p_type")
    return E.ordinal_encode(out, "p_brand", ["Brand#11", "Brand#12", "Brand#13"])


def sql_ordinal() -> str:
    return (f"WITH v AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS code "
            f"FROM {P_TYPES_SQL}) "
            "SELECT p.p_partkey, CAST(coalesce(v.code, -1) AS INTEGER) AS p_type, "
            "CAST(CASE p.p_brand WHEN 'Brand#11' THEN 0 WHEN 'Brand#12' THEN 1 WHEN 'Brand#13' THEN 2 "
            "ELSE -1 END AS INTEGER) AS p_brand FROM part p LEFT JOIN v ON p.p_type = v.p_type")


def q_binary_code(spark: SparkSession, sf: str) -> DataFrame:
    p = T.table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    return E.binary_encode(p, "p_type")


def sql_binary_code() -> str:
    # codes 1..k in sorted order; bits = bit length of k (6 types -> 3 bits)
    return (f"WITH v AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS code FROM {P_TYPES_SQL}), "
            "k AS (SELECT count(*) AS n FROM v), "
            "b AS (SELECT CAST(floor(log2(n)) + 1 AS INTEGER) AS nb FROM k), "
            "c AS (SELECT p.p_partkey, p.p_size, coalesce(v.code, 0) AS code FROM part p "
            "LEFT JOIN v ON p.p_type = v.p_type) "
            "SELECT c.p_partkey, c.p_size, "
            "CAST((code >> (nb - 1)) & 1 AS INTEGER) AS p_type_0, "
            "CAST((code >> (nb - 2)) & 1 AS INTEGER) AS p_type_1, "
            "CAST((code >> (nb - 3)) & 1 AS INTEGER) AS p_type_2 FROM c, b")


# --- median_impute (C6/B8), standard_scale (C7), winsorise (B14) -------------------------------
def _impute_input(spark, sf):
    li = T.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
                     F.nullif("l_discount", F.lit(0.0)).alias("DISC"),
                     F.nullif("l_tax", F.lit(0.0)).alias("TAX"))


_IMPUTE_IN_SQL = ("(SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, nullif(l_discount, 0) AS DISC, "
                  "nullif(l_tax, 0) AS TAX FROM lineitem)")


def q_median_impute(spark: SparkSession, sf: str) -> DataFrame:
    d = _impute_input(spark, sf)
    imp = E.MedianImputer(["DISC", "TAX"]).fit(d.where(F.col("l_returnflag") == "R"))
    return sig_round_doubles(imp.transform(d).drop("l_returnflag"))


def sql_median_impute() -> str:
    return (f"WITH d AS {_IMPUTE_IN_SQL}, m AS (SELECT quantile_cont(DISC, 0.5) AS md, "
            "quantile_cont(TAX, 0.5) AS mt FROM d WHERE l_returnflag = 'R'), "
            "r AS (SELECT l_orderkey, l_linenumber, l_partkey, coalesce(DISC, md) AS DISC, "
            "coalesce(TAX, mt) AS TAX FROM d, m) "
            + S.outer_select(["l_orderkey", "l_linenumber", "l_partkey", "DISC", "TAX"], {"DISC", "TAX"}, "r"))


def q_standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                               "l_quantity", "l_extendedprice")
    sc = E.StandardScaler(["l_quantity", "l_extendedprice"]).fit(li)
    sc.stats = {c: (_const(m), _const(s)) for c, (m, s) in sc.stats.items()}
    return sig_round_doubles(sc.transform(li))


def sql_standard_scale() -> str:
    m = ", ".join(f"{sig_sql(f'avg({c})', CONST_DIGITS)} AS m_{c}, {sig_sql(f'stddev_pop({c})', CONST_DIGITS)} AS s_{c}"
                  for c in ("l_quantity", "l_extendedprice"))
    return (f"WITH s AS (SELECT {m} FROM lineitem), r AS (SELECT l_orderkey, l_linenumber, l_partkey, "
            "(l_quantity - m_l_quantity) / s_l_quantity AS l_quantity, "
            "(l_extendedprice - m_l_extendedprice) / s_l_extendedprice AS l_extendedprice FROM lineitem, s) "
            + S.outer_select(["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"],
                             {"l_quantity", "l_extendedprice"}, "r"))


def q_winsorise(spark: SparkSession, sf: str) -> DataFrame:
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                               "l_extendedprice", "l_quantity")
    w = E.Winsorizer(0.01, 0.99, ["l_extendedprice", "l_quantity"]).fit(li)
    w.bounds = {c: (_const(lo), _const(hi)) for c, (lo, hi) in w.bounds.items()}
    return sig_round_doubles(w.transform(li))


def sql_winsorise() -> str:
    b = ", ".join(f"{sig_sql(f'quantile_cont({c}, 0.01)', CONST_DIGITS)} AS lo_{c}, "
                  f"{sig_sql(f'quantile_cont({c}, 0.99)', CONST_DIGITS)} AS hi_{c}"
                  for c in ("l_extendedprice", "l_quantity"))
    clip = lambda c: (f"CASE WHEN lo_{c} < hi_{c} THEN least(greatest({c}, lo_{c}), hi_{c}) ELSE {c} END "  # noqa: E731
                      f"AS {c}")
    return (f"WITH b AS (SELECT {b} FROM lineitem), r AS (SELECT l_orderkey, l_linenumber, l_partkey, "
            f"{clip('l_extendedprice')}, {clip('l_quantity')} FROM lineitem, b) "
            + S.outer_select(["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"],
                             {"l_extendedprice", "l_quantity"}, "r"))


# --- union_align (H1/H2/H3) ------------------------------------------------------
def q_union_align(spark: SparkSession, sf: str) -> DataFrame:
    app = T.application(spark, sf)
    train, test = H.split_on_target(app)
    test = H.left_align(test, [c for c in train.columns if c != "TARGET"])
    return H.union_align(train.withColumn("is_train", F.lit(1)), test.withColumn("is_train", F.lit(0)))


def sql_union_align() -> str:
    return (f"SELECT c_custkey, TARGET, c_nationkey, n_regionkey, c_mktsegment, "
            f"CAST(TARGET IS NOT NULL AS INTEGER) AS is_train FROM {T.APPLICATION_SQL}")


# --- stratified_split (H5), kfold (H7/H8), exact_sample (H4) ----------------------------------------
def _labelled(spark, sf):
    app = T.application(spark, sf)
    return H.split_on_target(app)[0].select("c_custkey", "TARGET", "c_mktsegment")


_LABELLED_SQL = f"(SELECT c_custkey, TARGET, c_mktsegment FROM {T.APPLICATION_SQL} WHERE TARGET IS NOT NULL)"
_HASH_SQL = f"md5('{SEED}' || ':' || CAST(c_custkey AS VARCHAR))"


def q_stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return H.stratified_holdout(_labelled(spark, sf), "TARGET", ["c_custkey"], 20, SEED)


def sql_stratified_split() -> str:
    return (f"SELECT c_custkey, TARGET, c_mktsegment, CAST(row_number() OVER (PARTITION BY TARGET ORDER BY "
            f"{_HASH_SQL}, c_custkey) <= floor((count(*) OVER (PARTITION BY TARGET) * 20 + 50) / 100) "
            f"AS INTEGER) AS is_test FROM {_LABELLED_SQL}")


def q_kfold(spark: SparkSession, sf: str) -> DataFrame:
    d = H.kfold(_labelled(spark, sf), ["c_custkey"], 5, SEED, label="TARGET")
    return H.kfold(d, ["c_custkey"], 3, SEED + 1, name="fold_unstratified")


def sql_kfold() -> str:
    h2 = f"md5('{SEED + 1}' || ':' || CAST(c_custkey AS VARCHAR))"
    return (f"SELECT c_custkey, TARGET, c_mktsegment, "
            f"CAST((row_number() OVER (PARTITION BY TARGET ORDER BY {_HASH_SQL}, c_custkey) - 1) % 5 AS INTEGER) AS fold, "
            f"CAST((row_number() OVER (ORDER BY {h2}, c_custkey) - 1) % 3 AS INTEGER) AS fold_unstratified "
            f"FROM {_LABELLED_SQL}")


def q_exact_sample(spark: SparkSession, sf: str) -> DataFrame:
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return H.exact_sample(li, 2000, ["l_orderkey", "l_linenumber", "l_partkey"], SEED)


def sql_exact_sample() -> str:
    h = (f"md5('{SEED}' || ':' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) "
         f"|| ':' || CAST(l_partkey AS VARCHAR))")
    return (f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem "
            f"ORDER BY {h}, l_orderkey, l_linenumber, l_partkey LIMIT 2000")


QUERIES = {
    "one_hot": q_one_hot, "dummy_mean": q_dummy_mean, "ordinal": q_ordinal,
    "binary_code": q_binary_code, "median_impute": q_median_impute,
    "standard_scale": q_standard_scale, "winsorise": q_winsorise, "union_align": q_union_align,
    "stratified_split": q_stratified_split, "kfold": q_kfold, "exact_sample": q_exact_sample,
}
ORACLES = {
    "one_hot": sql_one_hot, "dummy_mean": sql_dummy_mean, "ordinal": sql_ordinal,
    "binary_code": sql_binary_code, "median_impute": sql_median_impute,
    "standard_scale": sql_standard_scale, "winsorise": sql_winsorise, "union_align": sql_union_align,
    "stratified_split": sql_stratified_split, "kfold": sql_kfold, "exact_sample": sql_exact_sample,
}
