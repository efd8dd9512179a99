"""Registered queries of the profiling layer
and their DuckDB oracles.  The profiled frame is the client feature mart (it
has real missing values: most clients have no event), so the oracle embeds the
mart's oracle SQL as a CTE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import sig_round_doubles
from ..operators import profile as P
from ..session import cut_lineage
from ..sources.files import file_inventory
from . import features as FE
from . import sqlgen as S
from . import tables as T

_TYPE_SQL = ("CASE min(typeof({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
             "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
             "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(min(typeof({c}))) END")


def _mart(spark, sf, materialize: bool = True):
    """The mart handed over as a table written once (reliable checkpoint in
    spark.checkpoint.dir), as the pipeline hands the enriched table from the
    preparation stage to the reports: passes read it instead of recomputing
    its joins and aggregates, and the wide unpivots start from a plain scan."""
    m = FE.q_client_feature_mart(spark, sf)
    return cut_lineage(m) if materialize else m


def _mart_cte() -> str:
    return f"mart AS ({FE.sql_client_feature_mart()})"


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _stats_sql(src: str, cols: list[str]) -> str:
    """Per-column stats rows (variable, dtype, rows, null_count, non_null,
    nunique, nunique_with_null, dominant_count) as one UNION ALL."""
    parts = []
    for c in cols:
        qc = S.q(c)
        parts.append(
            f"SELECT '{c}' AS variable, {_TYPE_SQL.format(c=qc)} AS dtype, count(*) AS rows, "
            f"count(*) - count({qc}) AS null_count, count({qc}) AS non_null, count(DISTINCT {qc}) AS nunique, "
            f"count(DISTINCT {qc}) + CAST(max(CASE WHEN {qc} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nunique_with_null, "
            f"(SELECT max(n) FROM (SELECT count(*) AS n FROM {src} GROUP BY {qc})) AS dominant_count "
            f"FROM {src}")
    return _union(parts)


# --- F2 profile_columns ----------------------------------------------------------------
def q_profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.column_quality(_mart(spark, sf)))


def sql_profile_columns() -> str:
    return (f"WITH {_mart_cte()}, s AS ({_stats_sql('mart', FE.mart_columns())}), "
            "r AS (SELECT variable, dtype, null_count * 100.0 / rows AS pct_null, non_null, null_count, "
            "nunique AS n_uniques FROM s) " + S.outer_select(
                ["variable", "dtype", "pct_null", "non_null", "null_count", "n_uniques"], {"pct_null"}, "r"))


# --- F3 numeric_completeness -------------------------------------------------------------
def q_numeric_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.numeric_completeness(_mart(spark, sf), FE.mart_numeric_columns()))


def sql_numeric_completeness() -> str:
    parts = [f"SELECT '{c}' AS variable, count_if({S.q(c)} IS NULL) * 100.0 / count(*) AS pct_nan, "
             f"count_if({S.q(c)} = 0) * 100.0 / count(*) AS pct_zero FROM mart" for c in FE.mart_numeric_columns()]
    return (f"WITH {_mart_cte()}, s AS ({_union(parts)}), r AS (SELECT *, pct_nan + pct_zero AS pct_nan_zero FROM s) "
            + S.outer_select(["variable", "pct_nan", "pct_zero", "pct_nan_zero"],
                             {"pct_nan", "pct_zero", "pct_nan_zero"}, "r"))


# --- F4 iqr_outliers ---------------------------------------------------------------
def q_iqr_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.iqr_outliers(_mart(spark, sf), FE.mart_numeric_columns()))


def sql_iqr_outliers() -> str:
    """The mart once (materialised), unpivoted once, grouped by variable."""
    cols = FE.mart_numeric_columns()
    casts = ", ".join(f"CAST({S.q(c)} AS DOUBLE) AS {S.q(c)}" for c in cols)
    names = ", ".join(S.q(c) for c in cols)
    return (f"WITH {_mart_cte().replace('mart AS (', 'mart AS MATERIALIZED (', 1)}, d AS (SELECT {casts} FROM mart), "
            f"l AS MATERIALIZED (UNPIVOT d ON {names} INTO NAME variable VALUE x), "
            "q AS (SELECT variable, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3, "
            "min(x) AS min, max(x) AS max, count(*) AS non_null FROM l GROUP BY variable), "
            "fences AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q), "
            "c AS (SELECT l.variable, count_if(x < f.lower) AS n_low, count_if(x > f.upper) AS n_high "
            "FROM l JOIN fences f ON l.variable = f.variable GROUP BY l.variable), "
            "r AS (SELECT f.variable, coalesce((c.n_low + c.n_high) * 100.0 / nullif(f.non_null, 0), 0.0) AS pct_outliers, "
            "coalesce(c.n_low, 0) AS n_low, coalesce(c.n_high, 0) AS n_high, f.min, f.q1, f.median, f.q3, f.max, "
            "f.lower, f.upper FROM fences f LEFT JOIN c ON f.variable = c.variable) "
            + S.outer_select(["variable", "pct_outliers", "n_low", "n_high", "min", "q1", "median", "q3", "max",
                              "lower", "upper"],
                             {"pct_outliers", "min", "q1", "median", "q3", "max", "lower", "upper"}, "r"))


# --- F5 moments --------------------------------------------------------------------
def q_moments(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.moments(_mart(spark, sf), FE.mart_numeric_columns()))


def sql_moments() -> str:
    parts = []
    for c in FE.mart_numeric_columns():
        x = f"CAST({S.q(c)} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS variable, count({x}) AS n, min({x}) AS min, max({x}) AS max, "
            f"CASE WHEN count({x}) < 3 THEN NULL WHEN var_pop({x}) = 0 THEN 0.0 ELSE skewness({x}) END AS skew, "
            f"CASE WHEN count({x}) < 4 THEN NULL WHEN var_pop({x}) = 0 THEN 0.0 ELSE kurtosis({x}) END AS kurtosis "
            f"FROM mart")
    return (f"WITH {_mart_cte()}, r AS ({_union(parts)}) "
            + S.outer_select(["variable", "n", "min", "max", "skew", "kurtosis"],
                             {"min", "max", "skew", "kurtosis"}, "r"))


# --- F6 top_modality ------------------------------------------------------------------
_CAT_COLS = ["o_orderstatus", "o_orderpriority", "o_clerkish"]


def _cat_frame(spark, sf):
    o = T.table(spark, sf, "orders")
    # a third column with missing values: priority only for urgent orders
    return o.select("o_orderstatus", "o_orderpriority",
                    F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderstatus")).alias("o_clerkish"))


_CAT_SQL = ("(SELECT o_orderstatus, o_orderpriority, CASE WHEN starts_with(o_orderpriority, '1') "
            "THEN o_orderstatus END AS o_clerkish FROM orders)")


def q_top_modality(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.categorical_summary(_cat_frame(spark, sf), _CAT_COLS))


def sql_top_modality() -> str:
    parts = []
    for c in _CAT_COLS:
        parts.append(
            f"SELECT '{c}' AS variable, count(DISTINCT {c}) AS n_uniques, count(*) - count({c}) AS null_count, "
            f"(count(*) - count({c})) * 100.0 / count(*) AS pct_null, "
            f"(SELECT {c} FROM cat WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top_value, "
            f"coalesce((SELECT count(*) FROM cat WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1), 0) "
            f"AS top_count FROM cat")
    return (f"WITH cat AS {_CAT_SQL}, r AS ({_union(parts)}) "
            + S.outer_select(["variable", "n_uniques", "null_count", "pct_null", "top_value", "top_count"],
                             {"pct_null"}, "r"))


# --- F7 temporal_summary -----------------------------------------------------------------
def q_temporal_summary(spark: SparkSession, sf: str) -> DataFrame:
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    return sig_round_doubles(P.temporal_summary(j, ["o_orderdate", "l_shipdate"]))


def sql_temporal_summary() -> str:
    parts = [f"SELECT '{c}' AS variable, strftime(min({c}), '%Y-%m-%d %H:%M:%S') AS min, "
             f"strftime(max({c}), '%Y-%m-%d %H:%M:%S') AS max, count_if({c} IS NULL) AS null_count, "
             f"count_if({c} IS NULL) * 100.0 / count(*) AS pct_null FROM j" for c in ("o_orderdate", "l_shipdate")]
    return ("WITH j AS (SELECT o.o_orderdate, l.l_shipdate FROM orders o LEFT JOIN lineitem l "
            f"ON o.o_orderkey = l.l_orderkey), r AS ({_union(parts)}) "
            + S.outer_select(["variable", "min", "max", "null_count", "pct_null"], {"pct_null"}, "r"))


# --- F8 missing_table ---------------------------------------------------------------------
def q_missing_table(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.missing_values_table(_mart(spark, sf)))


def sql_missing_table() -> str:
    return (f"WITH {_mart_cte()}, s AS ({_stats_sql('mart', FE.mart_columns())}), "
            "r AS (SELECT variable, null_count AS missing_count, null_count / rows AS missing_ratio, dtype, nunique "
            "FROM s WHERE null_count > 0) "
            + S.outer_select(["variable", "missing_count", "missing_ratio", "dtype", "nunique"], {"missing_ratio"}, "r"))


# --- F9 duplicate_report, F10 grain_report ---------------------------------------------------------
def q_duplicate_report(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.duplicate_report(T.table(spark, sf, "lineitem"), "l_orderkey"))


def _dup_sql(table: str, key: str) -> str:
    return (f"SELECT count(*) AS rows, count(DISTINCT {key}) + coalesce(max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END), 0) "
            f"AS unique_keys FROM {table}")


def sql_duplicate_report() -> str:
    return (f"WITH a AS ({_dup_sql('lineitem', 'l_orderkey')}), r AS (SELECT rows, unique_keys, "
            "rows - unique_keys AS duplicated_keys, CASE WHEN rows > 0 THEN (rows - unique_keys) / rows "
            "ELSE 0.0 END AS duplicated_ratio FROM a) "
            + S.outer_select(["rows", "unique_keys", "duplicated_keys", "duplicated_ratio"], {"duplicated_ratio"}, "r"))


GRAIN = [("customer", "c_custkey", None), ("orders", "o_orderkey", "o_custkey"),
         ("lineitem", None, "l_orderkey"), ("events", "event_id", "user_id")]


def q_grain_report(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.grain_report({t: (T.table(spark, sf, t), m, p) for t, m, p in GRAIN}))


def sql_grain_report() -> str:
    parts = []
    for t, m, p in GRAIN:
        for role, k in (("main", m), ("parent", p)):
            if k is None:
                parts.append(f"SELECT '{t}' AS \"table\", '{role}' AS key_role, NULL::VARCHAR AS key, NULL::BIGINT AS rows, "
                             "NULL::BIGINT AS unique_keys, NULL::BIGINT AS duplicated_keys, NULL::DOUBLE AS duplicated_ratio")
            else:
                parts.append(f"SELECT '{t}' AS \"table\", '{role}' AS key_role, '{k}' AS key, rows, unique_keys, "
                             f"rows - unique_keys AS duplicated_keys, CASE WHEN rows > 0 THEN (rows - unique_keys) / rows "
                             f"ELSE 0.0 END AS duplicated_ratio FROM ({_dup_sql(t, k)})")
    return (f"WITH r AS ({_union(parts)}) "
            + S.outer_select(["table", "key_role", "key", "rows", "unique_keys", "duplicated_keys", "duplicated_ratio"],
                             {"duplicated_ratio"}, "r"))


# --- F11 low_info, F12 quasi_constant, F15/F16 quality_report ------------------------------------------
def q_low_info(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.low_information_report(_mart(spark, sf), ["c_custkey", "TARGET"]))


def _feature_cols():
    return [c for c in FE.mart_columns() if c not in ("c_custkey", "TARGET")]


def sql_low_info() -> str:
    return (f"WITH {_mart_cte()}, s AS ({_stats_sql('mart', _feature_cols())}), "
            "r AS (SELECT variable AS feature, CASE WHEN non_null = 0 THEN 'all_missing' "
            "WHEN null_count / rows >= 0.995 THEN 'quasi_all_missing' WHEN nunique <= 1 THEN 'constant' END AS reason, "
            "null_count / rows AS missing_ratio, nunique FROM s), f AS (SELECT * FROM r WHERE reason IS NOT NULL) "
            + S.outer_select(["feature", "reason", "missing_ratio", "nunique"], {"missing_ratio"}, "f"))


def _train(spark, sf):
    return _mart(spark, sf).where(F.col("TARGET").isNotNull())


def q_quasi_constant(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.train_pruning_report(_train(spark, sf), ["c_custkey", "TARGET"]))


def sql_quasi_constant() -> str:
    return (f"WITH {_mart_cte()}, tr AS (SELECT * FROM mart WHERE TARGET IS NOT NULL), "
            f"s AS ({_stats_sql('tr', _feature_cols())}), "
            "r AS (SELECT variable AS feature, CASE WHEN null_count = rows THEN 'all_missing_in_train' "
            "WHEN nunique <= 1 THEN 'constant_in_train' WHEN dominant_count / rows >= 0.995 "
            "THEN 'quasi_constant_in_train' END AS reason, null_count / rows AS missing_ratio_train, "
            "nunique AS nunique_train, dominant_count / rows AS dominant_ratio_train FROM s), "
            "f AS (SELECT * FROM r WHERE reason IS NOT NULL) "
            + S.outer_select(["feature", "reason", "missing_ratio_train", "nunique_train", "dominant_ratio_train"],
                             {"missing_ratio_train", "dominant_ratio_train"}, "f"))


def q_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.modeling_quality_report(_train(spark, sf), "c_custkey", "TARGET", 0.95))


def sql_quality_report() -> str:
    return (f"WITH {_mart_cte()}, tr AS (SELECT * FROM mart WHERE TARGET IS NOT NULL), "
            f"s AS ({_stats_sql('tr', _feature_cols())}), "
            "r AS (SELECT variable AS feature, null_count / rows AS missing_ratio_train, dtype, nunique AS nunique_train "
            "FROM s WHERE null_count / rows <= 0.95 AND nunique_with_null > 1) "
            + S.outer_select(["feature", "missing_ratio_train", "dtype", "nunique_train"], {"missing_ratio_train"}, "r"))


# --- F1 overview, E11, E12, E14 ------------------------------------------------------------------
def q_overview(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.overview(T.table(spark, sf, "lineitem")))


def sql_overview() -> str:
    return ("WITH a AS (SELECT (SELECT count(*) FROM lineitem) AS n_rows, "
            "(SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_distinct), "
            "r AS (SELECT n_rows, 11 AS n_columns, n_rows - n_distinct AS duplicates, "
            "CASE WHEN n_rows > 0 THEN (n_rows - n_distinct) * 100.0 / n_rows ELSE 0.0 END AS pct_duplicates FROM a) "
            + S.outer_select(["n_rows", "n_columns", "duplicates", "pct_duplicates"], {"pct_duplicates"}, "r"))


def q_class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.class_distribution(T.application(spark, sf), "TARGET"))


def sql_class_distribution() -> str:
    return (f"WITH c AS (SELECT TARGET, count(*) AS count FROM {T.APPLICATION_SQL} GROUP BY TARGET), "
            "r AS (SELECT TARGET, count, count / sum(count) OVER () AS share FROM c) "
            + S.outer_select(["TARGET", "count", "share"], {"share"}, "r"))


_MEDIAN_COLS = ["ORD_o_totalprice_MEAN", "ORD_o_totalprice_SUM", "ORD_COUNT", "ORD_DAYS_ORDER_MEAN",
                "ACTIVE_o_totalprice_SUM", "EVT_value_MEAN", "NEW_ACTIVE_RATE", "NEW_LINES_PER_ORDER"]


def q_median_by_class(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(P.median_by_class(_mart(spark, sf), "TARGET", _MEDIAN_COLS))


def sql_median_by_class() -> str:
    parts = [f"SELECT '{c}' AS variable, quantile_cont(CAST({S.q(c)} AS DOUBLE), 0.5) FILTER (WHERE TARGET = 0) AS median_0, "
             f"quantile_cont(CAST({S.q(c)} AS DOUBLE), 0.5) FILTER (WHERE TARGET = 1) AS median_1 FROM mart"
             for c in _MEDIAN_COLS]
    return (f"WITH {_mart_cte()}, s AS ({_union(parts)}), r AS (SELECT *, median_1 - median_0 AS gap, "
            "abs(median_1 - median_0) AS abs_gap FROM s) "
            + S.outer_select(["variable", "median_0", "median_1", "gap", "abs_gap"],
                             {"median_0", "median_1", "gap", "abs_gap"}, "r"))


def q_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.value_counts(T.table(spark, sf, "orders"), "o_orderpriority")


def sql_value_counts() -> str:
    return "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority"


def q_dtype_counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.dtype_counts(_mart(spark, sf))


def sql_dtype_counts() -> str:
    parts = [f"SELECT {_TYPE_SQL.format(c=S.q(c))} AS dtype FROM mart" for c in FE.mart_columns()]
    return f"WITH {_mart_cte()}, t AS ({_union(parts)}) SELECT dtype, count(*) AS count FROM t GROUP BY dtype"


# --- A3 / A4 (schema / file listing: rows-only checks) -------------------------------------------------
KEYS = {"customer": ("c_custkey", None), "orders": ("o_orderkey", "o_custkey"),
        "lineitem": (None, "l_orderkey"), "events": ("event_id", "user_id")}


def q_source_overview(spark: SparkSession, sf: str) -> DataFrame:
    return P.source_overview({t: T.table(spark, sf, t) for t in T.TABLES}, KEYS)


def sql_source_overview() -> str:
    parts = []
    for t in T.TABLES:
        main, parent = KEYS.get(t, (None, None))
        mk = f"'{main}'" if main else "NULL::VARCHAR"
        pk = f"'{parent}'" if parent else "NULL::VARCHAR"
        parts.append(
            f"SELECT '{t}' AS \"table\", "
            f"(SELECT CAST(count(*) AS INTEGER) FROM information_schema.columns WHERE table_name = '{t}') AS n_columns, "
            f"{mk} AS main_key, {pk} AS parent_key, "
            f"(SELECT count(*) > 0 FROM information_schema.columns WHERE table_name = '{t}' AND column_name = 'TARGET') "
            f"AS has_target, (SELECT string_agg(column_name, ', ' ORDER BY ordinal_position) FROM information_schema.columns "
            f"WHERE table_name = '{t}' AND ordinal_position <= 8) AS first_columns, "
            f"(SELECT count(*) FROM {t}) AS n_rows")
    return _union(parts)


def q_file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    reg = {t: f"{sf.rstrip('/')}/{t}.parquet" for t in T.TABLES}
    reg["application_test"] = f"{sf.rstrip('/')}/application_test.csv"  # absent on purpose: exists = false
    return file_inventory(spark, reg)


QUERIES = {
    "profile_columns": q_profile_columns, "numeric_completeness": q_numeric_completeness,
    "iqr_outliers": q_iqr_outliers, "moments": q_moments, "top_modality": q_top_modality,
    "temporal_summary": q_temporal_summary, "missing_table": q_missing_table,
    "duplicate_report": q_duplicate_report, "grain_report": q_grain_report, "low_info": q_low_info,
    "quasi_constant": q_quasi_constant, "quality_report": q_quality_report, "overview": q_overview,
    "class_distribution": q_class_distribution, "median_by_class": q_median_by_class,
    "value_counts": q_value_counts, "dtype_counts": q_dtype_counts,
    "source_overview": q_source_overview, "file_inventory": q_file_inventory,
}
ORACLES = {
    "profile_columns": sql_profile_columns, "numeric_completeness": sql_numeric_completeness,
    "iqr_outliers": sql_iqr_outliers, "moments": sql_moments, "top_modality": sql_top_modality,
    "temporal_summary": sql_temporal_summary, "missing_table": sql_missing_table,
    "duplicate_report": sql_duplicate_report, "grain_report": sql_grain_report, "low_info": sql_low_info,
    "quasi_constant": sql_quasi_constant, "quality_report": sql_quality_report, "overview": sql_overview,
    "class_distribution": sql_class_distribution, "median_by_class": sql_median_by_class,
    "value_counts": sql_value_counts, "dtype_counts": sql_dtype_counts, "source_overview": sql_source_overview,
}
