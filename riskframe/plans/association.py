"""Registered queries of the association layer (G1-G12, D5, D7) and their
DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import sig_round_doubles
from ..operators import assoc as G
from ..operators.joins import keep_members
from . import sqlgen as S
from . import tables as T
from .profiling import _mart, _mart_cte, _union

_NUM = ["ORD_o_totalprice_MEAN", "ORD_o_totalprice_SUM", "ORD_o_totalprice_VAR", "ORD_COUNT",
        "ORD_DAYS_ORDER_MEAN", "ACTIVE_o_totalprice_SUM", "CLOSED_COUNT", "EVT_value_MEAN", "EVT_COUNT",
        "NEW_ACTIVE_RATE", "NEW_LINES_PER_ORDER", "c_nationkey"]
_CAT = ["c_mktsegment", "n_regionkey", "c_nationkey", "HAS_EVENTS", "HAS_CLOSED"]


def _x(c):
    return f"CAST({S.q(c)} AS DOUBLE)"


# --- G1 corr_target -----------------------------------------------------------------
def q_corr_target(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(G.target_correlations(_mart(spark, sf), "TARGET", _NUM))


def _corr_sql(cols) -> str:
    parts = []
    for c in cols:
        x, y = _x(c), "CAST(TARGET AS DOUBLE)"
        w = f"{x} IS NOT NULL AND TARGET IS NOT NULL"
        parts.append(
            f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {w}) AS non_null_count, "
            f"covar_pop({x}, {y}) FILTER (WHERE {w}) AS cv, stddev_pop({x}) FILTER (WHERE {w}) AS sx, "
            f"stddev_pop({y}) FILTER (WHERE {w}) AS sy FROM mart")
    return (f"SELECT variable, CASE WHEN non_null_count >= 2 THEN cv / nullif(sx * sy, 0) END AS corr, "
            f"abs(CASE WHEN non_null_count >= 2 THEN cv / nullif(sx * sy, 0) END) AS abs_corr, non_null_count "
            f"FROM ({_union(parts)})")


def sql_corr_target() -> str:
    return (f"WITH {_mart_cte()}, r AS ({_corr_sql(_NUM)}) "
            + S.outer_select(["variable", "corr", "abs_corr", "non_null_count"], {"corr", "abs_corr"}, "r"))


# --- G2 numeric_report, G3 informative_select -----------------------------------------------
def q_numeric_report(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(G.numeric_target_report(_mart(spark, sf, True), "TARGET", _NUM))


def _numeric_report_sql() -> str:
    stats = _union([f"SELECT '{c}' AS variable, (count(*) - count({S.q(c)})) / count(*) AS missing_ratio, "
                    f"count(DISTINCT {S.q(c)}) AS nunique FROM mart" for c in _NUM])
    med = _union([f"SELECT '{c}' AS variable, quantile_cont({_x(c)}, 0.5) FILTER (WHERE TARGET = 0) AS median_0, "
                  f"quantile_cont({_x(c)}, 0.5) FILTER (WHERE TARGET = 1) AS median_1 FROM mart" for c in _NUM])
    return (f"SELECT s.variable, c.corr, c.abs_corr, s.missing_ratio, s.nunique, m.median_0, m.median_1, "
            f"m.median_1 - m.median_0 AS gap, abs(m.median_1 - m.median_0) AS abs_gap "
            f"FROM ({stats}) s JOIN ({_corr_sql(_NUM)}) c ON s.variable = c.variable "
            f"LEFT JOIN ({med}) m ON s.variable = m.variable WHERE s.nunique > 2")


_REPORT_COLS = ["variable", "corr", "abs_corr", "missing_ratio", "nunique", "median_0", "median_1", "gap", "abs_gap"]
_REPORT_DBL = {"corr", "abs_corr", "missing_ratio", "median_0", "median_1", "gap", "abs_gap"}


def sql_numeric_report() -> str:
    return f"WITH {_mart_cte()}, r AS ({_numeric_report_sql()}) " + S.outer_select(_REPORT_COLS, _REPORT_DBL, "r")


def q_informative_select(spark: SparkSession, sf: str) -> DataFrame:
    rep = G.numeric_target_report(_mart(spark, sf, True), "TARGET", _NUM)
    return sig_round_doubles(G.select_informative(rep, 0.05, 5, 0.40, 10))


def sql_informative_select() -> str:
    return (f"WITH {_mart_cte()}, rep AS ({_numeric_report_sql()}), "
            "f AS (SELECT * FROM rep WHERE abs_corr >= 0.05 AND missing_ratio <= 0.40 AND nunique >= 10), "
            "pick AS (SELECT * FROM f UNION ALL SELECT * FROM rep WHERE NOT EXISTS (SELECT 1 FROM f)), "
            "r AS (SELECT * FROM pick ORDER BY abs_corr DESC NULLS LAST, variable LIMIT 5) "
            + S.outer_select(_REPORT_COLS, _REPORT_DBL, "r"))


# --- G12 coverage_filter (+ D7 membership semi-join) -------------------------------------------
_ENGINEERED = [c for c in _NUM if c.startswith(("NEW_", "ORD_", "EVT_"))]


def q_coverage_filter(spark: SparkSession, sf: str) -> DataFrame:
    rep = G.coverage_filtered_correlations(_mart(spark, sf, True), "TARGET", _NUM, 0.60, 500, 0.10)
    eng = spark.createDataFrame([(c,) for c in _ENGINEERED], "variable string")
    return sig_round_doubles(keep_members(rep, eng, "variable"))


def sql_coverage_filter() -> str:
    stats = _union([f"SELECT '{c}' AS variable, (count(*) - count({S.q(c)})) / count(*) AS missing_ratio, "
                    f"count(*) AS rows FROM mart" for c in _NUM])
    eng = ", ".join(f"'{c}'" for c in _ENGINEERED)
    return (f"WITH {_mart_cte()}, r AS (SELECT c.variable, c.corr, c.abs_corr, s.missing_ratio, c.non_null_count "
            f"FROM ({_corr_sql(_NUM)}) c JOIN ({stats}) s ON c.variable = s.variable "
            f"WHERE s.missing_ratio <= 0.60 AND c.non_null_count >= greatest(500.0, 0.10 * s.rows) "
            f"AND c.variable IN ({eng})) "
            + S.outer_select(["variable", "corr", "abs_corr", "missing_ratio", "non_null_count"],
                             {"corr", "abs_corr", "missing_ratio"}, "r"))


# --- G4 spearman ----------------------------------------------------------------------
_SP_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "DAYS_SHIP"]


def _sp_frame(spark, sf):
    li = T.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                     F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax",
                     T.day_offset("l_shipdate").alias("DAYS_SHIP"))


def q_spearman(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(G.spearman_matrix(_sp_frame(spark, sf), _SP_COLS,
                                               ["l_orderkey", "l_linenumber", "l_partkey"]))


def sql_spearman() -> str:
    src = ("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, "
           "l_tax, CAST(CAST(l_shipdate AS DATE) - DATE '2002-01-01' AS INTEGER) AS DAYS_SHIP FROM lineitem")
    parts = []
    for i, a in enumerate(_SP_COLS):
        for b in _SP_COLS[i + 1:]:
            parts.append(
                f"SELECT '{a}' AS var_a, '{b}' AS var_b, count(*) AS n, "
                f"covar_pop(ra, rb) AS c, stddev_pop(ra) AS sa, stddev_pop(rb) AS sb FROM ("
                f"SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra, "
                f"rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb "
                f"FROM s WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")
    return (f"WITH s AS ({src}), g AS ({_union(parts)}), r AS (SELECT var_a, var_b, "
            "CASE WHEN n >= 2 THEN c / nullif(sa * sb, 0) END AS spearman, n FROM g) "
            + S.outer_select(["var_a", "var_b", "spearman", "n"], {"spearman"}, "r"))


# --- G5-G7 chi2_cramers ------------------------------------------------------------------
def _cat_frame(spark, sf):
    m = _mart(spark, sf)
    return m.select("TARGET", "c_mktsegment", "n_regionkey", "c_nationkey",
                    F.col("EVT_COUNT").isNotNull().cast("int").alias("HAS_EVENTS"),
                    F.col("CLOSED_COUNT").isNotNull().cast("int").alias("HAS_CLOSED"))


_CAT_SRC = ("SELECT TARGET, c_mktsegment, n_regionkey, c_nationkey, CAST(EVT_COUNT IS NOT NULL AS INTEGER) AS HAS_EVENTS, "
            "CAST(CLOSED_COUNT IS NOT NULL AS INTEGER) AS HAS_CLOSED FROM mart")


def q_chi2_cramers(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(G.categorical_association(_cat_frame(spark, sf), _CAT, "TARGET"))


def _pvalue_sql(x: str, dof: str) -> str:
    """Upper chi-square tail in closed form.  Even dof: e^-z sum z^k / k! for
    k < dof/2.  Odd dof: erfc(sqrt z) plus e^-z sum z^(k-1/2) / Gamma(k+1/2) for
    k <= (dof-1)/2.  erfc: its power series below 1, above it the integral
    (2 y e^-y^2 / pi) int_0^inf e^-t^2 / (t^2 + y^2) dt by the trapezoidal rule,
    whose error falls exponentially with the step."""
    z = f"({x} / 2.0)"
    y = f"sqrt({z})"
    even = f"(SELECT sum(exp(t.i * ln({z}) - {z} - lgamma(t.i + 1))) FROM range(0, CAST({dof} / 2 AS BIGINT)) t(i))"
    tail = (f"coalesce((SELECT sum(exp((t.i - 0.5) * ln({z}) - {z} - lgamma(t.i + 0.5))) "
            f"FROM range(1, CAST(({dof} - 1) / 2 AS BIGINT) + 1) t(i)), 0.0)")
    small = (f"1.0 - 2.0 / sqrt(pi()) * (SELECT sum(CASE WHEN t.i % 2 = 0 THEN 1.0 ELSE -1.0 END * "
             f"pow({y}, 2 * t.i + 1) / (exp(lgamma(t.i + 1)) * (2 * t.i + 1))) FROM range(0, 40) t(i))")
    large = (f"2.0 * {y} * exp(-{z}) / pi() * 0.05 * (SELECT sum(CASE WHEN t.i = 0 THEN 0.5 ELSE 1.0 END * "
             f"exp(-pow(0.05 * t.i, 2)) / (pow(0.05 * t.i, 2) + {z})) FROM range(0, 160) t(i))")
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {z} <= 0 THEN 1.0 "
            f"WHEN CAST({dof} AS BIGINT) % 2 = 0 THEN {even} "
            f"ELSE (CASE WHEN {z} < 1 THEN {small} ELSE {large} END) + {tail} END")


def sql_chi2_cramers() -> str:
    cells = _union([f"SELECT '{c}' AS variable, coalesce(CAST({c} AS VARCHAR), '__MISSING__') AS value, TARGET AS y, "
                    f"count(*) AS o FROM cs WHERE TARGET IS NOT NULL GROUP BY ALL" for c in _CAT])
    return (f"WITH {_mart_cte()}, cs AS ({_CAT_SRC}), cells AS ({cells}), "
            "rt AS (SELECT variable, value, sum(o) AS ri FROM cells GROUP BY ALL), "
            "ct AS (SELECT variable, y, sum(o) AS cj FROM cells GROUP BY ALL), "
            "dims AS (SELECT variable, count(*) AS k, sum(cj) AS n FROM ct GROUP BY ALL), "
            "dr AS (SELECT variable, count(*) AS r FROM rt GROUP BY ALL), "
            "grid AS (SELECT rt.variable, rt.value, ct.y, rt.ri, ct.cj, coalesce(cells.o, 0) AS o FROM rt "
            "JOIN ct ON rt.variable = ct.variable LEFT JOIN cells ON cells.variable = rt.variable "
            "AND cells.value = rt.value AND cells.y = ct.y), "
            "t AS (SELECT g.variable, d.n, d.k, r.r, g.o, g.ri * g.cj / d.n AS e FROM grid g "
            "JOIN dims d ON g.variable = d.variable JOIN dr r ON g.variable = r.variable), "
            "t2 AS (SELECT *, CASE WHEN r = 2 AND k = 2 THEN o + sign(e - o) * least(0.5, abs(e - o)) ELSE o END AS oa "
            "FROM t), "
            "chi AS (SELECT variable, any_value(n) AS n, any_value(k) AS k, any_value(r) AS r, "
            "sum((oa - e) * (oa - e) / e) AS chi2 FROM t2 GROUP BY variable), "
            "v AS (SELECT variable, chi2, r AS nb_modalities, (r - 1) * (k - 1) AS dof, "
            "CASE WHEN n > 1 AND least(k - (k - 1) * (k - 1) / (n - 1.0) - 1, r - (r - 1) * (r - 1) / (n - 1.0) - 1) > 0 "
            "THEN sqrt(greatest(0.0, chi2 / n - (k - 1) * (r - 1) / (n - 1.0)) / "
            "least(k - (k - 1) * (k - 1) / (n - 1.0) - 1, r - (r - 1) * (r - 1) / (n - 1.0) - 1)) END AS cramers_v "
            "FROM chi WHERE r >= 2 AND k >= 2), "
            f"r AS (SELECT variable, chi2, {_pvalue_sql('chi2', 'CAST(dof AS DOUBLE)')} AS p_value, "
            "nb_modalities, CAST(dof AS BIGINT) AS dof, cramers_v FROM v) "
            + S.outer_select(["variable", "chi2", "p_value", "nb_modalities", "dof", "cramers_v"],
                             {"chi2", "p_value", "cramers_v"}, "r"))


# --- G8 flag_gap, G9 modality_gap, G10 supported_gaps, G11 riskiest ------------------------------------
_GAP_COLS = ["variable", "modality", "n_obs", "share_obs", "n_target_1", "target_rate", "gap_vs_global",
             "ratio_vs_global", "abs_gap"]
_GAP_DBL = {"share_obs", "n_target_1", "target_rate", "gap_vs_global", "ratio_vs_global", "abs_gap"}


def _gaps_sql(src: str, cols) -> str:
    g = _union([f"SELECT '{c}' AS variable, coalesce(CAST({S.q(c)} AS VARCHAR), '__MISSING__') AS modality, "
                f"count(*) AS n_obs, count(TARGET) AS ny, sum(CAST(TARGET AS DOUBLE)) AS n_target_1, "
                f"avg(CAST(TARGET AS DOUBLE)) AS target_rate FROM {src} GROUP BY ALL" for c in cols])
    return (f"SELECT variable, modality, n_obs, n_obs / sum(n_obs) OVER (PARTITION BY variable) AS share_obs, "
            f"n_target_1, target_rate, target_rate - sum(n_target_1) OVER (PARTITION BY variable) / "
            f"sum(ny) OVER (PARTITION BY variable) AS gap_vs_global, "
            f"CASE WHEN sum(n_target_1) OVER (PARTITION BY variable) / sum(ny) OVER (PARTITION BY variable) > 0 THEN "
            f"target_rate / (sum(n_target_1) OVER (PARTITION BY variable) / sum(ny) OVER (PARTITION BY variable)) END "
            f"AS ratio_vs_global, abs(target_rate - sum(n_target_1) OVER (PARTITION BY variable) / "
            f"sum(ny) OVER (PARTITION BY variable)) AS abs_gap FROM ({g})")


def q_modality_gap(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(G.modality_gaps(_cat_frame(spark, sf), ["c_mktsegment", "n_regionkey"], "TARGET"))


def sql_modality_gap() -> str:
    return (f"WITH {_mart_cte()}, cs AS ({_CAT_SRC}), r AS ({_gaps_sql('cs', ['c_mktsegment', 'n_regionkey'])}) "
            + S.outer_select(_GAP_COLS, _GAP_DBL, "r"))


_FLAG_SRC_COLS = ["TARGET", "c_mktsegment", "HAS_EVENTS", "HAS_CLOSED", "ORD_COUNT", "EVT_COUNT"]


def _flag_frame(spark, sf):
    m = _mart(spark, sf, True)
    return m.select("TARGET", "c_mktsegment", F.col("EVT_COUNT").isNotNull().cast("int").alias("HAS_EVENTS"),
                    F.col("CLOSED_COUNT").isNotNull().cast("int").alias("HAS_CLOSED"), "ORD_COUNT",
                    F.when(F.col("EVT_COUNT") > 70, F.lit("many")).when(F.col("EVT_COUNT").isNotNull(), F.lit("few"))
                    .alias("EVT_LEVEL"))


_FLAG_SRC = ("SELECT TARGET, c_mktsegment, CAST(EVT_COUNT IS NOT NULL AS INTEGER) AS HAS_EVENTS, "
             "CAST(CLOSED_COUNT IS NOT NULL AS INTEGER) AS HAS_CLOSED, ORD_COUNT, "
             "CASE WHEN EVT_COUNT > 70 THEN 'many' WHEN EVT_COUNT IS NOT NULL THEN 'few' END AS EVT_LEVEL FROM mart")
_FLAG_ALL = ["c_mktsegment", "HAS_EVENTS", "HAS_CLOSED", "ORD_COUNT", "EVT_LEVEL"]


def q_flag_gap(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(G.binary_flag_gaps(_flag_frame(spark, sf), "TARGET"))


def sql_flag_gap() -> str:
    nun = _union([f"SELECT '{c}' AS variable, count(DISTINCT {c}) AS nu FROM fs" for c in _FLAG_ALL])
    return (f"WITH {_mart_cte()}, fs AS ({_FLAG_SRC}), nun AS ({nun}), g AS ({_gaps_sql('fs', _FLAG_ALL)}), "
            "r AS (SELECT g.* FROM g JOIN nun ON g.variable = nun.variable WHERE nun.nu = 2) "
            + S.outer_select(_GAP_COLS, _GAP_DBL, "r"))


def q_supported_gaps(spark: SparkSession, sf: str) -> DataFrame:
    gaps = G.modality_gaps(_cat_frame(spark, sf), ["c_nationkey", "c_mktsegment"], "TARGET")
    return sig_round_doubles(G.supported_gaps(gaps, 60, 0.01, 10))


def sql_supported_gaps() -> str:
    return (f"WITH {_mart_cte()}, cs AS ({_CAT_SRC}), g AS ({_gaps_sql('cs', ['c_nationkey', 'c_mktsegment'])}), "
            "f AS (SELECT * FROM g WHERE n_obs >= 60 AND abs_gap >= 0.01), "
            "r AS (SELECT * FROM f UNION ALL SELECT * FROM (SELECT * FROM g ORDER BY abs_gap DESC NULLS LAST, "
            "n_obs DESC, variable, modality LIMIT 10) WHERE NOT EXISTS (SELECT 1 FROM f)) "
            + S.outer_select(_GAP_COLS, _GAP_DBL, "r"))


def q_riskiest(spark: SparkSession, sf: str) -> DataFrame:
    gaps = G.modality_gaps(_cat_frame(spark, sf), ["c_nationkey", "c_mktsegment", "n_regionkey"], "TARGET")
    top = G.riskiest(gaps, 10).withColumn("side", F.lit("risky"))
    low = G.riskiest(gaps, 10, protective=True).withColumn("side", F.lit("protective"))
    return sig_round_doubles(top.unionByName(low))


def sql_riskiest() -> str:
    cols = ["c_nationkey", "c_mktsegment", "n_regionkey"]
    return (f"WITH {_mart_cte()}, cs AS ({_CAT_SRC}), g AS ({_gaps_sql('cs', cols)}), "
            "r AS (SELECT *, 'risky' AS side FROM (SELECT * FROM g ORDER BY gap_vs_global DESC, n_obs DESC, variable, "
            "modality LIMIT 10) UNION ALL SELECT *, 'protective' FROM (SELECT * FROM g ORDER BY gap_vs_global ASC, "
            "n_obs DESC, variable, modality LIMIT 10)) "
            + S.outer_select(_GAP_COLS + ["side"], _GAP_DBL, "r"))


QUERIES = {
    "corr_target": q_corr_target, "numeric_report": q_numeric_report, "informative_select": q_informative_select,
    "coverage_filter": q_coverage_filter, "spearman": q_spearman, "chi2_cramers": q_chi2_cramers,
    "modality_gap": q_modality_gap, "flag_gap": q_flag_gap, "supported_gaps": q_supported_gaps,
    "riskiest": q_riskiest,
}
ORACLES = {
    "corr_target": sql_corr_target, "numeric_report": sql_numeric_report,
    "informative_select": sql_informative_select, "coverage_filter": sql_coverage_filter,
    "spearman": sql_spearman, "chi2_cramers": sql_chi2_cramers, "modality_gap": sql_modality_gap,
    "flag_gap": sql_flag_gap, "supported_gaps": sql_supported_gaps, "riskiest": sql_riskiest,
}
