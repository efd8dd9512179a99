"""Registered queries for the remaining report-level operators (B16, B17,
B22, C8, D6, F14, F17, K11, K21, K23, K27, I5) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.rounding import sig_round_doubles
from ..operators import encode as E
from ..operators import metrics as K
from ..operators import profile as P
from ..operators import split as H
from ..operators.joins import lookup_with_default
from ..session import cut_lineage
from ..operators.rank import arg_max  # noqa: F401 (I5 helper, see top_client)
from . import evaluation as V
from . import features as FE
from . import sqlgen as S
from . import tables as T
from .profiling import _mart, _mart_cte, _union


# --- B6-B9 application_ratios -------------------------------------------------------------
# Roles of the reference's application columns, played by mart columns.
RATIO_ROLES = {
    "AMT_CREDIT": "ORD_o_totalprice_SUM", "AMT_ANNUITY": "ORD_o_totalprice_MEAN",
    "AMT_GOODS_PRICE": "ACTIVE_o_totalprice_SUM", "AMT_INCOME_TOTAL": "EVT_value_SUM",
    "CNT_FAM_MEMBERS": "ORD_COUNT", "DAYS_EMPLOYED": "CLOSED_DAYS_ORDER_MEAN", "DAYS_BIRTH": "ORD_DAYS_ORDER_MIN",
    "DAYS_LAST_PHONE_CHANGE": "ACTIVE_DAYS_ORDER_MAX", "DAYS_ID_PUBLISH": "ORD_DAYS_ORDER_MAX",
}
SCORE_SOURCES = ["ORD_o_orderstatus_F_MEAN", "ACTIVE_l_quantity_SIZE_MEAN", "EVT_event_type_click_MEAN"]


def q_application_ratios(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.ratios import APPLICATION_RATIOS, add_application_ratios, add_score_summary
    m = _mart(spark, sf)
    out = add_score_summary(add_application_ratios(m, RATIO_ROLES), SCORE_SOURCES)
    return sig_round_doubles(out.select("c_custkey", *[n for n, _, _ in APPLICATION_RATIOS],
                                        "EXT_SOURCES_MEAN", "EXT_SOURCES_STD"))


def sql_application_ratios() -> str:
    from ..operators.ratios import APPLICATION_RATIOS
    rat = ", ".join(f"{S.safe_div_sql(S.q(RATIO_ROLES[a]), S.q(RATIO_ROLES[b]))} AS {n}" for n, a, b in APPLICATION_RATIOS)
    lst = f"list_filter([{', '.join(S.q(c) for c in SCORE_SOURCES)}], lambda x: x IS NOT NULL)"
    mean = f"CASE WHEN len({lst}) > 0 THEN list_sum({lst}) / len({lst}) END"
    std = (f"CASE WHEN len({lst}) >= 2 THEN sqrt(list_sum(list_transform({lst}, lambda x: (x - list_sum({lst}) / len({lst})) "
           f"* (x - list_sum({lst}) / len({lst})))) / (len({lst}) - 1)) END")
    names = [n for n, _, _ in APPLICATION_RATIOS]
    return (f"WITH {_mart_cte()}, a AS (SELECT c_custkey, {rat}, {mean} AS EXT_SOURCES_MEAN, {std} AS EXT_SOURCES_STD "
            "FROM mart), med AS (SELECT quantile_cont(EXT_SOURCES_STD, 0.5) AS m FROM a), "
            f"r AS (SELECT c_custkey, {', '.join(names)}, EXT_SOURCES_MEAN, coalesce(EXT_SOURCES_STD, m) AS EXT_SOURCES_STD "
            "FROM a, med) " + S.outer_select(["c_custkey"] + names + ["EXT_SOURCES_MEAN", "EXT_SOURCES_STD"],
                                            set(names) | {"EXT_SOURCES_MEAN", "EXT_SOURCES_STD"}, "r"))


# --- B16 text_booleans -------------------------------------------------------------------
def _text_frame(spark, sf):
    lab = T.table(spark, sf, "labels")
    d = T.table(spark, sf, "documents").select("doc_id", "lang")
    return lab.join(d, "doc_id").select(
        "doc_id", F.when(F.col("quality") == 1, " True").otherwise("false ").alias("q_txt"),
        F.when(F.col("toxic") == 1, "TRUE").otherwise("False").alias("t_txt"), "lang")


def q_text_booleans(spark: SparkSession, sf: str) -> DataFrame:
    df = _text_frame(spark, sf)
    keep, drop = E.fit_text_booleans(df, columns=["q_txt", "t_txt", "lang"])
    return E.apply_text_booleans(df, keep, drop)


def sql_text_booleans() -> str:
    return ("SELECT l.doc_id, CAST(CASE WHEN l.quality = 1 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS q_txt, "
            "CAST(CASE WHEN l.toxic = 1 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS t_txt FROM labels l JOIN documents d "
            "ON l.doc_id = d.doc_id")


# --- B17 sanitized_mart ------------------------------------------------------------------
def q_sanitized_mart(spark: SparkSession, sf: str) -> DataFrame:
    return X.sanitize_columns(FE.q_client_feature_mart(spark, sf))


def sql_sanitized_mart() -> str:
    cols = FE.mart_columns()
    names = X.sanitize_names(cols)
    return f"WITH {_mart_cte()} SELECT " + ", ".join(f"{S.q(c)} AS {S.q(n)}" for c, n in zip(cols, names)) + " FROM mart"


# --- B22 minmax_score --------------------------------------------------------------------
def q_minmax_score(spark: SparkSession, sf: str) -> DataFrame:
    s = T.labelled_scores(spark, sf).withColumn("score", F.col("score") * 3 - 0.25)
    return sig_round_doubles(E.minmax_scale(s, "score", "score_scaled"))


def sql_minmax_score() -> str:
    return (f"WITH s AS (SELECT id, y, score * 3 - 0.25 AS score FROM {T.SCORES_SQL}), "
            "m AS (SELECT min(score) AS mn, max(score) AS mx FROM s), "
            "r AS (SELECT id, y, score, (score - mn) / (mx - mn + 1e-12) AS score_scaled FROM s, m) "
            + S.outer_select(["id", "y", "score", "score_scaled"], {"score", "score_scaled"}, "r"))


# --- C8 class_weights --------------------------------------------------------------------
def q_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    train = H.split_on_target(T.application(spark, sf))[0]
    w = E.balanced_class_weight(train, "TARGET")
    return sig_round_doubles(w.groupBy("TARGET", "weight").agg(F.count(F.lit(1)).alias("n")))


def sql_class_weights() -> str:
    return (f"WITH t AS (SELECT TARGET FROM {T.APPLICATION_SQL} WHERE TARGET IS NOT NULL), "
            "c AS (SELECT TARGET, count(*) AS n FROM t GROUP BY TARGET), "
            "r AS (SELECT TARGET, sum(n) OVER () / (count(*) OVER () * n) AS weight, n FROM c) "
            + S.outer_select(["TARGET", "weight", "n"], {"weight"}, "r"))


# --- D6 catalog_lookup (K20 + catalog) -------------------------------------------------------
FAMILIES = [("length", "length rule", "candidate"), ("coarse", "binned rule", "baseline")]


def q_catalog_lookup(spark: SparkSession, sf: str) -> DataFrame:
    board = K.leaderboard(V._results(spark, sf)).select("model", "rank", "business_cost_per_obs")
    cat = spark.createDataFrame(FAMILIES, "model string, family string, scope string")
    return sig_round_doubles(lookup_with_default(board, cat, "model", {"family": "unknown", "scope": "unknown"}))


def sql_catalog_lookup() -> str:
    vals = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in FAMILIES)
    return (f"WITH b AS ({V.sql_leaderboard()}), cat AS (SELECT * FROM (VALUES {vals}) t(model, family, scope)) "
            "SELECT b.model, b.rank, b.business_cost_per_obs, coalesce(cat.family, 'unknown') AS family, "
            "coalesce(cat.scope, 'unknown') AS scope FROM b LEFT JOIN cat ON b.model = cat.model")


# --- F14 encoding_summary, F17 residual_nulls --------------------------------------------------
def q_encoding_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The seven counts of the encoding step: raw text columns, text columns
    left, train and test rows, final columns, engineered columns, columns that
    the train-based pruning removes."""
    app = T.application(spark, sf)
    raw_cat = X.categorical_columns(app)
    mart = cut_lineage(FE.q_client_feature_mart(spark, sf))
    enc, _ = E.one_hot_encode(mart, E.fit_vocabulary(mart, raw_cat, max_categories=T.MAX_DUMMIES))
    sizes = mart.agg(F.count("TARGET").alias("train"), F.count_if(F.col("TARGET").isNull()).alias("test")).first()
    removed = P.train_pruning_report(mart.where(F.col("TARGET").isNotNull()), ["c_custkey", "TARGET"], 0.995).count()
    rows = [("raw_categorical_columns", len(raw_cat)), ("text_columns_after_encoding", len(X.categorical_columns(enc))),
            ("train_rows", sizes["train"]), ("test_rows", sizes["test"]), ("columns_after_encoding", len(enc.columns)),
            ("engineered_columns", len([c for c in enc.columns if c not in app.columns])), ("columns_removed", removed)]
    return spark.createDataFrame(rows, "metric string, value long")


def sql_encoding_summary() -> str:
    from .profiling import sql_quasi_constant
    segments = "(SELECT count(DISTINCT c_mktsegment) + 1 FROM customer)"
    kept = len(FE.mart_columns()) - 1
    return (f"WITH a AS {T.APPLICATION_SQL} SELECT * FROM (VALUES ('raw_categorical_columns', 1), ('text_columns_after_encoding', 0), "
            "('train_rows', (SELECT count(TARGET) FROM a)), ('test_rows', (SELECT count(*) - count(TARGET) FROM a)), "
            f"('columns_after_encoding', {kept} + {segments}), ('engineered_columns', {kept} - 4 + {segments}), "
            f"('columns_removed', (SELECT count(*) FROM ({sql_quasi_constant()})))) t(metric, value)")


_IMPUTE_COLS = ["ORD_o_totalprice_VAR", "ACTIVE_o_totalprice_SUM", "CLOSED_DAYS_ORDER_MEAN", "EVT_value_MEAN",
                "EVT_value_VAR", "NEW_EVT_VALUE_PER_ORDER", "NEW_CLOSED_RATE"]


def q_residual_nulls(spark: SparkSession, sf: str) -> DataFrame:
    mart = _mart(spark, sf, True)
    train = mart.where(F.col("TARGET").isNotNull())
    imp = E.MedianImputer(_IMPUTE_COLS).fit(train)
    filled = imp.transform(mart)
    P.assert_no_nulls(filled, _IMPUTE_COLS)
    counts = filled.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in _IMPUTE_COLS])
    med = spark.createDataFrame([(c, imp.medians[c]) for c in _IMPUTE_COLS], "variable string, median double")
    long = counts.unpivot([], _IMPUTE_COLS, "variable", "null_after")
    return sig_round_doubles(med.join(long, "variable"))


def sql_residual_nulls() -> str:
    parts = [f"SELECT '{c}' AS variable, (SELECT quantile_cont({S.q(c)}, 0.5) FROM mart WHERE TARGET IS NOT NULL) AS median, "
             f"count_if(coalesce({S.q(c)}, (SELECT quantile_cont({S.q(c)}, 0.5) FROM mart WHERE TARGET IS NOT NULL)) IS NULL) "
             f"AS null_after FROM mart" for c in _IMPUTE_COLS]
    return f"WITH {_mart_cte()}, r AS ({_union(parts)}) " + S.outer_select(["variable", "median", "null_after"], {"median"}, "r")


# --- K11 flatten_summary, K23 cv_pivot, K21 recommendation, K27 selection_context -------------------
def q_flatten_summary(spark: SparkSession, sf: str) -> DataFrame:
    fm = V._fold_metrics(spark, sf).withColumn("split", F.lit("valid"))
    # round per metric kind first (std columns carry fewer digits), then flatten
    return K.flatten_summary(sig_round_doubles(K.cv_summary(fm, V._CV_METRICS)))


def sql_flatten_summary() -> str:
    base = V.sql_cv_summary()
    return (f"WITH cv AS ({base}), s AS (SELECT * EXCLUDE (std_kind) FROM cv WHERE std_kind = 'sample'), "
            "u AS (UNPIVOT s ON COLUMNS(* EXCLUDE (split)) INTO NAME metric VALUE value) "
            "SELECT split || '_' || metric AS key, value FROM u")


def q_cv_pivot(spark: SparkSession, sf: str) -> DataFrame:
    d = H.kfold(V._models(spark, sf), ["id"], 3, 42, label=["model", "y"], name="fold")
    per = K.rank_metrics(d, by=["fold", "model"])
    return sig_round_doubles(per.groupBy("fold").pivot("model", ["coarse", "inverse", "length"]).agg(F.first("roc_auc")))


def sql_cv_pivot() -> str:
    h = "md5('42' || ':' || CAST(id AS VARCHAR))"
    return (f"WITH {V._MODELS_SQL}, m2 AS (SELECT *, CAST((row_number() OVER (PARTITION BY model, y ORDER BY {h}, id) - 1) "
            "% 3 AS INTEGER) AS fold FROM models), "
            f"r0 AS ({V._rank_sql('m2', 'fold, model')}), "
            "r AS (SELECT fold, max(roc_auc) FILTER (WHERE model = 'coarse') AS coarse, "
            "max(roc_auc) FILTER (WHERE model = 'inverse') AS inverse, max(roc_auc) FILTER (WHERE model = 'length') AS length "
            "FROM r0 GROUP BY fold) "
            + S.outer_select(["fold", "coarse", "inverse", "length"], {"coarse", "inverse", "length"}, "r"))


def q_recommendation(spark: SparkSession, sf: str) -> DataFrame:
    rec = K.recommendation(K.leaderboard(V._results(spark, sf)))
    return rec.select("best_by_cost", "best_by_fbeta",
                      F.concat_ws(",", F.transform("ranking", lambda x: x["model"])).alias("ranking"))


def sql_recommendation() -> str:
    return (f"WITH b AS ({V.sql_leaderboard()}) SELECT "
            "(SELECT model FROM b ORDER BY business_cost_per_obs, business_fbeta DESC, fit_time_sec, pr_auc DESC, model "
            "LIMIT 1) AS best_by_cost, (SELECT model FROM b ORDER BY business_fbeta DESC, model LIMIT 1) AS best_by_fbeta, "
            "(SELECT string_agg(model, ',' ORDER BY rank) FROM b) AS ranking")


def q_selection_context(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.models import CATALOG, GRIDS
    s = T.labelled_scores(spark, sf)
    fam = {c[0]: c[1] for c in CATALOG}["gbt_leafwise"]
    size = 1
    for v in GRIDS["gbt_leafwise"].values():
        size *= len(v)
    return sig_round_doubles(s.agg(
        F.lit("gbt_leafwise").alias("model"), F.lit(fam).alias("family"), F.lit(size).alias("grid_size"),
        F.count(F.lit(1)).alias("rows"), F.avg((F.col("y") == 1).cast("double")).alias("rate_1"),
        F.avg((F.col("y") == 0).cast("double")).alias("rate_0")))


def sql_selection_context() -> str:
    return (f"WITH r AS (SELECT 'gbt_leafwise' AS model, 'boosting' AS family, 16 AS grid_size, count(*) AS rows, "
            f"avg(CAST(y = 1 AS DOUBLE)) AS rate_1, avg(CAST(y = 0 AS DOUBLE)) AS rate_0 FROM {T.SCORES_SQL}) "
            + S.outer_select(["model", "family", "grid_size", "rows", "rate_1", "rate_0"], {"rate_1", "rate_0"}, "r"))


# --- I5 top_client ---------------------------------------------------------------------------
def q_top_client(spark: SparkSession, sf: str) -> DataFrame:
    m = FE.q_client_feature_mart(spark, sf).select("c_custkey", "ORD_o_totalprice_SUM")
    return m.orderBy(F.col("ORD_o_totalprice_SUM").desc_nulls_last(), "c_custkey").limit(1)


def sql_top_client() -> str:
    return (f"WITH {_mart_cte()} SELECT c_custkey, \"ORD_o_totalprice_SUM\" FROM mart "
            "ORDER BY \"ORD_o_totalprice_SUM\" DESC NULLS LAST, c_custkey LIMIT 1")


QUERIES = {
    "application_ratios": q_application_ratios,
    "text_booleans": q_text_booleans, "sanitized_mart": q_sanitized_mart, "minmax_score": q_minmax_score,
    "class_weights": q_class_weights, "catalog_lookup": q_catalog_lookup, "encoding_summary": q_encoding_summary,
    "residual_nulls": q_residual_nulls, "flatten_summary": q_flatten_summary, "cv_pivot": q_cv_pivot,
    "recommendation": q_recommendation, "selection_context": q_selection_context, "top_client": q_top_client,
}
ORACLES = {
    "application_ratios": sql_application_ratios,
    "text_booleans": sql_text_booleans, "sanitized_mart": sql_sanitized_mart, "minmax_score": sql_minmax_score,
    "class_weights": sql_class_weights, "catalog_lookup": sql_catalog_lookup,
    "encoding_summary": sql_encoding_summary, "residual_nulls": sql_residual_nulls,
    "flatten_summary": sql_flatten_summary, "cv_pivot": sql_cv_pivot, "recommendation": sql_recommendation,
    "selection_context": sql_selection_context, "top_client": sql_top_client,
}
