"""Registered queries of the evaluation layer
and their DuckDB oracles.  Scored rows: documents with a quality label
(y = quality) scored by three fixed rules ("models")."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import label_at
from ..functions.rounding import sig_round_doubles
from ..operators import metrics as K
from ..operators import split as H
from . import sqlgen as S
from . import tables as T

_THR_COLS = ["accuracy", "precision", "recall", "f1", "business_fbeta", "false_negatives", "false_positives",
             "business_cost", "business_cost_per_obs"]
_THR_DBL = {"accuracy", "precision", "recall", "f1", "business_fbeta", "business_cost", "business_cost_per_obs"}


def _models(spark, sf) -> DataFrame:
    s = T.labelled_scores(spark, sf)
    return (s.select(F.lit("length").alias("model"), "id", "y", "score")
            .unionByName(s.select(F.lit("inverse").alias("model"), "id", "y", (1 - F.col("score")).alias("score")))
            .unionByName(s.select(F.lit("coarse").alias("model"), "id", "y",
                                  (F.floor(F.col("score") * 10) / 10).alias("score"))))


_MODELS_SQL = (f"s AS {T.SCORES_SQL}, models AS (SELECT 'length' AS model, id, y, score FROM s UNION ALL "
               "SELECT 'inverse', id, y, 1 - score FROM s UNION ALL SELECT 'coarse', id, y, floor(score * 10) / 10 FROM s)")


def _conf_sql(src: str, thr: str, by: str) -> str:
    g = f"{by}, " if by else ""
    return (f"SELECT {g}count_if({thr} AND y = 1) AS tp, count_if({thr} AND y <> 1) AS fp, "
            f"count_if(NOT ({thr}) AND y <> 1) AS tn, count_if(NOT ({thr}) AND y = 1) AS fn, count(*) AS n "
            f"FROM {src} {'GROUP BY ' + by if by else ''}")


def _metric_sql(fn_cost=10.0, fp_cost=1.0) -> str:
    b2 = fn_cost / fp_cost
    d = lambda a, b: f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"
    p, r = d("tp", "tp + fp"), d("tp", "tp + fn")
    return (f"{d('tp + tn', 'n')} AS accuracy, {p} AS precision, {r} AS recall, "
            f"{d('2 * tp', '2 * tp + fp + fn')} AS f1, {d(f'{1 + b2} * tp', f'{1 + b2} * tp + {b2} * fn + fp')} "
            f"AS business_fbeta, fn AS false_negatives, fp AS false_positives, "
            f"CAST(fn * {fn_cost} + fp * {fp_cost} AS DOUBLE) AS business_cost, "
            f"CAST(fn * {fn_cost} + fp * {fp_cost} AS DOUBLE) / nullif(CAST(n AS DOUBLE), 0) AS business_cost_per_obs")


def _rank_sql(src: str, by: str) -> str:
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return (f"WITH st AS (SELECT {g}CAST(score AS DOUBLE) AS s, CAST(count_if(y = 1) AS DOUBLE) AS pos, "
            f"CAST(count_if(y <> 1) AS DOUBLE) AS neg FROM {src} GROUP BY ALL), "
            f"c AS (SELECT *, sum(pos) OVER ({part} ORDER BY s ROWS UNBOUNDED PRECEDING) AS cp, "
            f"sum(neg) OVER ({part} ORDER BY s ROWS UNBOUNDED PRECEDING) AS cn, sum(pos) OVER ({part}) AS P, "
            f"sum(neg) OVER ({part}) AS N FROM st) "
            f"SELECT {g}CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(pos * (cn - neg + neg / 2)) / (max(P) * max(N)) END "
            f"AS roc_auc, CASE WHEN max(P) > 0 THEN sum(pos * (P - cp + pos) / ((P - cp + pos) + (N - cn + neg))) / max(P) "
            f"END AS pr_auc FROM c {'GROUP BY ' + by if by else ''}")


# --- confusion (K1) / business_metrics (K2-K7) --------------------------------------------
def q_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return K.confusion_counts(_models(spark, sf), threshold=0.5, by=["model"])


def sql_confusion() -> str:
    return f"WITH {_MODELS_SQL} {_conf_sql('models', 'score >= 0.5', 'model')}"


def q_business_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(K.classification_metrics(_models(spark, sf), threshold=0.5, by=["model"]))


def sql_business_metrics() -> str:
    return (f"WITH {_MODELS_SQL}, c AS ({_conf_sql('models', 'score >= 0.5', 'model')}), "
            f"m AS (SELECT model, {_metric_sql()}, 0.5 AS threshold FROM c), r0 AS ({_rank_sql('models', 'model')}), "
            "r AS (SELECT m.*, r0.roc_auc, r0.pr_auc FROM m LEFT JOIN r0 ON m.model = r0.model) "
            + S.outer_select(["model"] + _THR_COLS + ["threshold", "roc_auc", "pr_auc"],
                             _THR_DBL | {"threshold", "roc_auc", "pr_auc"}, "r"))


# --- roc_auc / avg_precision (K4, K5, K7) ---------------------------------------------------
def q_roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(K.rank_metrics(_models(spark, sf), by=["model"]))


def sql_roc_auc() -> str:
    return (f"WITH {_MODELS_SQL}, r AS ({_rank_sql('models', 'model')}) "
            + S.outer_select(["model", "roc_auc", "pr_auc"], {"roc_auc", "pr_auc"}, "r"))


def _by_source(spark, sf):
    d = T.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source")
    return T.labelled_scores(spark, sf).join(d, "id")


_BY_SOURCE_SQL = f"bs AS (SELECT s.*, d.source FROM {T.SCORES_SQL} s JOIN documents d ON s.id = d.doc_id)"


def q_avg_precision(spark: SparkSession, sf: str) -> DataFrame:
    """Per source: some sources hold a single class -> NULL ROC (K7)."""
    return sig_round_doubles(K.rank_metrics(_by_source(spark, sf), by=["source"]))


def sql_avg_precision() -> str:
    return (f"WITH {_BY_SOURCE_SQL}, r AS ({_rank_sql('bs', 'source')}) "
            + S.outer_select(["source", "roc_auc", "pr_auc"], {"roc_auc", "pr_auc"}, "r"))


# --- threshold_search (K8) / threshold_top10 (K26) ---------------------------------------------
def _search(spark, sf):
    return K.threshold_search(T.labelled_scores(spark, sf), lo=5, hi=95)


def q_threshold_search(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(_search(spark, sf))


def _search_sql() -> str:
    return (f"s AS {T.SCORES_SQL}, g AS (SELECT i / 100 AS threshold FROM range(5, 96) t(i)), "
            "c AS (SELECT g.threshold, count_if(s.score >= g.threshold AND s.y = 1) AS tp, "
            "count_if(s.score >= g.threshold AND s.y <> 1) AS fp, count_if(s.score < g.threshold AND s.y <> 1) AS tn, "
            "count_if(s.score < g.threshold AND s.y = 1) AS fn, count(*) AS n FROM g, s GROUP BY g.threshold), "
            f"r0 AS ({_rank_sql('s', '')}), "
            f"r AS (SELECT threshold, {_metric_sql()}, r0.roc_auc, r0.pr_auc FROM c, r0)")


_SEARCH_COLS = ["threshold"] + _THR_COLS + ["roc_auc", "pr_auc"]
_SEARCH_DBL = _THR_DBL | {"threshold", "roc_auc", "pr_auc"}


def sql_threshold_search() -> str:
    return f"WITH {_search_sql()} " + S.outer_select(_SEARCH_COLS, _SEARCH_DBL, "r")


def q_threshold_top10(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(K.top_thresholds(_search(spark, sf), 10))


def sql_threshold_top10() -> str:
    return (f"WITH {_search_sql()}, t AS (SELECT * FROM r ORDER BY business_cost_per_obs, pr_auc DESC, recall DESC, "
            "threshold LIMIT 10) " + S.outer_select(_SEARCH_COLS, _SEARCH_DBL, "t"))


# --- pr_curve / best_f1_threshold (K9) -----------------------------------------------------
def q_pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(K.pr_curve(_models(spark, sf), by=["model"]))


def _pr_sql() -> str:
    return ("st AS (SELECT model, CAST(score AS DOUBLE) AS threshold, CAST(count_if(y = 1) AS DOUBLE) AS pos, "
            "CAST(count_if(y <> 1) AS DOUBLE) AS neg FROM models GROUP BY ALL), "
            "c AS (SELECT model, threshold, sum(pos) OVER (PARTITION BY model ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp, "
            "sum(neg) OVER (PARTITION BY model ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp, "
            "sum(pos) OVER (PARTITION BY model) AS P FROM st), "
            "p AS (SELECT model, threshold, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, "
            "coalesce(tp / nullif(P, 0), 0.0) AS recall FROM c), "
            "pr AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM p)")


def sql_pr_curve() -> str:
    return (f"WITH {_MODELS_SQL}, {_pr_sql()} "
            + S.outer_select(["model", "threshold", "precision", "recall", "f1"],
                             {"threshold", "precision", "recall", "f1"}, "pr"))


def q_best_f1_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(K.best_f1_threshold(T.labelled_scores(spark, sf)))


def sql_best_f1_threshold() -> str:
    return (f"WITH s AS {T.SCORES_SQL}, models AS (SELECT 'x' AS model, * FROM s), {_pr_sql()}, "
            "b AS (SELECT threshold, precision, recall, f1 FROM pr ORDER BY f1 DESC, threshold LIMIT 1) "
            + S.outer_select(["threshold", "precision", "recall", "f1"], {"threshold", "precision", "recall", "f1"}, "b"))


# --- confusion_shares (K14, B21) / class_report (K15) ------------------------------------------
def _pred(spark, sf):
    return T.labelled_scores(spark, sf).withColumn("pred", label_at("score", 0.45))


def q_confusion_shares(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(K.confusion_matrix(_pred(spark, sf)))


def sql_confusion_shares() -> str:
    return (f"WITH p AS (SELECT y, CAST(score >= 0.45 AS INTEGER) AS pred FROM {T.SCORES_SQL}), "
            "c AS (SELECT y, pred, count(*) AS count FROM p GROUP BY ALL), "
            "r AS (SELECT y, pred, count, count / sum(count) OVER () AS share, "
            "count / sum(count) OVER (PARTITION BY y) AS share_of_class FROM c) "
            + S.outer_select(["y", "pred", "count", "share", "share_of_class"], {"share", "share_of_class"}, "r"))


def q_class_report(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(K.classification_report(_pred(spark, sf)))


def sql_class_report() -> str:
    per = []
    for k in (0, 1):
        per.append(
            f"SELECT '{k}' AS label, coalesce(count_if(pred = {k} AND y = {k}) / nullif(count_if(pred = {k}), 0), 0.0) AS precision, "
            f"coalesce(count_if(pred = {k} AND y = {k}) / nullif(count_if(y = {k}), 0), 0.0) AS recall, "
            f"count_if(y = {k}) AS support FROM p")
    return (f"WITH p AS (SELECT y, CAST(score >= 0.45 AS INTEGER) AS pred FROM {T.SCORES_SQL}), "
            f"per0 AS ({' UNION ALL '.join(per)}), "
            "per AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM per0), "
            "r AS (SELECT label, precision, recall, f1, support FROM per UNION ALL "
            "SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per UNION ALL "
            "SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
            "sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per) "
            + S.outer_select(["label", "precision", "recall", "f1", "support"], {"precision", "recall", "f1"}, "r"))


# --- regression_metrics (K16) / regression_cv (K17) -----------------------------------------
def _reg(spark, sf):
    li = T.table(spark, sf, "lineitem")
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    est = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("yhat"))
    return o.join(est, o.o_orderkey == est.l_orderkey).select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("y"), "yhat")


_REG_SQL = ("reg AS (SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice AS y, e.yhat FROM orders o JOIN "
            "(SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS yhat FROM lineitem "
            "GROUP BY l_orderkey) e ON o.o_orderkey = e.l_orderkey)")


def _reg_metric_sql(by: str) -> str:
    return (f"SELECT {by}, 1.0 - sum((yhat - y) * (yhat - y)) / nullif(var_pop(y) * count(*), 0) AS r2, "
            f"avg(abs(yhat - y) / greatest(abs(y), {K.EPS!r})) * 100 AS mape_pct, avg(abs(yhat - y)) AS mae, "
            f"sqrt(sum((yhat - y) * (yhat - y)) / count(*)) AS rmse FROM reg GROUP BY {by}")


def q_regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(K.regression_metrics(_reg(spark, sf), by=["o_orderstatus"]))


def sql_regression_metrics() -> str:
    return (f"WITH {_REG_SQL}, r AS ({_reg_metric_sql('o_orderstatus')}) "
            + S.outer_select(["o_orderstatus", "r2", "mape_pct", "mae", "rmse"], {"r2", "mape_pct", "mae", "rmse"}, "r"))


def q_regression_cv(spark: SparkSession, sf: str) -> DataFrame:
    d = H.kfold(_reg(spark, sf), ["o_orderkey"], 5, 42)
    per = K.regression_metrics(d, by=["fold"])
    return sig_round_doubles(per.agg(*[F.avg(c).alias(c) for c in ("r2", "mape_pct", "mae", "rmse")]))


def sql_regression_cv() -> str:
    h = "md5('42' || ':' || CAST(o_orderkey AS VARCHAR))"
    return (f"WITH {_REG_SQL.replace('reg AS', 'reg0 AS')}, reg AS (SELECT *, CAST((row_number() OVER (ORDER BY {h}, "
            "o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM reg0), "
            f"f AS ({_reg_metric_sql('fold')}), r AS (SELECT avg(r2) AS r2, avg(mape_pct) AS mape_pct, avg(mae) AS mae, "
            "avg(rmse) AS rmse FROM f) "
            + S.outer_select(["r2", "mape_pct", "mae", "rmse"], {"r2", "mape_pct", "mae", "rmse"}, "r"))


# --- cv_summary (E13 / K13) ------------------------------------------------------------------
def _fold_metrics(spark, sf):
    d = H.kfold(T.labelled_scores(spark, sf), ["id"], 3, 42, label="y")
    return K.classification_metrics(d, threshold=0.5, by=["fold"])


_CV_METRICS = ["accuracy", "precision", "recall", "f1", "business_fbeta", "roc_auc", "pr_auc", "business_cost_per_obs"]


def q_cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    fm = _fold_metrics(spark, sf).withColumn("split", F.lit("valid"))
    samp = K.cv_summary(fm, _CV_METRICS).withColumn("std_kind", F.lit("sample"))
    pop = K.cv_summary(fm, _CV_METRICS, population=True).withColumn("std_kind", F.lit("population"))
    return sig_round_doubles(samp.unionByName(pop))


def sql_cv_summary() -> str:
    h = "md5('42' || ':' || CAST(id AS VARCHAR))"
    per = (f"s0 AS {T.SCORES_SQL}, s AS (SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY {h}, id) - 1) % 3 "
           "AS INTEGER) AS fold FROM s0), "
           f"c AS ({_conf_sql('s', 'score >= 0.5', 'fold')}), m AS (SELECT fold, {_metric_sql()} FROM c), "
           f"rk AS ({_rank_sql('s', 'fold')}), fm AS (SELECT m.*, rk.roc_auc, rk.pr_auc FROM m JOIN rk ON m.fold = rk.fold)")
    samp = ", ".join(f"avg({m}) AS {m}_mean, stddev_samp({m}) AS {m}_std" for m in _CV_METRICS)
    pop = ", ".join(f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_std" for m in _CV_METRICS)
    cols = ["split"] + [f"{m}_{k}" for m in _CV_METRICS for k in ("mean", "std")] + ["std_kind"]
    return (f"WITH {per}, r AS (SELECT 'valid' AS split, {samp}, 'sample' AS std_kind FROM fm UNION ALL "
            f"SELECT 'valid', {pop}, 'population' FROM fm) "
            + S.outer_select(cols, {c for c in cols if c not in ("split", "std_kind")}, "r"))


# --- leaderboard (K20, I3) / gains (K25) ----------------------------------------------------
def _results(spark, sf):
    m = K.classification_metrics(_models(spark, sf), threshold=0.5, by=["model"])
    return m.withColumn("fit_time_sec", F.lit(0.0))


def q_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(K.leaderboard(_results(spark, sf)))


def sql_leaderboard() -> str:
    return (f"WITH {_MODELS_SQL}, c AS ({_conf_sql('models', 'score >= 0.5', 'model')}), "
            f"m AS (SELECT model, {_metric_sql()}, 0.5 AS threshold FROM c), r0 AS ({_rank_sql('models', 'model')}), "
            "res AS (SELECT m.*, r0.roc_auc, r0.pr_auc, 0.0 AS fit_time_sec FROM m LEFT JOIN r0 ON m.model = r0.model), "
            "r AS (SELECT *, CAST(row_number() OVER (ORDER BY business_cost_per_obs NULLS LAST, business_fbeta DESC NULLS LAST, "
            "fit_time_sec NULLS LAST, pr_auc DESC NULLS LAST, model) AS INTEGER) AS rank FROM res) "
            + S.outer_select(["model"] + _THR_COLS + ["threshold", "roc_auc", "pr_auc", "fit_time_sec", "rank"],
                             _THR_DBL | {"threshold", "roc_auc", "pr_auc", "fit_time_sec"}, "r"))


_GAIN_METRICS = ["business_cost_per_obs", "business_fbeta", "pr_auc", "roc_auc"]


def q_gains(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(K.gains_vs_baseline(_results(spark, sf), "model", "coarse", _GAIN_METRICS))


def sql_gains() -> str:
    # a cost gains when it falls, every other metric when it rises
    gains = ", ".join((f"b.{m} - res.{m}" if "cost" in m else f"res.{m} - b.{m}") + f" AS gain_{m}" for m in _GAIN_METRICS)
    return (f"WITH {_MODELS_SQL}, c AS ({_conf_sql('models', 'score >= 0.5', 'model')}), "
            f"m AS (SELECT model, {_metric_sql()} FROM c), r0 AS ({_rank_sql('models', 'model')}), "
            "res AS (SELECT m.*, r0.roc_auc, r0.pr_auc FROM m LEFT JOIN r0 ON m.model = r0.model), "
            f"r AS (SELECT res.model, {gains} FROM res, (SELECT * FROM res WHERE model = 'coarse') b) "
            + S.outer_select(["model"] + [f"gain_{m}" for m in _GAIN_METRICS],
                             {f"gain_{m}" for m in _GAIN_METRICS}, "r"))


QUERIES = {
    "confusion": q_confusion, "business_metrics": q_business_metrics, "roc_auc": q_roc_auc,
    "avg_precision": q_avg_precision, "threshold_search": q_threshold_search,
    "threshold_top10": q_threshold_top10, "pr_curve": q_pr_curve, "best_f1_threshold": q_best_f1_threshold,
    "confusion_shares": q_confusion_shares, "class_report": q_class_report,
    "regression_metrics": q_regression_metrics, "regression_cv": q_regression_cv, "cv_summary": q_cv_summary,
    "leaderboard": q_leaderboard, "gains": q_gains,
}
ORACLES = {
    "confusion": sql_confusion, "business_metrics": sql_business_metrics, "roc_auc": sql_roc_auc,
    "avg_precision": sql_avg_precision, "threshold_search": sql_threshold_search,
    "threshold_top10": sql_threshold_top10, "pr_curve": sql_pr_curve, "best_f1_threshold": sql_best_f1_threshold,
    "confusion_shares": sql_confusion_shares, "class_report": sql_class_report,
    "regression_metrics": sql_regression_metrics, "regression_cv": sql_regression_cv,
    "cv_summary": sql_cv_summary, "leaderboard": sql_leaderboard, "gains": sql_gains,
}
