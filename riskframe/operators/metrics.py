"""Evaluation of binary scores (K1-K27): pure aggregations over
``(y, score[, by...])`` -- per model, fold, split or version through ``by``.

Threshold metrics are conditional sums (one pass).  Rank metrics (ROC-AUC,
average precision, the PR curve) first aggregate to one row per distinct
score (map-side partial aggregation: a score shared by a third of the rows is
one row after the first stage), then take running sums in score order with
``rank.running_totals`` -- bucketed, so no single task sorts all scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import join_null_safe
from .rank import running_totals

# Cost of a missed default (false negative) and of a wrongly
# refused client (false positive), 10:1; the business F-beta uses beta^2 = 10.
FN_COST = 10.0
FP_COST = 1.0
METRICS = ["accuracy", "precision", "recall", "f1", "business_fbeta", "roc_auc", "pr_auc"]


def _div(a: Column, b: Column) -> Column:
    """a / b with 0 on a zero denominator (zero_division=0)."""
    return F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(0.0))


# --- K1-K3 ---------------------------------------------------------------------
# One rule for missing values throughout this module: a row without a label, or
# without the score (or prediction) that is evaluated, is left out of every
# count and metric.
def _evaluated(df: DataFrame, y: str, value: str) -> DataFrame:
    return df.where(F.col(y).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))


def confusion_counts(df: DataFrame, y: str = "y", score: str = "score", threshold: float = 0.5,
                     by: Sequence[str] = (), pred: str | None = None) -> DataFrame:
    """tp, fp, tn, fn, n per group; prediction = score >= threshold (or a
    given 0/1 prediction column)."""
    p = F.col(pred) == 1 if pred else F.col(score) >= F.lit(float(threshold))
    t = F.col(y) == 1
    return _evaluated(df, y, pred or score).groupBy(*by).agg(
        F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"),
        F.count_if(~p & ~t).alias("tn"), F.count_if(~p & t).alias("fn"),
        F.count(F.lit(1)).alias("n"))


def threshold_metric_columns(fn_cost: float = FN_COST, fp_cost: float = FP_COST) -> list[Column]:
    """accuracy, precision, recall, f1, business F-beta (beta^2 = fn/fp) and the
    business cost from tp/fp/tn/fn/n columns."""
    tp, fp, tn, fn, n = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn", "n"))
    b2 = fn_cost / fp_cost
    precision = _div(tp, tp + fp)
    recall = _div(tp, tp + fn)
    cost = fn * fn_cost + fp * fp_cost
    return [
        _div(tp + tn, n).alias("accuracy"), precision.alias("precision"), recall.alias("recall"),
        _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _div((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp).alias("business_fbeta"),
        F.col("fn").alias("false_negatives"), F.col("fp").alias("false_positives"),
        cost.alias("business_cost"), (cost / F.nullif(n, F.lit(0.0))).alias("business_cost_per_obs"),
    ]


def business_cost(df: DataFrame, y: str = "y", pred: str = "pred", fn_cost: float = FN_COST,
                  fp_cost: float = FP_COST, by: Sequence[str] = ()) -> DataFrame:
    """K1: FN, FP, total and mean cost of 0/1 predictions."""
    c = confusion_counts(df, y, pred=pred, by=by)
    cost = F.col("fn") * fn_cost + F.col("fp") * fp_cost
    return c.select(*by, F.col("fn").alias("false_negatives"), F.col("fp").alias("false_positives"),
                    cost.cast("double").alias("business_cost"),
                    (cost / F.nullif(F.col("n").cast("double"), F.lit(0.0))).alias("business_cost_per_obs"))


# --- K4 / K5 / K7 --------------------------------------------------------------
def score_table(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct score): pos, neg."""
    t = F.col(y) == 1
    return _evaluated(df, y, score).groupBy(*by, F.col(score).cast("double").alias("s")).agg(
        F.count_if(t).cast("double").alias("pos"), F.count_if(~t).cast("double").alias("neg"))


def _cumulated(st: DataFrame, by: Sequence[str]) -> DataFrame:
    """Running sums of a written score table, with the class totals P, N of
    each group (read from the same table, not from the scores)."""
    by = list(by)
    cum = running_totals(st, "s", ["pos", "neg"], by, materialize=False)
    tot = st.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    if by:
        return join_null_safe(cum, tot, by)
    row = tot.first()
    return cum.withColumns({"P": F.lit(row["P"]).cast("double"), "N": F.lit(row["N"]).cast("double")})


def _rank_metrics_of(st: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    by = list(by)
    cum = _cumulated(st, by)
    P, N = F.col("P"), F.col("N")
    # ascending inclusive sums -> negatives strictly below, and the descending
    # inclusive counts at each score (tp, fp when predicting score >= s)
    neg_below = F.col("cum_neg") - F.col("neg")
    tp = P - F.col("cum_pos") + F.col("pos")
    fp = N - F.col("cum_neg") + F.col("neg")
    c = cum.select(*by, "pos", "neg", "P", "N",
                   (F.col("pos") * (neg_below + F.col("neg") / 2)).alias("_auc"),
                   (F.col("pos") * tp / (tp + fp)).alias("_ap"))
    g = c.groupBy(*by).agg(F.sum("_auc").alias("_auc"), F.sum("_ap").alias("_ap"),
                           F.max("P").alias("P"), F.max("N").alias("N"))
    return g.select(*by,
                    F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_auc") / (F.col("P") * F.col("N")))
                    .alias("roc_auc"),
                    F.when(F.col("P") > 0, F.col("_ap") / F.col("P")).alias("pr_auc"))


def rank_metrics(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (trapezoid = Mann-Whitney with ties counted half) and average
    precision (step sum over distinct scores, descending) per group.  NULL
    when a group has a single class (ROC undefined; AP undefined without
    positives).  The scores are read once, to the distinct-score table."""
    return _rank_metrics_of(cut_lineage(score_table(df, y, score, by)), by)


# --- K6 ------------------------------------------------------------------------
def classification_metrics(df: DataFrame, y: str = "y", score: str = "score", threshold: float = 0.5,
                           fn_cost: float = FN_COST, fp_cost: float = FP_COST,
                           by: Sequence[str] = ()) -> DataFrame:
    """All threshold and rank metrics in one row per group, from one scan of
    the scores: the confusion counts are sums over the distinct-score table."""
    by = list(by)
    st = cut_lineage(score_table(df, y, score, by))
    p = F.col("s") >= F.lit(float(threshold))

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0.0)).cast("long")
    c = st.groupBy(*by).agg(
        total(F.when(p, F.col("pos"))).alias("tp"), total(F.when(p, F.col("neg"))).alias("fp"),
        total(F.when(~p, F.col("neg"))).alias("tn"), total(F.when(~p, F.col("pos"))).alias("fn"),
        total(F.col("pos") + F.col("neg")).alias("n"))
    m = c.select(*by, *threshold_metric_columns(fn_cost, fp_cost), F.lit(float(threshold)).alias("threshold"))
    r = _rank_metrics_of(st, by)
    return join_null_safe(m, r, by, "left") if by else _one_row_join(m, r)


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Put two one-row frames side by side (union + max, no cross join)."""
    cols_a, cols_b = a.columns, b.columns
    u = a.unionByName(b, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in cols_a + [c for c in cols_b if c not in cols_a]])


# --- K8 / K26 ------------------------------------------------------------------
def grid(lo: int = 5, hi: int = 95, step_div: int = 100) -> list[float]:
    """Integer grid i / step_div (the float-step grid of the reference drifts:
    its 0.5 is 0.4999999999999998)."""
    return [i / step_div for i in range(lo, hi + 1)]


def threshold_search(df: DataFrame, y: str = "y", score: str = "score", lo: int = 5, hi: int = 95,
                     fn_cost: float = FN_COST, fp_cost: float = FP_COST, ranks: bool = True) -> DataFrame:
    """Metrics at every threshold i/100 (lo <= i <= hi) from ONE scan of the
    scores, to the distinct-score table: each score falls in the bucket
    b = max{i : i/100 <= score} (clamped), the counts per bucket (<= hi-lo+2
    rows) give every threshold's confusion matrix by suffix sums.  ROC-AUC and
    PR-AUC are threshold-free and attached, unless ``ranks`` is off.
    """
    spark = df.sparkSession
    st = score_table(df, y, score)
    if ranks:
        st = cut_lineage(st)
    counts = st.groupBy(_grid_bucket(F.col("s"), lo, hi).alias("b")).agg(F.sum("pos").cast("long").alias("pos"), F.sum("neg").cast("long").alias("neg"))
    idx = spark.range(lo - 1, hi + 1).select(F.col("id").cast("int").alias("b"))
    full = idx.join(counts, "b", "left").fillna(0, ["pos", "neg"])
    w_sfx = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)  # <= 92 rows
    w_all = Window.partitionBy()
    sfx = full.select(
        "b", F.sum("pos").over(w_sfx).alias("tp"), F.sum("neg").over(w_sfx).alias("fp"),
        F.sum("pos").over(w_all).alias("P"), F.sum("neg").over(w_all).alias("N"))
    conf = sfx.where(F.col("b") >= lo).select(
        (F.col("b") / F.lit(100.0)).alias("threshold"), "tp", "fp",
        (F.col("N") - F.col("fp")).alias("tn"), (F.col("P") - F.col("tp")).alias("fn"),
        (F.col("P") + F.col("N")).alias("n"))
    table = conf.select("threshold", *threshold_metric_columns(fn_cost, fp_cost))
    if not ranks:
        return table
    # one row of ranks, joined by the constant of the whole grid
    r = _rank_metrics_of(st).withColumn("_all", F.lit(1))
    return table.withColumn("_all", F.lit(1)).join(F.broadcast(r), "_all", "left").drop("_all")


def _grid_bucket(s: Column, lo: int, hi: int) -> Column:
    """max{i : i/100 <= s}, clamped to [lo - 1, hi], compared with the same
    i/100 doubles that the grid uses."""
    g0 = F.floor(s * 100).cast("int")
    b = (F.when((g0 + 1) / F.lit(100.0) <= s, g0 + 1).when(g0 / F.lit(100.0) > s, g0 - 1).otherwise(g0))
    return F.least(F.greatest(b, F.lit(lo - 1)), F.lit(hi))


def least_cost(df: DataFrame, y: str, score: str, by: Sequence[str], lo: int = 5, hi: int = 95,
               fn_cost: float = FN_COST, fp_cost: float = FP_COST) -> DataFrame:
    """Per group, the lowest business cost per observation over the
    threshold grid (``least_cost_per_obs``), from one aggregate by grid bucket
    and suffix sums over at most hi - lo + 2 buckets of a group."""
    by = list(by)
    t = F.col(y) == 1
    counts = _evaluated(df, y, score).groupBy(*by, _grid_bucket(F.col(score).cast("double"), lo, hi).alias("b")).agg(
        F.count_if(t).alias("pos"), F.count_if(~t).alias("neg"))
    # thresholds in an empty bucket cost what the next filled one above does; the highest may refuse nobody
    above = Window.partitionBy(*by).orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*by)
    c = counts.select(*by, "b", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
                      F.sum("pos").over(every).alias("P"), F.sum(F.col("pos") + F.col("neg")).over(every).alias("n"),
                      F.max("b").over(every).alias("top"))
    at = F.when(F.col("b") >= lo, (F.col("P") - F.col("tp")) * fn_cost + F.col("fp") * fp_cost)
    none = F.when(F.col("top") < hi, F.col("P") * F.lit(fn_cost))
    return c.groupBy(*by).agg((F.least(F.min(at), F.min(none)) / F.max("n")).alias("least_cost_per_obs"))


def best_threshold(search: DataFrame) -> DataFrame:
    """Best grid row: lowest cost per observation, then PR-AUC, then recall."""
    return search.orderBy(F.col("business_cost_per_obs").asc(), F.col("pr_auc").desc(),
                          F.col("recall").desc(), F.col("threshold").asc()).limit(1)


def top_thresholds(search: DataFrame, k: int = 10) -> DataFrame:
    """The k best grid rows."""
    return search.orderBy(F.col("business_cost_per_obs").asc(), F.col("pr_auc").desc(),
                          F.col("recall").desc(), F.col("threshold").asc()).limit(k)


# --- K9 ------------------------------------------------------------------------
def pr_curve(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Precision / recall / F1 when predicting score >= s, at every distinct
    score s."""
    by = list(by)
    cum = _cumulated(cut_lineage(score_table(df, y, score, by)), by)
    P, N = F.col("P"), F.col("N")
    tp = P - F.col("cum_pos") + F.col("pos")
    fp = N - F.col("cum_neg") + F.col("neg")
    c = cum.select(*by, F.col("s").alias("threshold"), tp.alias("tp"), fp.alias("fp"), "P")
    precision = _div(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _div(F.col("tp"), F.col("P"))
    return c.select(*by, "threshold", precision.alias("precision"), recall.alias("recall"),
                    _div(2 * precision * recall, precision + recall).alias("f1"))


def best_f1_threshold(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """First (lowest) threshold reaching the maximal F1."""
    return pr_curve(df, y, score).orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1)


# --- K14 / K15 -------------------------------------------------------------------
def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Counts per (y, pred) with the share of all rows and of the true class."""
    by = list(by)
    c = df.groupBy(*by, y, pred).agg(F.count(F.lit(1)).alias("count"))
    return c.select(*by, y, pred, "count",
                    (F.col("count") / F.sum("count").over(Window.partitionBy(*by))).alias("share"),
                    (F.col("count") / F.sum("count").over(Window.partitionBy(*by, y))).alias("share_of_class"))


def classification_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """Per class precision / recall / F1 / support (zero_division = 0), then
    macro and weighted averages."""
    c = df.groupBy().agg(*[x for k in (0, 1) for x in (
        F.count_if((F.col(pred) == k) & (F.col(y) == k)).alias(f"tp{k}"),
        F.count_if(F.col(pred) == k).alias(f"pp{k}"),
        F.count_if(F.col(y) == k).alias(f"s{k}"))])
    rows = []
    for k in (0, 1):
        p = _div(F.col(f"tp{k}").cast("double"), F.col(f"pp{k}").cast("double"))
        r = _div(F.col(f"tp{k}").cast("double"), F.col(f"s{k}").cast("double"))
        rows.append(c.select(F.lit(str(k)).alias("label"), p.alias("precision"), r.alias("recall"),
                             _div(2 * p * r, p + r).alias("f1"), F.col(f"s{k}").alias("support")))
    per = rows[0].unionByName(rows[1])
    tot = F.sum("support").over(Window.partitionBy())
    w = per.select("*", tot.alias("_tot"))  # two rows
    macro = w.groupBy().agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                            F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                            F.sum("support").alias("support"))
    weighted = w.groupBy().agg(
        F.lit("weighted avg").alias("label"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
        F.sum("support").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


# --- K16 / K17 -------------------------------------------------------------------
EPS = 2.220446049250313e-16  # float64 machine epsilon (MAPE denominator floor)


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """R2, MAPE (%) with |y| floored at machine epsilon, MAE, RMSE per group."""
    e = F.col(yhat) - F.col(y)
    g = df.groupBy(*by).agg(
        F.sum(e * e).alias("_sse"), F.var_pop(y).alias("_vy"), F.count(F.lit(1)).alias("_n"),
        F.avg(F.abs(e) / F.greatest(F.abs(F.col(y)), F.lit(EPS))).alias("_mape"),
        F.avg(F.abs(e)).alias("mae"))
    return g.select(*by, (F.lit(1.0) - F.col("_sse") / F.nullif(F.col("_vy") * F.col("_n"), F.lit(0.0))).alias("r2"),
                    (F.col("_mape") * 100).alias("mape_pct"), "mae",
                    F.sqrt(F.col("_sse") / F.col("_n")).alias("rmse"))


# --- E13 / K11 / K13 -------------------------------------------------------------
def cv_summary(fold_metrics: DataFrame, metrics: Sequence[str], by: Sequence[str] = ("split",),
               population: bool = False) -> DataFrame:
    """Mean and std of every metric over folds per split (sample std, or
    population std as the second CV routine of the reference does)."""
    std = F.stddev_pop if population else F.stddev_samp
    return fold_metrics.groupBy(*by).agg(*[x for m in metrics for x in (
        F.avg(m).alias(f"{m}_mean"), std(m).alias(f"{m}_std"))])


def flatten_summary(summary: DataFrame, split: str = "split") -> DataFrame:
    """Long (key = '{split}_{metric}', value)."""
    vals = [c for c in summary.columns if c != split]
    long = summary.select(split, *[F.col(c).cast("double").alias(c) for c in vals]) \
                  .unpivot([split], vals, "metric", "value")
    return long.select(F.concat_ws("_", F.col(split).cast("string"), "metric").alias("key"), "value")


# --- K20 / K21 / K25 -------------------------------------------------------------
def leaderboard(results: DataFrame) -> DataFrame:
    """Sort by cost asc, business F-beta desc, fit time asc, PR-AUC desc and
    number the rows (a report-sized frame: one row per model)."""
    keys = [F.col("business_cost_per_obs").asc_nulls_last(), F.col("business_fbeta").desc_nulls_last(),
            F.col("fit_time_sec").asc_nulls_last(), F.col("pr_auc").desc_nulls_last(), F.col("model").asc()]
    return results.withColumn("rank", F.row_number().over(Window.orderBy(*keys))).orderBy("rank")


def recommendation(board: DataFrame) -> DataFrame:
    """One-row nested document: best by cost, best by F-beta, ordered list."""
    return board.agg(
        F.min_by("model", F.struct("business_cost_per_obs", (-F.col("business_fbeta")).alias("f"),
                                   "fit_time_sec", (-F.col("pr_auc")).alias("p"), "model")).alias("best_by_cost"),
        F.min_by("model", F.struct((-F.col("business_fbeta")).alias("f"), "model")).alias("best_by_fbeta"),
        F.sort_array(F.collect_list(F.struct("rank", "model"))).alias("ranking"))


COSTS = ("business_cost", "business_cost_per_obs", "false_negatives", "false_positives")


def gains_vs_baseline(comparison: DataFrame, key: str, baseline: str, metrics: Sequence[str]) -> DataFrame:
    """What each row gains over the baseline row: the metric minus the
    baseline's, for costs (lower is better) the baseline's minus the row's."""
    # the baseline value is spread with a window over the comparison table
    # (report-sized: one row per version / model)
    w = Window.partitionBy()
    base = {m: F.max(F.when(F.col(key) == baseline, F.col(m))).over(w) for m in metrics}
    return comparison.select(key, *[(base[m] - F.col(m) if m in COSTS else F.col(m) - base[m]).alias(f"gain_{m}")
                                    for m in metrics])


def overfit_gaps(metrics: DataFrame, split: str = "split", train: str = "train", valid: str = "test",
                 names: Sequence[str] = tuple(METRICS), by: Sequence[str] = ()) -> DataFrame:
    """One row per group with ``{train}_{m}``, ``{valid}_{m}`` and
    ``gap_{m}`` = train - valid (missing metrics stay NULL) -- a pivot of the
    metric rows by split."""
    present = [m for m in names if m in metrics.columns]
    aggs = []
    for m in present:
        t = F.max(F.when(F.col(split) == train, F.col(m)))
        v = F.max(F.when(F.col(split) == valid, F.col(m)))
        aggs += [t.alias(f"{train}_{m}"), v.alias(f"{valid}_{m}"), (t - v).alias(f"gap_{m}")]
    return metrics.groupBy(*by).agg(*aggs)
