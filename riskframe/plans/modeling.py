"""Registered queries of the model layer.

Learner outputs depend on the learning algorithm, so apart from the majority
baseline these have no SQL oracle: the driver checks them rows-only and the
pytest suite checks their properties.  Model-ready matrix: the client feature
mart's labelled rows, pruned (F15), one-hot encoded (C1), median-imputed
(C6), assembled."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.rounding import sig_round_doubles
from ..operators import attribution as A
from ..operators import encode as E
from ..operators import explain as L
from ..operators import metrics as K
from ..operators import models as J
from ..operators import profile as P
from ..operators import split as H
from ..session import cut_lineage, short_methods
from ..sources.files import long_metrics
from . import features as FE
from . import mart as M
from . import sqlgen as S
from . import tables as T

SEED = 42


def _prepared(spark: SparkSession, sf: str):
    """(labelled, unlabelled, feature columns): the unrounded mart, one-hot
    encoded and prepared (F15), imputed by the training medians (C6)."""
    mart = cut_lineage(M.client_feature_mart(spark, sf))
    with short_methods(spark):
        return _imputed(mart)


def _imputed(mart: DataFrame):
    vocab = E.fit_vocabulary(mart, ["c_mktsegment"], max_categories=T.MAX_DUMMIES)
    train, test = H.split_on_target(E.one_hot_encode(mart, vocab)[0])
    x_train, x_test, _ = P.prepare_modeling_tables(train, test, "c_custkey", "TARGET", 0.95)
    feats = [c for c in x_train.columns if c not in ("c_custkey", "TARGET")]
    imp = E.MedianImputer(feats).fit(x_train)
    filled = cut_lineage(imp.transform(x_train))           # read by the check and by every split of the matrix
    P.assert_no_nulls(filled, feats)
    return filled, imp.transform(x_test), feats


def model_matrix(spark: SparkSession, sf: str):
    """(train, holdout, test, feature columns): train/holdout is a 80/20
    stratified split of the labelled clients; test = unlabelled clients."""
    x_train, x_test, feats = _prepared(spark, sf)
    prep = lambda d: (J.assemble(d.withColumns({c: F.col(c).cast("double") for c in feats}), feats)
                      .withColumnRenamed("c_custkey", "id").withColumnRenamed("TARGET", "y"))
    with short_methods(spark):
        tr = cut_lineage(H.stratified_holdout(prep(x_train), "y", ["id"], 20, SEED))
    return tr.where("is_test = 0").drop("is_test"), tr.where("is_test = 1").drop("is_test"), prep(x_test), feats


def q_modeling_tables(spark: SparkSession, sf: str) -> DataFrame:
    """F15 / F16 on the whole mart with its text column left in: the report with
    kept features and dropped text columns."""
    train, test = H.split_on_target(FE.q_client_feature_mart(spark, sf))
    return sig_round_doubles(P.prepare_modeling_tables(train, test, "c_custkey", "TARGET", 0.95)[2])


def sql_modeling_tables() -> str:
    from .profiling import sql_quality_report
    return ("SELECT feature, missing_ratio_train, dtype, nunique_train, 'kept' AS status "
            f"FROM ({sql_quality_report()}) WHERE feature <> 'c_mktsegment' "
            "UNION ALL SELECT 'c_mktsegment', NULL, 'string', NULL, 'dropped_text'")


# --- J1 majority (SQL-checked) -----------------------------------------------------------------
def q_majority(spark: SparkSession, sf: str) -> DataFrame:
    app = T.application(spark, sf)
    lab = H.stratified_holdout(H.split_on_target(app)[0].withColumnRenamed("c_custkey", "id")
                               .withColumnRenamed("TARGET", "y"), "y", ["id"], 20, SEED)
    model, _ = J.fit("majority", lab.where("is_test = 0"), "y")
    s = J.score(model, lab.where("is_test = 1"), ["id", "y"])
    return sig_round_doubles(K.classification_metrics(s, threshold=0.5))


def sql_majority() -> str:
    h = f"md5('{SEED}' || ':' || CAST(c_custkey AS VARCHAR))"
    d = lambda a, b: f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"
    return (f"WITH lab AS (SELECT c_custkey AS id, TARGET AS y, CAST(row_number() OVER (PARTITION BY TARGET ORDER BY {h}, "
            f"c_custkey) <= floor((count(*) OVER (PARTITION BY TARGET) * 20 + 50) / 100) AS INTEGER) AS is_test "
            f"FROM {T.APPLICATION_SQL} WHERE TARGET IS NOT NULL), "
            "maj AS (SELECT y AS m FROM lab WHERE is_test = 0 GROUP BY y ORDER BY count(*) DESC, y LIMIT 1), "
            "s AS (SELECT id, y, CAST(m AS DOUBLE) AS score FROM lab, maj WHERE is_test = 1), "
            "c AS (SELECT count_if(score >= 0.5 AND y = 1) AS tp, count_if(score >= 0.5 AND y <> 1) AS fp, "
            "count_if(score < 0.5 AND y <> 1) AS tn, count_if(score < 0.5 AND y = 1) AS fn, count(*) AS n, "
            "CAST(count_if(y = 1) AS DOUBLE) AS npos, CAST(count_if(y <> 1) AS DOUBLE) AS nneg FROM s), "
            # a single distinct score: every positive ties with every negative
            f"r AS (SELECT {d('tp + tn', 'n')} AS accuracy, {d('tp', 'tp + fp')} AS precision, {d('tp', 'tp + fn')} AS recall, "
            f"{d('2 * tp', '2 * tp + fp + fn')} AS f1, {d('11.0 * tp', '11.0 * tp + 10.0 * fn + fp')} AS business_fbeta, "
            "fn AS false_negatives, fp AS false_positives, CAST(fn * 10.0 + fp * 1.0 AS DOUBLE) AS business_cost, "
            "CAST(fn * 10.0 + fp * 1.0 AS DOUBLE) / n AS business_cost_per_obs, 0.5 AS threshold, "
            "CASE WHEN npos > 0 AND nneg > 0 THEN 0.5 END AS roc_auc, CASE WHEN npos > 0 THEN npos / (npos + nneg) END AS pr_auc FROM c) "
            + S.outer_select(["accuracy", "precision", "recall", "f1", "business_fbeta", "false_negatives",
                              "false_positives", "business_cost", "business_cost_per_obs", "threshold", "roc_auc",
                              "pr_auc"],
                             {"accuracy", "precision", "recall", "f1", "business_fbeta", "business_cost",
                              "business_cost_per_obs", "threshold", "roc_auc", "pr_auc"}, "r"))


# --- J2-J5 / K10 / K12 / E13 -----------------------------------------------------------------------
def q_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """Holdout evaluation as one aligned row: train_*, test_* and the
    overfit gap_* of every metric (K12, K19)."""
    tr, ho, _, _ = model_matrix(spark, sf)
    m, _ = J.holdout_evaluation("logistic", tr, ho, "y")
    return K.overfit_gaps(m, "split", "train", "test")


def q_gbt(spark: SparkSession, sf: str) -> DataFrame:
    tr, ho, _, _ = model_matrix(spark, sf)
    return J.holdout_evaluation("gbt", tr, ho, "y")[0]


def q_leafwise(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf-wise boosting at the reference configuration."""
    tr, ho, _, _ = model_matrix(spark, sf)
    return J.holdout_evaluation("gbt_leafwise", tr, ho, "y")[0]


def q_leafwise_stopping(spark: SparkSession, sf: str) -> DataFrame:
    """The AUC of every prefix on an inner validation part, and where the
    growth stops (patience 50)."""
    tr, _, _, _ = model_matrix(spark, sf)
    inner = cut_lineage(H.stratified_holdout(tr, "y", ["id"], 20, SEED + 7, name="is_valid").withColumn("is_valid", F.col("is_valid").cast("boolean")))
    model, trees = J.early_stopped("gbt_leafwise", inner, "is_valid", "y")
    return J.prefix_aucs(model, inner).withColumn("kept", F.col("n_trees") <= trees)


def q_tree_contrib(spark: SparkSession, sf: str) -> DataFrame:
    """L3: mean absolute contributions of a boosted model's features over the
    test clients."""
    tr, _, te, feats = model_matrix(spark, sf)
    model, _ = J.fit("gbt", tr, "y")
    return A.tree_contributions(model, te, feats, "id")[1]


def q_tree_local_contrib(spark: SparkSession, sf: str) -> DataFrame:
    """The contributions of the test client with the highest score."""
    tr, _, te, feats = model_matrix(spark, sf)
    model, _ = J.fit("gbt", tr, "y")
    riskiest = J.score(model, te, ["id"]).agg(F.max_by("id", F.struct("score", "id"))).first()[0]
    return L.local_explanation(A.tree_contributions(model, te.where(F.col("id") == riskiest), feats, "id")[0], "id", riskiest)


def q_random_search(spark: SparkSession, sf: str) -> DataFrame:
    """A random search of 20 draws over a finer logistic grid."""
    tr, _, _, _ = model_matrix(spark, sf)
    fine = {"logistic": {"regParam": [10.0 ** (-e / 2) for e in range(4, 12)], "elasticNetParam": [0.0, 0.15, 0.5, 1.0]}}
    return J.grid_search("logistic", tr, ["id"], "y", 3, grids=fine, max_points=20)[0]


def q_forest(spark: SparkSession, sf: str) -> DataFrame:
    tr, ho, _, _ = model_matrix(spark, sf)
    return J.holdout_evaluation("forest", tr, ho, "y")[0]


def q_extra_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Extremely randomised trees at the reference configuration."""
    tr, ho, _, _ = model_matrix(spark, sf)
    return J.holdout_evaluation("extra_trees", tr, ho, "y")[0]


def q_svc(spark: SparkSession, sf: str) -> DataFrame:
    """A model without probabilities, scored by its scaled margin."""
    tr, ho, _, _ = model_matrix(spark, sf)
    return J.holdout_evaluation("linear_svc", tr, ho, "y")[0]


def q_cv_logistic(spark: SparkSession, sf: str) -> DataFrame:
    tr, _, _, _ = model_matrix(spark, sf)
    folds = J.cross_validate("logistic", tr, ["id"], 3, "y", SEED)
    return K.cv_summary(folds, K.METRICS + ["business_cost_per_obs", "fit_time_sec"])


def q_fold_sample(spark: SparkSession, sf: str) -> DataFrame:
    """H9: training metrics on an exact sample of 200 rows of each fold."""
    tr, _, _, _ = model_matrix(spark, sf)
    return J.cross_validate("logistic", tr, ["id"], 3, "y", SEED, train_sample=200)


def q_cv_split(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-validation inside the training part, then the holdout."""
    tr, _, _, _ = model_matrix(spark, sf)
    summary, hold, _ = J.cross_validate_split("logistic", tr, ["id"], 5, "y", SEED)
    return summary.unionByName(hold.withColumn("split", F.lit("holdout")), allowMissingColumns=True)


def q_oof_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """Confusion of the out-of-fold predictions at 0.5."""
    tr, _, _, _ = model_matrix(spark, sf)
    oof = J.out_of_fold("logistic", tr, ["id"], 3, "y", SEED)
    return K.confusion_matrix(oof.withColumn("pred", X.label_at("score", 0.5)), "y", "pred")


def q_regression_fit(spark: SparkSession, sf: str) -> DataFrame:
    """A linear regression of the order total on its lines' figures, split
    80/20 over all orders; metrics on train and test."""
    return J.regression_evaluation(_order_matrix(spark, sf), ["id"])[0]


def q_regression_folds(spark: SparkSession, sf: str) -> DataFrame:
    """The same regression in 5 folds."""
    return J.regression_cross_validate(_order_matrix(spark, sf), ["id"])


def _order_matrix(spark: SparkSession, sf: str) -> DataFrame:
    lines = T.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("price"), F.avg("l_discount").alias("discount"))
    o = T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("y"))
    d = o.join(lines, o["id"] == lines["l_orderkey"], "left").drop("l_orderkey").fillna(0.0)
    return cut_lineage(J.assemble(d, ["n", "quantity", "price", "discount"]))


def q_grid_search(spark: SparkSession, sf: str) -> DataFrame:
    tr, _, _, _ = model_matrix(spark, sf)
    return J.grid_search("logistic", tr, ["id"], "y", 3)[0]


def q_learning_curve(spark: SparkSession, sf: str) -> DataFrame:
    tr, _, _, _ = model_matrix(spark, sf)
    return J.learning_curve("logistic", tr, ["id"], "y", 3, seed=SEED)


def q_early_stopping(spark: SparkSession, sf: str) -> DataFrame:
    tr, _, _, _ = model_matrix(spark, sf)
    thr, final, _ = J.tuned_threshold("gbt", tr, ["id"], seed=SEED + 7)
    return spark.createDataFrame([("gbt", int(final["maxIter"]), thr)], "model string, n_trees int, threshold double")


# --- K22 / K24 / K25 comparison and scoring --------------------------------------------------------
VERSIONED_MODEL = "logistic"


def _versions(spark, sf, name: str = VERSIONED_MODEL):
    """Baseline = the candidate as configured; tuned = the same candidate with
    the best parameters of its full grid, its threshold from an inner split,
    then refitted on the whole training block."""
    tr, ho, te, feats = model_matrix(spark, sf)
    base, _ = J.fit(name, tr, "y")
    _, best = J.grid_search(name, tr, ["id"], "y", 3)
    thr, final, _ = J.tuned_threshold(name, tr, ["id"], params=best, seed=SEED + 3)
    tuned, _ = J.fit(name, tr, "y", params=final)
    return ho, te, base, tuned, thr


def compare_versions(ho: DataFrame, base, tuned, thr: float) -> DataFrame:
    """Holdout metrics of baseline and tuned at 0.5 and of tuned at the
    business threshold."""
    s_base, s_tuned = J.score(base, ho, ["id", "y"]), cut_lineage(J.score(tuned, ho, ["id", "y"]))
    return (K.classification_metrics(s_base, threshold=0.5).withColumn("version", F.lit("baseline_0.5"))
            .unionByName(K.classification_metrics(s_tuned, threshold=0.5).withColumn("version", F.lit("tuned_0.5")))
            .unionByName(K.classification_metrics(s_tuned, threshold=thr)
                         .withColumn("version", F.lit("tuned_business_threshold"))))


def q_comparison(spark: SparkSession, sf: str) -> DataFrame:
    ho, _, base, tuned, thr = _versions(spark, sf)
    comp = cut_lineage(compare_versions(ho, base, tuned, thr))
    gains = K.gains_vs_baseline(comp, "version", "baseline_0.5", ["business_cost_per_obs", "business_fbeta", "pr_auc", "roc_auc"])
    return comp.join(gains, "version")


def q_test_scoring(spark: SparkSession, sf: str) -> DataFrame:
    _, te, _, tuned, thr = _versions(spark, sf)
    return J.scoring_table(tuned, te, "id", thr)


# --- L1-L3 ------------------------------------------------------------------------------------------
def q_native_importance(spark: SparkSession, sf: str) -> DataFrame:
    tr, _, _, feats = model_matrix(spark, sf)
    m, _ = J.fit("forest", tr, "y")
    return L.native_importance(m, feats, spark)


def q_linear_importance(spark: SparkSession, sf: str) -> DataFrame:
    tr, _, _, feats = model_matrix(spark, sf)
    m, _ = J.fit("logistic", tr, "y")
    return L.native_importance(m, feats, spark, {c: v[1] for c, v in E.StandardScaler(feats).fit(tr).stats.items()})


def q_permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    tr, ho, _, feats = model_matrix(spark, sf)
    m, _ = J.fit("logistic", tr, "y")
    return L.permutation_importance(m, ho, feats, "id", "y", n_repeats=5, seed=SEED, metric="pr_auc")


def _contributions(spark: SparkSession, sf: str):
    tr, _, te, feats = model_matrix(spark, sf)
    m, _ = J.fit("logistic", tr, "y")
    means = {c: v[0] for c, v in E.StandardScaler(feats).fit(tr).stats.items()}
    return m, tr, te, feats, means


def q_linear_contrib(spark: SparkSession, sf: str) -> DataFrame:
    m, tr, _, feats, means = _contributions(spark, sf)
    return L.linear_contributions(m, tr, feats, "id", means)[1]


def q_local_contrib(spark: SparkSession, sf: str) -> DataFrame:
    """The contributions of the test client with the highest score."""
    m, _, te, feats, means = _contributions(spark, sf)
    riskiest = J.score(m, te, ["id"]).agg(F.max_by("id", F.struct("score", "id"))).first()[0]
    return L.local_explanation(L.linear_contributions(m, te, feats, "id", means)[0], "id", riskiest)


# --- entry point 1: full dataset build (F11 per block, D4, B13, H3, A6, A7) --------------------------------
def q_full_dataset(spark: SparkSession, sf: str) -> DataFrame:
    import uuid
    from ..session import ensure_checkpoint_dir
    from .mart import build_full_dataset
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/full-dataset-{uuid.uuid4().hex[:8]}"
    train, test, reports, audit = build_full_dataset(spark, sf, out)
    # the hand-over: what was written, per table, read back
    counts = (spark.read.parquet(f"{out}/train").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("train").alias("table"), "rows")
              .unionByName(spark.read.parquet(f"{out}/test").agg(F.count(F.lit(1)).alias("rows"))
                           .select(F.lit("test").alias("table"), "rows")))
    return counts


def sql_full_dataset() -> str:
    return (f"WITH app AS {T.APPLICATION_SQL} SELECT 'train' AS \"table\", count(*) AS rows FROM app "
            "WHERE TARGET IS NOT NULL UNION ALL SELECT 'test', count(*) FROM app WHERE TARGET IS NULL")


# --- entry point 2: baseline benchmark (J6, K10, K12, K20, K21, A7, A9, A10) ----------------------
BENCHMARK_MODELS = ["majority", "logistic", "linear_svc", "forest"]


def baseline_benchmark(spark: SparkSession, sf: str, out_dir: str, models=BENCHMARK_MODELS, k: int = 3,
                       params: dict | None = None, matrix: tuple | None = None) -> DataFrame:
    """For each candidate: k-fold CV on the training part and a holdout
    evaluation; one leaderboard row per model (holdout metrics, CV means,
    fit time).  Writes the leaderboard as CSV (A7), the recommendation as a
    JSON document (A9) and every metric as a long run-metrics table (A10)
    under ``out_dir``; returns the leaderboard.  ``params`` ({model: settings})
    overrides single settings of the reference configurations; ``matrix`` is a
    built ``model_matrix``."""
    from ..sources.files import append_run_metrics, write_json_document, write_report_csv
    tr, ho, _, _ = matrix or model_matrix(spark, sf)
    rows = None
    for name in models:
        own = (params or {}).get(name)
        folds = J.cross_validate(name, tr, ["id"], k, "y", SEED, params=own)
        cv = folds.where("split = 'valid'").agg(*[F.avg(m).alias(f"cv_{m}") for m in ("roc_auc", "pr_auc",
                                                                                       "business_cost_per_obs")])
        hold, _ = J.holdout_evaluation(name, tr, ho, "y", params=own)
        hold = hold.where("split = 'test'").drop("split")
        row = cut_lineage(K._one_row_join(hold, cv).withColumn("model", F.lit(name)))
        append_run_metrics(long_metrics(row.drop("model"), f"benchmark-{name}", "baseline"), f"{out_dir}/run_metrics")
        rows = row if rows is None else rows.unionByName(row)
    board = cut_lineage(K.leaderboard(rows))
    write_report_csv(board, f"{out_dir}/leaderboard")
    write_json_document(K.recommendation(board), f"{out_dir}/recommendation")
    return board


def _work_dir(spark: SparkSession, name: str) -> str:
    import uuid
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


def q_baseline_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return baseline_benchmark(spark, sf, _work_dir(spark, "baseline-benchmark"))


# --- entry point 3: optimise -> threshold -> final scoring (A8, J10-J12, K8, K22, K24) ---------------
LEADERBOARD_SCHEMA = "model string, rank int, business_cost_per_obs double"
FALLBACK_MODEL = "logistic"


def optimise_and_score(spark: SparkSession, sf: str, work_dir: str, grids: dict | None = None, matrix: tuple | None = None) -> DataFrame:
    """Read the leaderboard that ``baseline_benchmark`` wrote under ``work_dir``
    (absent: the fallback model), search the full grid of its best tunable
    model, find the business threshold on an inner validation part (with early
    stopping for a boosted model), refit the best parameters on the whole
    training block, compare baseline, tuned at 0.5 and tuned at the business
    threshold on the untouched holdout, and write the scored test clients.
    Returns the comparison table."""
    from ..sources.files import read_or_empty, write_parquet
    grids = J.GRIDS if grids is None else grids
    board = read_or_empty(spark, f"{work_dir}/leaderboard", LEADERBOARD_SCHEMA)
    best = board.where(F.col("model").isin(*grids)).orderBy("rank").limit(1).collect()
    name = best[0]["model"] if best else FALLBACK_MODEL
    tr, ho, te, _ = matrix or model_matrix(spark, sf)
    search, params = J.grid_search(name, tr, ["id"], "y", 3, grids=grids)
    thr, final, _ = J.tuned_threshold(name, tr, ["id"], params=params, seed=SEED + 3)
    (base, _), (tuned, _) = J.fit_each(name, [tr, tr], "y", params=[None, final])
    comp = compare_versions(ho, base, tuned, thr)
    write_parquet(J.scoring_table(tuned, te, "id", thr), f"{work_dir}/test_scores")
    write_parquet(search, f"{work_dir}/search")
    return comp.withColumns({"selected_model": F.lit(name), "final_params": F.lit(J.params_text(final)),
                             "business_threshold": F.lit(float(thr))})


def q_optimise_and_score(spark: SparkSession, sf: str) -> DataFrame:
    """Entry points 2 and 3 in a row: the second reads what the first wrote."""
    work = _work_dir(spark, "optimise")
    matrix = model_matrix(spark, sf)
    baseline_benchmark(spark, sf, work, matrix=matrix)
    return optimise_and_score(spark, sf, work, matrix=matrix)


# --- A10 run metrics ------------------------------------------------------------------------------
def q_run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    tr, ho, _, _ = model_matrix(spark, sf)
    m, _ = J.holdout_evaluation("logistic", tr, ho, "y")
    return long_metrics(m, "run-logistic", "baseline", "split")


QUERIES = {
    "extra_trees": q_extra_trees, "leafwise": q_leafwise, "leafwise_stopping": q_leafwise_stopping, "tree_contrib": q_tree_contrib,
    "tree_local_contrib": q_tree_local_contrib, "random_search": q_random_search,
    "majority": q_majority, "logistic": q_logistic, "gbt": q_gbt, "forest": q_forest,
    "cv_logistic": q_cv_logistic, "grid_search": q_grid_search, "learning_curve": q_learning_curve,
    "early_stopping": q_early_stopping, "comparison": q_comparison, "test_scoring": q_test_scoring,
    "svc": q_svc, "fold_sample": q_fold_sample, "cv_split": q_cv_split, "oof_confusion": q_oof_confusion,
    "regression_fit": q_regression_fit, "regression_folds": q_regression_folds, "modeling_tables": q_modeling_tables,
    "linear_importance": q_linear_importance, "local_contrib": q_local_contrib,
    "native_importance": q_native_importance, "permutation_importance": q_permutation_importance,
    "linear_contrib": q_linear_contrib, "run_metrics": q_run_metrics,
    "full_dataset": q_full_dataset, "baseline_benchmark": q_baseline_benchmark,
    "optimise_and_score": q_optimise_and_score,
}
ORACLES = {"majority": sql_majority, "full_dataset": sql_full_dataset, "modeling_tables": sql_modeling_tables}
