"""Models trained and scored with ``pyspark.ml`` (J1-J13) and the model
evaluation loops (K10, K12, K18, K22, K24).

Learners are distributed Spark estimators; the evaluation of their scores
reuses the pure aggregations of ``metrics``.  A fold loop fits one model per
fold (each fit is itself a distributed job); scoring and metric computation
for all folds is one grouped aggregation.
"""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import attribution as A
from . import extratrees as X
from . import leafwise as W
from . import manyfit as M
from . import metrics as K
from .encode import balanced_class_weight
from .split import exact_sample, holdout, kfold as kfold_column, stratified_holdout

FEATURES = "features"

# --- J7: model catalog (fixed descriptive values) -------------------------------------
CATALOG = [
    ("majority", "baseline", "reference", "most frequent class: the floor any model must beat"),
    ("logistic", "linear", "baseline", "imputed, scaled, class-weighted logistic regression"),
    ("gbt", "boosting", "candidate", "gradient-boosted trees (histogram boosting analogue)"),
    ("gbt_leafwise", "boosting", "candidate", "leaf-wise boosted trees, sub-sampled rows and columns, class weights"),
    ("forest", "bagging", "candidate", "random forest with class weights"),
    ("extra_trees", "bagging", "candidate", "extremely randomised trees with class weights"),
    ("linear_svc", "linear", "baseline", "linear SVM; margin min-max scaled into [0, 1]"),
]


def model_catalog(spark) -> DataFrame:
    return spark.createDataFrame(CATALOG, "model string, family string, scope string, why string")


# --- J1-J6 ------------------------------------------------------------------------
def build_estimator(name: str, label: str = "y", weight: str | None = "weight", seed: int = 42,
                    params: Mapping[str, object] | None = None):
    """Estimator for a catalog name, with the reference configuration;
    ``params`` overrides single settings (a tuned point, or small settings in
    a test)."""
    kw = {"featuresCol": FEATURES, "labelCol": label}
    weighted = {"weightCol": weight} if weight else {}
    if name == "logistic":
        est = LogisticRegression(**kw, **weighted, regParam=1e-4, elasticNetParam=0.0, maxIter=2000, tol=1e-3,
                                 standardization=True)  # tol: the reference learner's default tolerance
    elif name == "gbt":
        est = GBTClassifier(**kw, stepSize=0.05, maxIter=300, minInstancesPerNode=100, seed=seed)
    elif name == "forest":
        est = RandomForestClassifier(**kw, **weighted, numTrees=400, minInstancesPerNode=20, seed=seed)
    elif name == "linear_svc":
        est = LinearSVC(**kw, **weighted, maxIter=100)
    elif name == "majority":
        return None
    else:
        raise ValueError(f"unknown model {name!r}; expected one of {[c[0] for c in CATALOG]}")
    return est.copy({est.getParam(k): v for k, v in (params or {}).items()})


def assemble(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Feature vector for ``pyspark.ml`` (NULLs must be imputed before)."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=FEATURES, handleInvalid="error").transform(df)


def _row_key(df: DataFrame) -> str:
    """The column that tells rows apart (bagging draws by it)."""
    return "id" if "id" in df.columns else df.columns[0]


def fit(name: str, train: DataFrame, label: str = "y", balanced: bool = True, seed: int = 42,
        params: Mapping[str, object] | None = None):
    """Fit a catalog model on an assembled frame; returns (model, seconds)."""
    t0 = time.perf_counter()
    if name == "majority":
        row = train.groupBy(label).count().orderBy(F.col("count").desc(), F.col(label).asc()).first()
        model = ("majority", int(row[label]))
    elif name == "extra_trees":
        model = X.fit_extra_trees(train, params, label, FEATURES, balanced, seed)
    elif name == "gbt_leafwise":
        model = W.fit_leafwise(train, [F.lit(True)], [params or {}], _row_key(train), label, FEATURES, balanced, seed=seed)[0]
    else:
        data = balanced_class_weight(train, label, "weight") if balanced else train
        model = build_estimator(name, label, "weight" if balanced else None, seed, params).fit(data)
    return model, time.perf_counter() - t0


# Learners of very many short jobs (a step a job): fits of one flow run side by side.
SIDE_BY_SIDE = ("linear_svc", "logistic")


def fit_each(name: str, frames: Sequence[DataFrame], label: str = "y", seed: int = 42,
             params: Sequence[Mapping[str, object] | None] = (None,)) -> list[tuple]:
    """``fit`` of every frame with its parameters, in their order.  A fit's
    seconds are its own from start to end, also beside others."""
    todo = list(zip(frames, params if len(params) == len(frames) else [*params] * len(frames)))
    if name not in SIDE_BY_SIDE or len(todo) == 1:
        return [fit(name, f, label, seed=seed, params=p) for f, p in todo]
    with ThreadPool(min(len(todo), 4)) as pool:
        return pool.map(inheritable_thread_target(frames[0].sparkSession)(lambda x: fit(name, x[0], label, seed=seed, params=x[1])), todo, 1)


def score(model, df: DataFrame, keep: Sequence[str] = ("id", "y"), name: str = "score") -> DataFrame:
    """Probability of class 1; a model without probabilities (linear SVM)
    gives its margin min-max scaled (B22); the majority model a constant."""
    if isinstance(model, tuple) and model[0] == "majority":
        return df.select(*keep, F.lit(float(model[1])).alias(name))
    if isinstance(model, W.Booster):
        return W.score_leafwise(model, df, keep, FEATURES, name)
    if isinstance(model, X.RandomForest):
        return X.score_extra_trees(model, df, keep, FEATURES, name)
    out = model.transform(df)
    if "probability" in out.columns:
        return out.select(*keep, vector_to_array("probability")[1].alias(name))
    margin = vector_to_array("rawPrediction")[1]
    mm = out.agg(F.min(margin).alias("mn"), F.max(margin).alias("mx")).first()
    return out.select(*keep, ((margin - F.lit(mm["mn"])) / F.lit(mm["mx"] - mm["mn"] + 1e-12)).alias(name))


def _needed(df: DataFrame, key: Sequence[str], label: str) -> DataFrame:
    """What the loops read of a frame: splits and folds move whole rows."""
    return df.select(*dict.fromkeys([*key, *(["id"] if "id" in df.columns else []), label, FEATURES]))


# --- K10 / K12 / K18 ---------------------------------------------------------------
def logistic_point(params: Mapping[str, object] | None = None) -> dict:
    """The penalty of the logistic candidate with overrides."""
    est = build_estimator("logistic", params=params)
    return {"regParam": est.getRegParam(), "elasticNetParam": est.getElasticNetParam()}


def _fold_models(d: DataFrame, k: int, points: Sequence[Mapping[str, object]], label: str) -> dict:
    """{(fold, point): model fitted on the other folds}, in shared scans."""
    return M.fit_logistic(d, [F.col("fold") != f for f in range(k)], [logistic_point(p) for p in points], label, FEATURES)


def cross_validate(name: str, data: DataFrame, key: Sequence[str], k: int = 3, label: str = "y",
                   seed: int = 42, threshold: float = 0.5, params: Mapping[str, object] | None = None,
                   train_sample: int | None = None) -> DataFrame:
    """Per fold: fit on the other folds, score train and valid rows; metrics of
    every (fold, split) in one grouped aggregation over one table of scores,
    plus the fit time.  ``train_sample`` (H9) scores an exact sample of that
    many training rows instead of all of them (seed + fold)."""
    d = cut_lineage(kfold_column(_needed(data, key, label), key, k, seed, label=label))
    scored, times = None, {}
    if name == "logistic":
        started = time.perf_counter()
        models = _fold_models(d, k, [params or {}], label)
        times = dict.fromkeys(range(k), (time.perf_counter() - started) / k)   # the folds share their scans
        rows = d.withColumn("_of", F.sequence(F.lit(0), F.lit(k - 1)) if train_sample is None else F.array("fold"))
        if train_sample:
            for f in range(k):
                rows = rows.unionByName(exact_sample(d.where(F.col("fold") != f), train_sample, key, seed + f).withColumn("_of", F.array(F.lit(f))))
        scored = M.score_many(rows, [models[f, 0] for f in range(k)], F.col("_of"), [*key, label, "fold"])
        scored = (scored.withColumn("split", F.when(F.col("fold") == F.col("model"), "valid").otherwise("train"))
                  .drop("fold").withColumnRenamed("model", "fold"))
    fitted = fit_each(name, [d.where(F.col("fold") != f) for f in range(k)], label, seed, [params]) if name != "logistic" else ()
    for f, (model, secs) in enumerate(fitted):
        tr = d.where(F.col("fold") != f)
        va = d.where(F.col("fold") == f)
        times[f] = secs
        tr_eval = exact_sample(tr, train_sample, key, seed + f) if train_sample else tr
        part = (score(model, tr_eval, [*key, label]).withColumn("split", F.lit("train"))
                .unionByName(score(model, va, [*key, label]).withColumn("split", F.lit("valid")))
                .withColumn("fold", F.lit(f)))
        scored = part if scored is None else scored.unionByName(part)
    if name != "logistic":
        scored = cut_lineage(scored)                       # the metrics' filters would work out a model's scores again
    m = K.classification_metrics(scored, y=label, threshold=threshold, by=["fold", "split"])
    spark = data.sparkSession
    t = spark.createDataFrame([(f, float(s)) for f, s in times.items()], "fold int, fit_time_sec double")
    return m.join(F.broadcast(t), "fold")  # k rows


def out_of_fold(name: str, data: DataFrame, key: Sequence[str], k: int = 3, label: str = "y", seed: int = 42,
                params: Mapping[str, object] | None = None) -> DataFrame:
    """Every row's score by the model of the other folds: (key, y, fold,
    score)."""
    d = cut_lineage(kfold_column(_needed(data, key, label), key, k, seed, label=label))
    if name == "logistic":
        models = _fold_models(d, k, [params or {}], label)
        return M.score_many(d, [models[f, 0] for f in range(k)], F.array("fold"), [*key, label, "fold"]).drop("model")
    out = None
    for f in range(k):
        model, _ = fit(name, d.where(F.col("fold") != f), label, seed=seed, params=params)
        part = score(model, d.where(F.col("fold") == f), [*key, label, "fold"])
        out = part if out is None else out.unionByName(part)
    return out


def cross_validate_split(name: str, data: DataFrame, key: Sequence[str], k: int = 5, label: str = "y", seed: int = 42,
                         test_pct: int = 20, threshold: float = 0.5, params: Mapping[str, object] | None = None):
    """The second CV routine: cross-validation inside a stratified training
    part with population std, the model refitted on that whole part, and its
    holdout metrics; values rounded to 4 digits.  Returns (summary, holdout
    metrics, model)."""
    d = cut_lineage(stratified_holdout(_needed(data, key, label), label, key, test_pct, seed))
    tr, te = d.where("is_test = 0").drop("is_test"), d.where("is_test = 1").drop("is_test")
    folds = cross_validate(name, tr, key, k, label, seed, threshold, params)
    summary = K.cv_summary(folds, K.METRICS, population=True)
    model, _ = fit(name, tr, label, seed=seed, params=params)
    hold = K.classification_metrics(score(model, te, [*key, label]), y=label, threshold=threshold)

    def rounded(df):
        return df.withColumns({f.name: F.round(f.name, 4) for f in df.schema.fields if f.dataType.simpleString() == "double"})
    return rounded(summary), rounded(hold), model


def holdout_evaluation(name: str, train: DataFrame, holdout: DataFrame, label: str = "y",
                       key: Sequence[str] = ("id",), threshold: float = 0.5,
                       params: Mapping[str, object] | None = None):
    """Fit on train, metrics on train and holdout; returns (metrics, model)."""
    model, secs = fit(name, train, label, params=params)
    s = (score(model, train, [*key, label]).withColumn("split", F.lit("train"))
         .unionByName(score(model, holdout, [*key, label]).withColumn("split", F.lit("test"))))
    s = cut_lineage(s)                                     # the metrics' filters would work out the scores again
    m = K.classification_metrics(s, y=label, threshold=threshold, by=["split"])
    return m.withColumn("fit_time_sec", F.lit(secs)), model


def learning_curve(name: str, data: DataFrame, key: Sequence[str], label: str = "y", k: int = 3,
                   sizes: Sequence[int] = (20, 40, 60, 80, 100), seed: int = 42,
                   params: Mapping[str, object] | None = None) -> DataFrame:
    """ROC-AUC on train and valid for nested seeded training subsets
    (size % of each training fold), mean and std over folds."""
    from .rank import hash_rank
    d = kfold_column(data, key, k, seed, label=label)
    rows = None
    if name == "logistic":
        # a row's place in each fold's training order, and from it the subsets that hold it
        for f in range(k):
            order = hash_rank(d.where(F.col("fold") != f).select(*key), key, seed + 1000 + f, name=f"_r{f}")
            d = d.join(order, list(key), "left")
        d = cut_lineage(d)
        sizes_of = [(f, pct) for f in range(k) for pct in sizes]
        n = d.agg(*[F.max(f"_r{f}") for f in range(k)]).first()
        inside = [F.coalesce(F.col(f"_r{f}") <= (n[f] * pct + 99) // 100, F.lit(False)) for f, pct in sizes_of]
        models = M.fit_logistic(d, inside, [logistic_point(params)], label, FEATURES)
        wanted = F.filter(F.array(*[F.when(inside[i] | (F.col("fold") == f), F.lit(i)) for i, (f, _) in enumerate(sizes_of)]), lambda i: i.isNotNull())
        scored = M.score_many(d, [models[i, 0] for i in range(len(sizes_of))], wanted, [*key, label, "fold"])
        of = F.element_at(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(p).alias("p")) for f, p in sizes_of]), F.col("model") + 1)
        rows = scored.select(label, "score", F.when(F.col("fold") == of["f"], "valid").otherwise("train").alias("split"),
                             of["f"].alias("fold"), of["p"].alias("train_pct"))
    for f in range(k) if name != "logistic" else ():
        tr = cut_lineage(hash_rank(d.where(F.col("fold") != f), key, seed + 1000 + f, name="_r"))
        n = tr.count()
        va = d.where(F.col("fold") == f)
        for pct in sizes:
            sub = tr.where(F.col("_r") <= F.lit((n * pct + 99) // 100)).drop("_r")
            model, _ = fit(name, sub, label, seed=seed, params=params)
            part = (score(model, sub, [*key, label]).withColumn("split", F.lit("train"))
                    .unionByName(score(model, va, [*key, label]).withColumn("split", F.lit("valid")))
                    .withColumn("fold", F.lit(f)).withColumn("train_pct", F.lit(pct)))
            rows = part if rows is None else rows.unionByName(part)
    r = K.rank_metrics(rows, y=label, by=["train_pct", "split", "fold"])
    return r.groupBy("train_pct", "split").agg(F.avg("roc_auc").alias("roc_auc_mean"),
                                               F.stddev_samp("roc_auc").alias("roc_auc_std"))


def scoring_table(model, test: DataFrame, key: str, best_threshold: float) -> DataFrame:
    """Id, probability, label at 0.5 and at the business threshold."""
    s = score(model, test, [key], "TARGET_PROBA")
    return s.select(key, "TARGET_PROBA",
                    (F.col("TARGET_PROBA") >= 0.5).cast("int").alias("TARGET_PRED_DEFAULT_0_5"),
                    (F.col("TARGET_PROBA") >= F.lit(float(best_threshold))).cast("int")
                    .alias("TARGET_PRED_BUSINESS_THRESHOLD"))


# --- J8 / J10 / J11 / J13 ---------------------------------------------------------------
# The tuning grids (learning rate, iterations, leaf size, share of
# features and regularisation points of the reference, in Spark's names).
GRIDS = {
    "logistic": {"regParam": [1e-5, 1e-4, 1e-3], "elasticNetParam": [0.0, 0.15]},
    "gbt": {"stepSize": [0.03, 0.05], "maxIter": [200, 300], "minInstancesPerNode": [50, 100]},
    "gbt_leafwise": {"learning_rate": [0.03, 0.05], "max_leaves": [31, 63], "min_child": [20, 100], "l2": [0.0, 1.0]},
    "forest": {"numTrees": [300, 500], "minInstancesPerNode": [10, 20], "featureSubsetStrategy": ["sqrt", "0.5"]},
    "extra_trees": {"n_trees": [300, 500], "min_leaf": [10, 20], "max_features": ["sqrt", 0.5]},
}


def param_grid(name: str, grids: Mapping[str, Mapping[str, Sequence]] | None = None, max_points: int | None = None,
               seed: int = 42) -> list[dict]:
    """The points of the full grid, or a seeded random subset of
    ``max_points`` (a random search, when the caller asks for one)."""
    grids = GRIDS if grids is None else grids
    if name not in grids:
        raise ValueError(f"no tuning grid for {name!r}")
    names = list(grids[name])
    points = [dict(zip(names, values)) for values in itertools.product(*grids[name].values())]
    if max_points and max_points < len(points):
        points = random.Random(seed).sample(points, max_points)
    return points


def grid_guide(spark, name: str) -> DataFrame:
    g = GRIDS[name]
    size = 1
    for v in g.values():
        size *= len(v)
    return spark.createDataFrame([(name, p, str(v), size) for p, v in g.items()],
                                 "model string, param string, values string, grid_size int")


def params_text(params: Mapping[str, object]) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(params.items()))


def grid_search(name: str, data: DataFrame, key: Sequence[str], label: str = "y", k: int = 3,
                grids: Mapping[str, Mapping[str, Sequence]] | None = None, max_points: int | None = None,
                seed: int = 42, lo: int = 5, hi: int = 95) -> tuple[DataFrame, dict]:
    """Cross-validated search.  Every grid point is fitted on
    the other folds of each fold (class weights from those rows only) and
    scores that fold; all scores are one table, from which one aggregation
    each gives the business cost at the fold's best threshold, average
    precision, ROC-AUC and recall.  Returns the search table (one row per point:
    params, the mean scores and their ranks, best first) and the parameters of
    the best point."""
    points = param_grid(name, grids, max_points, seed)
    d = cut_lineage(kfold_column(_needed(data, key, label), key, k, seed, label=label))
    scored = None
    if name == "logistic":                                 # all points and folds in shared scans
        models = _fold_models(d, k, points, label)
        every = F.transform(F.sequence(F.lit(0), F.lit(len(points) - 1)), lambda i: i * k + F.col("fold"))
        scored = (M.score_many(d, [models[f, i] for i in range(len(points)) for f in range(k)], every, [label, "fold"])
                  .withColumn("point", (F.col("model") / k).cast("int")).drop("model"))
    elif name == "gbt_leafwise":
        pairs = [(i, f) for i in range(len(points)) for f in range(k)]
        models = W.fit_leafwise(d, [F.col("fold") != f for _, f in pairs], [points[i] for i, _ in pairs], key[0], label, FEATURES, seed=seed)
        for (i, f), model in zip(pairs, models):
            part = score(model, d.where(F.col("fold") == f), [label]).withColumns({"point": F.lit(i), "fold": F.lit(f)})
            scored = part if scored is None else scored.unionByName(part)
    for i, params in enumerate(points) if name not in ("logistic", "gbt_leafwise") else ():
        for f in range(k):
            model, _ = fit(name, d.where(F.col("fold") != f), label, seed=seed, params=params)
            part = score(model, d.where(F.col("fold") == f), [label]).withColumns({"point": F.lit(i), "fold": F.lit(f)})
            scored = part if scored is None else scored.unionByName(part)
    scored = cut_lineage(scored)
    by = ["point", "fold"]
    cost = K.least_cost(scored, label, "score", by, lo, hi)
    rest = K.classification_metrics(scored, label, "score", by=by).select(*by, "pr_auc", "roc_auc", "recall")
    means = rest.join(cost, by).groupBy("point").agg(
        F.avg("least_cost_per_obs").alias("mean_business_cost"), F.avg("pr_auc").alias("mean_average_precision"),
        F.avg("roc_auc").alias("mean_roc_auc"), F.avg("recall").alias("mean_recall"))
    spark = data.sparkSession
    listed = spark.createDataFrame([(i, name, params_text(p)) for i, p in enumerate(points)], "point int, model string, params string")

    def rank(c, descending=True):
        return F.rank().over(Window.orderBy(F.col(c).desc() if descending else F.col(c).asc()))  # one row per point
    table = cut_lineage(listed.join(means, "point").withColumns({
        "rank_business_cost": rank("mean_business_cost", False), "rank_average_precision": rank("mean_average_precision"),
        "rank_roc_auc": rank("mean_roc_auc"), "rank_recall": rank("mean_recall")}))
    table = table.orderBy("rank_business_cost", "rank_average_precision", "point")
    return table, points[table.first()["point"]]


BOOSTED = ("gbt", "gbt_leafwise")


def prefix_aucs(model, valid: DataFrame, label: str = "y") -> DataFrame:
    """(n_trees, roc_auc) of every prefix of a boosted model: the margins after
    each tree are one exploded table, with one grouped rank aggregate."""
    if isinstance(model, W.Booster):
        return valid.sparkSession.createDataFrame([(i + 1, float(a)) for i, a in enumerate(model.auc)], "n_trees int, roc_auc double")
    leaves = A.leaf_paths(A.ensemble_nodes(model, valid.sparkSession))
    margins = A.prefix_margins(leaves, valid, [label], FEATURES)
    each = margins.select(label, F.posexplode("margins").alias("at", "score")).withColumn("n_trees", F.col("at") + 1)
    return K.rank_metrics(each, y=label, by=["n_trees"]).select("n_trees", "roc_auc")


def early_stopped(name: str, train: DataFrame, valid_col: str, label: str = "y", params: Mapping[str, object] | None = None,
                  patience: int = 50, seed: int = 42):
    """Boosting on the rows where ``valid_col`` is false; the number of trees
    is that of the best AUC on the others, before an AUC ``patience`` trees old
    has not been beaten.  The leaf-wise learner stops growing there; the other
    one grows all its trees, and the rule is applied to its prefixes.  Returns
    (model, number of trees)."""
    if name == "gbt_leafwise":
        model = W.fit_leafwise(train, [~F.col(valid_col)], [params or {}], _row_key(train), label, FEATURES,
                               valid=F.col(valid_col), patience=patience, seed=seed)[0]
        return model, len(model.trees)
    model = build_estimator(name, label, None, seed, params).fit(train.where(~F.col(valid_col)))
    best, at = -1.0, 0
    for r in prefix_aucs(model, train.where(F.col(valid_col)), label).orderBy("n_trees").collect():    # one row per tree
        if (r["roc_auc"] or 0.0) > best:
            best, at = r["roc_auc"] or 0.0, r["n_trees"]
        elif r["n_trees"] - at >= patience:
            break
    return model, at


def tuned_threshold(name: str, data: DataFrame, key: Sequence[str], label: str = "y",
                    params: Mapping[str, object] | None = None, valid_pct: int = 20, seed: int = 42,
                    lo: int = 10, hi: int = 90) -> tuple[float, dict, DataFrame]:
    """The business threshold, found on an inner validation part that
    the model has not seen, and the parameters of the final fit: those given,
    with the early-stopped number of trees for a boosted model.  Returns
    (threshold, final parameters, threshold table)."""
    inner = cut_lineage(stratified_holdout(_needed(data, key, label), label, key, valid_pct, seed, name="is_valid")
                        .withColumn("is_valid", F.col("is_valid").cast("boolean")))
    final = dict(params or {})
    if name in BOOSTED:
        model, trees = early_stopped(name, inner, "is_valid", label, params, seed=seed)
        final["n_iter" if name == "gbt_leafwise" else "maxIter"] = int(trees)
    else:
        model, _ = fit(name, inner.where("not is_valid").drop("is_valid"), label, seed=seed, params=params)
    table = K.threshold_search(score(model, inner.where("is_valid"), [*key, label]), label, lo=lo, hi=hi)
    table = cut_lineage(table)
    return float(K.best_threshold(table).first()["threshold"]), final, table


# --- K16 / K17 with a model -------------------------------------------------------------
def fit_regression(train: DataFrame, label: str = "y", params: Mapping[str, object] | None = None):
    est = LinearRegression(featuresCol=FEATURES, labelCol=label)
    return est.copy({est.getParam(k): v for k, v in (params or {}).items()}).fit(train)


def regression_evaluation(data: DataFrame, key: Sequence[str], label: str = "y", test_pct: int = 20, seed: int = 42,
                          params: Mapping[str, object] | None = None):
    """Seeded split, fit, metrics on train and test: one row per split.
    Returns (metrics, model)."""
    d = holdout(data, key, test_pct, seed)
    model = fit_regression(d.where("is_test = 0"), label, params)
    s = model.transform(d).select(F.when(F.col("is_test") == 1, "test").otherwise("train").alias("split"),
                                  F.col(label).alias("y"), F.col("prediction").alias("yhat"))
    return K.regression_metrics(s, by=["split"]), model


def regression_cross_validate(data: DataFrame, key: Sequence[str], label: str = "y", k: int = 5, seed: int = 42,
                              params: Mapping[str, object] | None = None) -> DataFrame:
    """Metrics of every (fold, split)."""
    d = cut_lineage(kfold_column(data, key, k, seed))
    out = None
    for f in range(k):
        model = fit_regression(d.where(F.col("fold") != f), label, params)
        s = model.transform(d).select(F.when(F.col("fold") == f, "valid").otherwise("train").alias("split"),
                                      F.lit(f).alias("fold"), F.col(label).alias("y"), F.col("prediction").alias("yhat"))
        out = s if out is None else out.unionByName(s)
    return K.regression_metrics(out, by=["fold", "split"])
