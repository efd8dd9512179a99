"""Hand-computed cases for rules that plain data does not exercise."""

import math
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import blocks as B
from riskframe.operators import encode as E
from riskframe.operators import explain as L
from riskframe.operators import metrics as K
from riskframe.operators import models as J
from riskframe.operators import profile as P
from riskframe.operators.aggspec import aggregate_block
from riskframe.operators.assoc import chi2_sf, spearman_matrix
from riskframe.operators.joins import join_audit
from riskframe.operators.quantiles import exact_quantiles
from riskframe.operators.split import holdout, kfold, stratified_holdout
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources import files as A

NAN, INF = float("nan"), float("inf")


def close(a, b, tol=1e-9):
    return abs(a - b) <= tol * max(1.0, abs(b))


# --- missing values ---------------------------------------------------------------
def test_nan_and_inf_are_missing_in_every_aggregate(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", NAN), ("a", 3.0), ("b", INF), ("b", 2.0), ("c", NAN)], "k string, x double")
    r = {x["k"]: x for x in aggregate_block(df, "k", "P", {"x": ["min", "max", "mean", "sum", "nunique"]}).collect()}
    assert [r["a"][f"P_x_{n}"] for n in ("MIN", "MAX", "MEAN", "SUM", "NUNIQUE")] == [1.0, 3.0, 2.0, 4.0, 2]
    assert r["b"]["P_x_MAX"] == 2.0 and r["c"]["P_x_MAX"] is None and r["c"]["P_x_NUNIQUE"] == 0


def test_nan_and_inf_in_fitted_transforms(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (NAN,), (INF,)], "x double")
    imputed = [r["x"] for r in E.MedianImputer(["x"]).fit(df).transform(df).collect()]
    assert imputed == [1.0, 2.0, 3.0, 2.0, 2.0]
    scaler = E.StandardScaler(["x"]).fit(df)
    assert close(scaler.stats["x"][0], 2.0) and close(scaler.stats["x"][1], math.sqrt(2 / 3))
    clipped = [r["x"] for r in E.Winsorizer(0.0, 1.0, ["x"]).fit(df).transform(df).collect()]
    assert clipped == [1.0, 2.0, 3.0, None, 3.0]
    with pytest.raises(AssertionError):
        P.assert_no_nulls(df)
    P.assert_no_nulls(E.MedianImputer(["x"]).fit(df).transform(df))


def test_quantiles_end_with_inf_and_crowded_values(spark):
    values = [INF, -INF, NAN, 1e300, -1e300] + [1.0 + i * 1e-15 for i in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, ["x"], [0.0, 0.5, 1.0], bins=4, exact_below=3).collect()
    finite = sorted(v for v in values if math.isfinite(v))
    assert [r["value"] for r in got] == [finite[0], float(np.quantile(finite, 0.5)), finite[-1]]


def test_rows_without_label_or_score_are_left_out_everywhere(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.4), (0, 0.1)]
    clean = spark.createDataFrame(rows, "y int, score double")
    holes = spark.createDataFrame(rows + [(1, None), (0, None), (None, 0.7), (1, NAN)], "y int, score double")
    for f in (K.confusion_counts, K.rank_metrics, K.classification_metrics, K.pr_curve):
        assert sorted(map(tuple, f(clean).collect())) == sorted(map(tuple, f(holes).collect()))
    assert K.threshold_search(clean).orderBy("threshold").collect() == K.threshold_search(holes).orderBy("threshold").collect()
    r = K.classification_metrics(holes).first()
    assert (r["accuracy"], r["recall"], r["roc_auc"]) == (0.5, 0.5, 0.75)


def test_null_groups_and_labels_keep_their_rows(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 2).cast("int").alias("y"))
    for out, name in ((kfold(df, ["id"], 4, label="y"), "fold"), (stratified_holdout(df, "y", ["id"]), "is_test")):
        rows = out.collect()
        assert len(rows) == 100 and all(r[name] is not None for r in rows)
        assert sum(r["y"] is None for r in rows) == 20
    assert stratified_holdout(df, "y", ["id"]).where("y is null and is_test = 1").count() == 4
    assert holdout(df, ["id"], 25).agg(F.sum("is_test")).first()[0] == 25
    scored = spark.createDataFrame([(None, 1, .9), (None, 0, .1), ("g", 1, .2), ("g", 0, .8)], "g string, y int, score double")
    assert {r["g"]: r["roc_auc"] for r in K.classification_metrics(scored, by=["g"]).collect()} == {None: 1.0, "g": 0.0}
    weighted = E.balanced_class_weight(df, "y").where("y is null").select("weight").distinct().collect()
    assert weighted[0][0] is None


# --- evaluation -------------------------------------------------------------------
def test_cost_gain_is_positive_when_the_cost_falls(spark):
    df = spark.createDataFrame([("base", 0.8, 0.5), ("tuned", 0.6, 0.7)], "v string, business_cost_per_obs double, pr_auc double")
    r = {x["v"]: x for x in K.gains_vs_baseline(df, "v", "base", ["business_cost_per_obs", "pr_auc"]).collect()}
    assert close(r["tuned"]["gain_business_cost_per_obs"], 0.2) and close(r["tuned"]["gain_pr_auc"], 0.2)


def test_least_cost_equals_the_search(spark):
    rows = [(i % 3, int((i * 7) % 11 < 4), ((i * 37) % 101) / 100) for i in range(300)] + [(9, 1, 0.01), (9, 0, 0.02), (8, 0, 0.99), (8, 0, 0.97)]
    df = spark.createDataFrame(rows, "g int, y int, score double")
    got = {r["g"]: r["least_cost_per_obs"] for r in K.least_cost(df, "y", "score", ["g"]).collect()}
    for g in (0, 1, 2, 9, 8):
        best = K.threshold_search(df.where(F.col("g") == g), ranks=False).agg(F.min("business_cost_per_obs")).first()[0]
        assert close(got[g], best), g


def test_chi_square_tail_keeps_small_values(spark):
    df = spark.createDataFrame([(60.0, 1), (75.0, 1), (90.0, 1), (3.84, 1), (300.0, 4)], "x double, d int")
    p = [r[0] for r in df.select(chi2_sf(F.col("x"), F.col("d"))).collect()]
    want = [math.erfc(math.sqrt(x / 2)) for x in (60.0, 75.0, 90.0, 3.84)] + [math.exp(-150) * 151]
    assert all(abs(a - b) <= 1e-12 * b for a, b in zip(p, want))


def test_spearman_with_nulls_ties_and_a_constant(spark):
    rows = [(1.0, 10.0, None, 5.0), (2.0, 9.0, 3.0, 5.0), (2.0, 8.0, 4.0, 5.0), (4.0, None, 1.0, 5.0), (5.0, 1.0, 9.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    import pandas as pd
    want = pd.DataFrame(rows, columns=list("abck")).astype(float).corr(method="spearman")
    got = {(r["var_a"], r["var_b"]): r["spearman"] for r in spearman_matrix(df, ["a", "b", "c", "k"]).collect()}
    assert set(got) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert all(close(v, want.loc[a, b]) for (a, b), v in got.items())


# --- models -----------------------------------------------------------------------
@pytest.fixture(scope="module")
def learned(spark):
    rng = np.random.RandomState(0)
    x1, x2, x3 = rng.normal(0, 1000, 600), rng.normal(0, 0.01, 600), rng.normal(0, 1, 600)
    y = (3.3 * x1 / 1000 + 0.9 * x2 / 0.01 + rng.logistic(0, 1, 600) > 0).astype(int)
    feats = ["strong", "weak", "noise"]
    df = spark.createDataFrame([(i, int(y[i]), float(x1[i]), float(x2[i]), float(x3[i])) for i in range(600)],
                               "id long, y int, strong double, weak double, noise double")
    return J.assemble(df, feats).cache(), feats


SMALL = {"maxIter": 5, "minInstancesPerNode": 5}


def test_linear_importance_and_contributions_use_the_inputs_scale(spark, learned):
    data, feats = learned
    model, _ = J.fit("logistic", data)
    stats = E.StandardScaler(feats).fit(data).stats
    order = [r["feature"] for r in L.native_importance(model, feats, spark, {c: v[1] for c, v in stats.items()}).collect()]
    assert order == ["strong", "weak", "noise"]
    means = {c: v[0] for c, v in stats.items()}
    local, glob = L.linear_contributions(model, data, feats, "id", means)
    margin = model.intercept + sum(w * means[c] for w, c in zip(model.coefficients, feats))
    probability = {r["id"]: r["score"] for r in J.score(model, data).collect()}
    for r in local.collect()[:50]:
        z = margin + sum(r[f"contrib_{c}"] for c in feats)
        assert close(1 / (1 + math.exp(-z)), probability[r["id"]], 1e-6)
    assert [r["feature"] for r in glob.collect()] == ["strong", "weak", "noise"]
    assert L.local_explanation(local, "id", 7).count() == 3


def test_permutation_importance_covers_every_column(spark, learned):
    data, feats = learned
    model, _ = J.fit("logistic", data)
    rows = {r["feature"]: r for r in L.permutation_importance(model, data, feats, "id", n_repeats=2, metric="roc_auc").collect()}
    assert set(rows) == set(feats) and rows["strong"]["importance_mean"] > rows["weak"]["importance_mean"] > rows["noise"]["importance_mean"] - 0.01
    again = {r["feature"]: r for r in L.permutation_importance(model, data.repartition(5), feats, "id", n_repeats=2, metric="roc_auc").collect()}
    assert all(close(rows[c]["importance_mean"], again[c]["importance_mean"]) for c in feats)


def test_grid_search_returns_the_best_point(spark, learned):
    data, _ = learned
    table, best = J.grid_search("logistic", data, ["id"], k=2, grids={"logistic": {"regParam": [1e-4, 1e6], "elasticNetParam": [0.0]}})
    rows = table.collect()
    assert len(rows) == 2 and best["regParam"] == 1e-4 and rows[0]["params"] == J.params_text(best)
    assert rows[0]["rank_business_cost"] == 1 and {"mean_average_precision", "mean_roc_auc", "mean_recall"} <= set(table.columns)
    assert len(J.param_grid("gbt")) == 8 and len(J.param_grid("gbt", max_points=3)) == 3


def test_boosting_early_stop_threshold_and_margins(spark, learned):
    data, _ = learned
    thr, final, table = J.tuned_threshold("gbt", data, ["id"], params={"maxIter": 6, "minInstancesPerNode": 5})
    assert 0.1 <= thr <= 0.9 and 1 <= final["maxIter"] <= 6 and table.count() == 81
    model, _ = J.fit("gbt_leafwise", data, params={"n_iter": 4})                     # J4
    assert 0 <= J.score(model, data).agg(F.min("score")).first()[0]
    svc, _ = J.fit("linear_svc", data, params={"maxIter": 5})                # J9, no probabilities
    lo, hi = J.score(svc, data).agg(F.min("score"), F.max("score")).first()
    assert lo == 0.0 and close(hi, 1.0, 1e-6)
    with pytest.raises(ValueError):
        J.param_grid("majority")


def test_cross_validation_routines(spark, learned):
    data, _ = learned
    m = J.cross_validate("logistic", data, ["id"], 3)
    assert sorted((r["fold"], r["split"]) for r in m.collect()) == [(f, s) for f in range(3) for s in ("train", "valid")]
    sampled = J.cross_validate("logistic", data, ["id"], 2, train_sample=50)
    assert sampled.count() == 4
    oof = J.out_of_fold("logistic", data, ["id"], 3)
    assert oof.count() == 600 and oof.select("id").distinct().count() == 600
    summary, hold, _ = J.cross_validate_split("logistic", data, ["id"], 2)
    assert {r["split"] for r in summary.collect()} == {"train", "valid"} and hold.first()["roc_auc"] == round(hold.first()["roc_auc"], 4)
    curve = J.learning_curve("logistic", data, ["id"], k=2, sizes=(50, 100))
    assert {(r["train_pct"], r["split"]) for r in curve.collect()} == {(p, s) for p in (50, 100) for s in ("train", "valid")}
    line = data.withColumn("y", F.col("strong") * 2 + 1)
    r = {x["split"]: x for x in J.regression_evaluation(line, ["id"])[0].collect()}
    assert set(r) == {"train", "test"} and close(r["test"]["r2"], 1.0, 1e-6)
    assert J.regression_cross_validate(line, ["id"], k=3).count() == 6


# --- encoding, blocks, sources -----------------------------------------------------
def test_codes_of_many_categories(spark):
    df = spark.range(50_000).select(F.format_string("v%06d", "id").alias("c"), "id")
    coded = E.ordinal_encode(df, "c")
    assert coded.where("c <> id").count() == 0
    bits = E.binary_encode(df, "c")
    assert [c for c in bits.columns if c.startswith("c_")] == [f"c_{i}" for i in range(16)]
    value = sum(F.col(f"c_{i}") * 2 ** (15 - i) for i in range(16))
    assert bits.where(value != F.col("id") + 1).count() == 0
    with pytest.raises(ValueError):
        E.fit_vocabulary(df, ["c"], max_categories=49_999)


def test_vocabularies_of_equal_names_stay_apart(spark):
    a, b = spark.createDataFrame([("x",)], "status string"), spark.createDataFrame([("y",), (None,)], "status string")
    got = E.fit_vocabularies({"a": (a, ["status"]), "b": (b, ["status"])}, max_categories=5)
    assert got == {"a": {"status": ["x"]}, "b": {"status": ["y"]}}


def test_modeling_tables_end_to_end(spark):
    rows = [(i, i % 2, float(i) if i else INF, "true" if i % 3 else None, f"t{i}", None if i else 1.0, 5) for i in range(10)]
    cols = "id int, TARGET int, `A b` double, flag string, free string, mostly double, const int"
    train, test = spark.createDataFrame(rows, cols), spark.createDataFrame([(99, 0, NAN, "FALSE ", "q", 2.0, 5)], cols).drop("TARGET")
    x, z, report = P.prepare_modeling_tables(train, test, "id", "TARGET", 0.8)
    assert x.columns == ["id", "TARGET", "a_b", "flag"] and z.columns == ["id", "a_b", "flag"]
    assert x.where("id = 0").first()["a_b"] is None and z.first()["flag"] == 0.0 and z.first()["a_b"] is None
    assert {(r["feature"], r["status"]) for r in report.collect()} == {("A b", "kept"), ("flag", "kept"), ("free", "dropped_text")}
    assert P.all_missing_columns(spark.createDataFrame([(None, 1), (None, None)], "a int, b int")) == ["a"]


def test_blocks_follow_the_null_rules(spark):
    bureau = spark.createDataFrame([(1, 11, "Closed", None), (1, 12, "Closed", 4.0), (2, 21, "Active", None)],
                                   "SK_ID_CURR int, SK_ID_BUREAU int, CREDIT_ACTIVE string, AMT_CREDIT_SUM_DEBT double")
    others = [c for c in B.BUREAU_SPEC if c not in bureau.columns and not c.startswith("MONTHS")]
    bureau = bureau.withColumns({c: F.lit(2.0) for c in others})
    balance = spark.createDataFrame([(11, -1, "C"), (11, -3, "0")], "SK_ID_BUREAU int, MONTHS_BALANCE int, STATUS string")
    out = B.bureau_block(bureau, balance, {"CREDIT_ACTIVE": ["Active", "Closed"]}, {"STATUS": ["0", "C"]})
    r = {x["SK_ID_CURR"]: x for x in out.collect()}
    assert r[2]["BURO_AMT_CREDIT_SUM_DEBT_SUM"] == 0.0 and r[2]["CLOSED_COUNT"] is None and r[1]["ACTIVE_AMT_CREDIT_SUM_DEBT_SUM"] is None
    assert r[1]["BURO_MONTHS_BALANCE_SIZE_SUM"] == 2.0 and r[2]["BURO_MONTHS_BALANCE_SIZE_SUM"] == 0.0
    assert r[1]["BURO_MONTHS_BALANCE_MIN_MIN"] == -3 and r[1]["BURO_STATUS_C_MEAN_MEAN"] == 0.5
    late = spark.createDataFrame([(1, 1.0, -10, -5, 100.0, 50.0), (1, 1.0, -5, -9, 10.0, 10.0), (1, 2.0, -5, None, 0.0, 1.0)],
                                 "SK_ID_CURR int, NUM_INSTALMENT_VERSION double, DAYS_INSTALMENT int, DAYS_ENTRY_PAYMENT int, "
                                 "AMT_INSTALMENT double, AMT_PAYMENT double")
    i = B.instalments_block(late).first()
    assert (i["INSTAL_DPD_SUM"], i["INSTAL_DBD_MAX"], i["INSTAL_PAYMENT_PERC_SUM"], i["INSTAL_NUM_INSTALMENT_VERSION_NUNIQUE"]) == (5.0, 4, 1.5, 2)


def test_join_audit_counts_fan_out(spark):
    base = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    a, b = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "k int, a int"), spark.createDataFrame([(2, 1, 1), (2, 1, 1)], "k int, b int, c int")
    rows = [tuple(r) for r in join_audit(base, {"A": a, "B": b}, "k").collect()]
    assert rows == [(1, "A", 4, 5, 1), (2, "B", 5, 7, 2)]
    assert base.join(a, "k", "left").join(b, "k", "left").count() == 7


def test_read_back_by_header_and_inventory_of_directories(spark, tmp_path):
    board = spark.createDataFrame([(0.5, "gbt", 1, 0.25), (0.4, "logistic", 2, None)], "accuracy double, model string, rank int, business_cost_per_obs double")
    A.write_report_csv(board, f"{tmp_path}/board")
    got = A.read_or_empty(spark, f"{tmp_path}/board", "model string, rank int, business_cost_per_obs double, absent int")
    assert sorted(map(tuple, got.collect())) == [("gbt", 1, 0.25, None), ("logistic", 2, None, None)]
    assert A.read_or_empty(spark, f"{tmp_path}/none", "a int").collect() == []
    A.write_parquet(board, f"{tmp_path}/dir.parquet")
    inv = {r["name"]: r for r in A.file_inventory(spark, {"dir": f"{tmp_path}/dir.parquet", "uri": f"file://{tmp_path}/board", "no": f"{tmp_path}/x"}).collect()}
    assert inv["dir"]["exists"] and inv["uri"]["exists"] and inv["dir"]["size_mb"] >= 0 and not inv["no"]["exists"] and inv["no"]["size_mb"] is None
    with pytest.raises(Exception):
        A.file_inventory(spark, {"bad": "nosuchscheme://a/b"}).collect()


def test_a_cluster_must_name_a_shared_folder():
    conf = SimpleNamespace(get=lambda *_: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=sc))


def test_optimise_and_score_benchmarks_every_model_of_the_benchmark(monkeypatch):
    from riskframe.plans import modeling as MD
    runs, matrix = [], ("train", "holdout", "test", ["a"])
    monkeypatch.setattr(MD, "_work_dir", lambda *a: "work")
    monkeypatch.setattr(MD, "model_matrix", lambda *a: matrix)

    def benchmark(spark, sf, out_dir, models=MD.BENCHMARK_MODELS, k=3, params=None, matrix=None):
        runs.append((out_dir, list(models), k, params, matrix))
    monkeypatch.setattr(MD, "baseline_benchmark", benchmark)
    monkeypatch.setattr(MD, "optimise_and_score", lambda spark, sf, work_dir, grids=None, matrix=None: (work_dir, grids, matrix))
    assert MD.q_optimise_and_score(None, "sf") == ("work", None, matrix)
    assert runs == [("work", ["majority", "logistic", "linear_svc", "forest"], 3, None, matrix)]
