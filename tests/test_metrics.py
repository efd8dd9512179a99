import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as K

SCORES = [(.9, 1), (.8, 0), (.8, 1), (.7, 1), (.6, 0), (.5, 1), (.4, 0), (.3, 0)]


@pytest.fixture
def scores(spark):
    return spark.createDataFrame(SCORES, "score double, y int")


def test_auc_ap_with_ties(scores):
    r = K.rank_metrics(scores).first()
    assert r.roc_auc == pytest.approx(0.78125) and r.pr_auc == pytest.approx(0.770833333, abs=1e-8)


def test_auc_identity(scores):
    a = K.rank_metrics(scores).first().roc_auc
    b = K.rank_metrics(scores.withColumn("score", -F.col("score"))).first().roc_auc
    assert a + b == pytest.approx(1.0)


def test_single_class_auc_null(spark):
    df = spark.createDataFrame([(0.1, 0), (0.7, 0)], "score double, y int")
    r = K.rank_metrics(df).first()
    assert r.roc_auc is None and r.pr_auc is None


def test_threshold_search_equals_direct_counts(spark):
    # FIXTURES grid_edge: scores exactly on grid points count as positive predictions
    rows = [(0.10, 1), (0.50, 0), (0.90, 1), (0.29, 1), (0.31, 0), (0.0, 0), (1.0, 1)]
    df = spark.createDataFrame(rows, "score double, y int")
    t = {round(r.threshold, 2): r for r in K.threshold_search(df, lo=5, hi=95).collect()}
    for thr in (0.10, 0.29, 0.30, 0.50, 0.90, 0.95):
        fp = sum(1 for s, y in rows if s >= thr and y == 0)
        fn = sum(1 for s, y in rows if s < thr and y == 1)
        assert (t[thr].false_positives, t[thr].false_negatives) == (fp, fn)
        assert t[thr].business_cost == fn * 10 + fp


def test_best_f1_first_threshold(scores):
    r = K.best_f1_threshold(scores).first()
    assert r.threshold == pytest.approx(0.5) and r.f1 == pytest.approx(0.8)


def test_classification_metrics_row(scores):
    r = K.classification_metrics(scores, threshold=0.5).first()
    assert (r.false_negatives, r.false_positives) == (0, 2)
    assert r.recall == 1.0 and r.precision == pytest.approx(4 / 6)
    assert r.business_fbeta == pytest.approx(11 * 4 / (11 * 4 + 10 * 0 + 2))


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "y double, yhat double")
    r = K.regression_metrics(df).first()
    assert r.mae == pytest.approx(1 / 3) and r.rmse == pytest.approx((0.5 / 3) ** 0.5)
    assert r.r2 == pytest.approx(1 - 0.5 / 2.0)


def test_overfit_gaps_pivot(spark):
    m = spark.createDataFrame([("train", 0.9, 0.5), ("test", 0.7, None)], "split string, roc_auc double, f1 double")
    r = K.overfit_gaps(m, names=["roc_auc", "f1"]).first()
    assert r.train_roc_auc == 0.9 and r.test_roc_auc == 0.7 and r.gap_roc_auc == pytest.approx(0.2)
    assert r.train_f1 == 0.5 and r.test_f1 is None and r.gap_f1 is None


def test_folds_of_a_stepwise_learner_are_fitted_side_by_side(spark, monkeypatch):
    import threading
    from riskframe.operators import models as J
    meet = threading.Barrier(3, timeout=30)
    monkeypatch.setattr(J, "fit", lambda name, train, *a, **k: meet.wait() and None or (("majority", 1), 0.5))
    d = spark.createDataFrame([(i, i % 2, [1.0]) for i in range(24)], "id int, y int, features array<double>")
    assert J.cross_validate("linear_svc", d, ["id"], 3).count() == 6


def test_metrics_read_written_scores_of_a_model(spark, monkeypatch):
    from pyspark.ml.functions import array_to_vector
    from riskframe.operators import models as J
    d = (spark.createDataFrame([(i, i % 2, [float(i % 7), float(i % 2)]) for i in range(80)], "id int, y int, x array<double>")
         .select("id", "y", array_to_vector("x").alias("features")))
    seen, of = [], J.K.classification_metrics
    monkeypatch.setattr(J.K, "classification_metrics", lambda s, *a, **k: seen.append(s._jdf.queryExecution().executedPlan().toString()) or of(s, *a, **k))
    assert J.holdout_evaluation("forest", d, d, params={"numTrees": 3})[0].count() == 2
    assert J.cross_validate("forest", d, ["id"], 2, params={"numTrees": 3}).count() == 4
    assert len(seen) == 2 and not any("UDF" in p for p in seen)
