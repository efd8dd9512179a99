"""Many logistic regressions in shared scans against single fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from riskframe.operators import manyfit as M
from riskframe.operators import models as J
from riskframe.operators.encode import balanced_class_weight
from riskframe.session import cut_lineage

POINTS = [{"regParam": 1e-3, "elasticNetParam": 0.0}, {"regParam": 1e-2, "elasticNetParam": 0.15}, {"regParam": 0.05, "elasticNetParam": 1.0}]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.RandomState(5)
    n = 600
    x = rng.normal(size=(n, 6)) * [1, 30, 0.1, 5, 1, 0] + [0, 50, 0, 0, 3, 7]        # the last one is constant
    y = (x[:, 0] + (x[:, 1] - 50) / 30 + rng.normal(size=n) > 0.6).astype(int)
    rows = [(i, None if i % 97 == 0 else int(y[i]), *map(float, x[i])) for i in range(n)]
    d = spark.createDataFrame(rows, "id long, y int, a double, b double, c double, d double, e double, f double")
    return cut_lineage(J.assemble(d.repartition(3), list("abcdef")).withColumn("fold", (F.col("id") % 3).cast("int")))


def test_models_equal_single_fits(data):
    many = M.fit_logistic(data, [F.col("fold") != f for f in range(3)], POINTS)
    assert set(many) == {(f, p) for f in range(3) for p in range(3)}
    for f, p in ((0, 0), (1, 1), (2, 2)):
        alone = M.fit_logistic(data, [F.col("fold") != f], [POINTS[p]])[0, 0]
        assert np.abs(alone.coefficients - many[f, p].coefficients).max() < 1e-12
        rows = balanced_class_weight(data.where((F.col("fold") != f) & F.col("y").isNotNull()), "y", "w")
        single = LogisticRegression(labelCol="y", weightCol="w", maxIter=5000, tol=1e-13, **POINTS[p]).fit(rows)
        assert np.abs(single.coefficients.toArray() - many[f, p].coefficients).max() < 1e-6
        assert abs(single.intercept - many[f, p].intercept) < 1e-5


def test_partitions_do_not_change_the_models(data, monkeypatch):
    masks = [F.lit(True), F.col("id") < 80]
    one = M.fit_logistic(data.coalesce(1), masks, POINTS[:1])
    monkeypatch.setattr(M, "SLOTS", 2)                     # partial sums are added up by a shuffle
    other = M.fit_logistic(data.repartition(7), masks, POINTS[:1])
    assert all(np.abs(one[k].coefficients - other[k].coefficients).max() < 1e-8 for k in one)


def test_odd_masks(data):
    found = M.fit_logistic(data, [F.lit(False), F.col("y") == 1, F.lit(None).cast("boolean"), F.col("id") < 40], POINTS[:1])
    assert set(found) == {(1, 0), (3, 0)}                  # masks without rows have no model
    assert found[1, 0].intercept > 5 and np.abs(found[1, 0].coefficients).max() < 1


def test_scores_of_wanted_models(data):
    models = [M.Linear(np.array([1.0, 0, 0, 0, 0, 0]), 0.0), M.Linear(np.zeros(6), 0.5)]
    out = M.score_many(data, models, F.when(F.col("id") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))), ["id", "a"])
    rows = {(r["id"], r["model"]): r for r in out.collect()}
    assert len(rows) == 900 and abs(rows[4, 0]["score"] - 1 / (1 + np.exp(-rows[4, 0]["a"]))) < 1e-12
    assert all(abs(r["score"] - 1 / (1 + np.exp(-0.5))) < 1e-12 for (_, m), r in rows.items() if m == 1)
    assert M.score_many(data.limit(0), models, F.array(F.lit(0)), ["id"]).count() == 0


def test_search_and_folds_use_the_shared_scans(data, monkeypatch):
    rows = data.where("y is not null").drop("fold")
    monkeypatch.setattr(J, "fit", lambda *a, **k: pytest.fail("a separate fit"))
    table, best = J.grid_search("logistic", rows, ["id"], k=2, grids={"logistic": {"regParam": [1e-3, 1e5], "elasticNetParam": [0.0, 0.15]}})
    assert table.count() == 4 and best["regParam"] == 1e-3
    assert J.cross_validate("logistic", rows, ["id"], 3).count() == 6
    assert J.out_of_fold("logistic", rows, ["id"], 3).count() == rows.count()
    curve = {(r["train_pct"], r["split"]): r["roc_auc_mean"] for r in J.learning_curve("logistic", rows, ["id"], k=2, sizes=(20, 100)).collect()}
    assert len(curve) == 4 and all(0.7 < v <= 1 for v in curve.values())
