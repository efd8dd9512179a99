"""A key, a value or a score holding a third of all rows must not change
results (the operators rely on partial aggregation and bucketed ranks)."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as K
from riskframe.operators.aggspec import aggregate_block
from riskframe.operators.split import kfold


def _skewed(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    key = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 200, n))   # key 0 holds a third
    x = np.round(rng.normal(size=n) * 10, 1)
    status = rng.choice(["A", "C"], n)
    return pd.DataFrame({"k": key, "x": x, "status": status})


def test_block_aggregate_with_hot_key(spark):
    pdf = _skewed()
    df = spark.createDataFrame(pdf).repartition(7)
    out = {r.k: r for r in aggregate_block(df, "k", "B", {"x": ["mean", "sum", "var", "nunique"]},
                                           subsets={"ACT": F.col("status") == "A"}).collect()}
    for k, g in pdf.groupby("k"):
        r = out[k]
        assert r.B_COUNT == len(g)
        assert r.B_x_SUM == pytest.approx(g.x.sum())
        assert r.B_x_NUNIQUE == g.x.nunique()
        a = g[g.status == "A"]
        assert (r.ACT_COUNT or 0) == len(a)
        if len(a) >= 2:
            assert r.ACT_x_VAR == pytest.approx(a.x.var(ddof=1))


def _brute_auc(s, y):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum((1.0 if p > q else 0.5 if p == q else 0.0) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_rank_metrics_with_hot_score(spark):
    rng = np.random.default_rng(3)
    n = 900
    s = np.where(np.arange(n) < n // 3, 0.5, np.round(rng.random(n), 2))   # one score for a third of rows
    y = (rng.random(n) < 0.3 + 0.4 * s).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"score": s, "y": y})).repartition(5)
    r = K.rank_metrics(df).first()
    assert r.roc_auc == pytest.approx(_brute_auc(s, y), abs=1e-12)
    # average precision: step sum over distinct thresholds, descending
    order = sorted(set(s), reverse=True)
    P = y.sum()
    ap = 0.0
    for t in order:
        m = s >= t
        tp = (y[m] == 1).sum()
        ap += ((y[s == t] == 1).sum() / P) * tp / m.sum()
    assert r.pr_auc == pytest.approx(ap, abs=1e-12)


def test_folds_with_hot_class(spark):
    df = spark.range(0, 3000).withColumn("y", (F.col("id") < 2000).cast("int"))   # 2/3 in one class
    sizes = {(r.y, r.fold): r["count"] for r in kfold(df, ["id"], 4, 9, label="y").groupBy("y", "fold").count().collect()}
    assert sorted(v for (y, _), v in sizes.items() if y == 1) == [500, 500, 500, 500]
    assert sorted(v for (y, _), v in sizes.items() if y == 0) == [250, 250, 250, 250]
