"""SURVEY §5 (c): permuting the input rows or changing the partition count
must not change any result."""
import pytest
from pyspark.sql import functions as F

from riskframe.operators import metrics as K
from riskframe.operators.aggspec import aggregate_block
from riskframe.operators.quantiles import exact_quantiles


@pytest.fixture
def frame(spark):
    return spark.range(0, 4000).select(
        (F.col("id") % 97).alias("k"), ((F.col("id") * 7919) % 1000 / 10.0).alias("x"),
        (F.col("id") % 3 == 0).cast("int").alias("y"), ((F.col("id") * 31) % 101 / 100.0).alias("score"))


def _shuffled(df, n):
    return df.repartition(n, F.rand(seed=n))


def test_block_aggregate_invariant(frame):
    spec = {"x": ["min", "max", "mean", "sum", "var", "nunique"]}
    a = aggregate_block(frame, "k", "B", spec, subsets={"P": F.col("y") == 1})
    b = aggregate_block(_shuffled(frame, 13), "k", "B", spec, subsets={"P": F.col("y") == 1})
    ra = {r.k: r for r in a.collect()}
    rb = {r.k: r for r in b.collect()}
    for k in ra:
        for c in a.columns:
            va, vb = ra[k][c], rb[k][c]
            assert (va is None and vb is None) or va == pytest.approx(vb, rel=1e-12)


def test_rank_metrics_and_quantiles_invariant(frame):
    a = K.rank_metrics(frame, by=["k"]).collect()
    b = K.rank_metrics(_shuffled(frame, 9), by=["k"]).collect()
    da = {r.k: (r.roc_auc, r.pr_auc) for r in a}
    db = {r.k: (r.roc_auc, r.pr_auc) for r in b}
    assert da.keys() == db.keys()
    for k in da:
        assert da[k] == pytest.approx(db[k], rel=1e-12)
    qa = sorted(exact_quantiles(frame, ["x", "score"], [0.1, 0.5, 0.9]).collect())
    qb = sorted(exact_quantiles(_shuffled(frame, 5), ["x", "score"], [0.1, 0.5, 0.9]).collect())
    assert qa == qb
