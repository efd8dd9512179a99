import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskframe.operators import split as H
from riskframe.operators.encode import MedianImputer
from riskframe.operators.quantiles import exact_quantiles
from riskframe.operators.rank import hash_rank, running_totals, seeded_hash


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    a = np.round(rng.normal(size=3000) * 100, 1)          # many ties
    b = np.concatenate([np.zeros(2000), rng.exponential(size=1000)])  # a hot value: 2/3 of rows
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.variable, r.prob): r.value for r in exact_quantiles(df, ["a", "b"], probs, bins=16,
                                                                  exact_below=50).collect()}
    for name, arr in (("a", a), ("b", b)):
        for p in probs:
            assert got[(name, p)] == pytest.approx(float(np.quantile(arr, p)), rel=1e-12, abs=1e-12)


def test_median_impute(spark):
    # FIXTURES impute: 1, 2, null -> 1.5
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    imp = MedianImputer(["x"]).fit(df)
    assert imp.medians["x"] == 1.5
    assert [r.x for r in imp.transform(df).collect()] == [1.0, 2.0, 1.5]


def test_hash_rank_equals_single_window(spark):
    df = spark.range(0, 5000).withColumn("g", (F.col("id") % 3 == 0).cast("int"))
    got = hash_rank(df, ["id"], 7, by=["g"], bits=4)
    ref = df.withColumn("_h", seeded_hash(["id"], 7)).withColumn(
        "rn", F.row_number().over(Window.partitionBy("g").orderBy("_h", "id"))).drop("_h")
    assert sorted(got.select("id", "g", "rn").collect()) == sorted(ref.select("id", "g", "rn").collect())


def test_running_totals_equal_plain_window(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7 % 1999).cast("double").alias("s"),
                                     (F.col("id") % 5).cast("double").alias("v"), (F.col("id") % 2).alias("g"))
    got = running_totals(df, "s", ["v"], by=["g"], n_buckets=7)
    ref = df.withColumn("cum_v", F.sum("v").over(Window.partitionBy("g").orderBy("s")
                                                 .rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(got.select("g", "s", "v", "cum_v").collect()) == sorted(ref.select("g", "s", "v", "cum_v").collect())


def test_stratified_split_shares(spark):
    df = spark.range(0, 1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    out = H.stratified_holdout(df, "y", ["id"], 20, 42)
    c = {(r.y, r.is_test): r["count"] for r in out.groupBy("y", "is_test").count().collect()}
    assert c[(1, 1)] == 20 and c[(0, 1)] == 180


def test_kfold_sizes_and_partition_invariance(spark):
    df = spark.range(0, 1003).withColumn("y", (F.col("id") % 7 == 0).cast("int"))
    a = H.kfold(df, ["id"], 5, 3, label="y")
    b = H.kfold(df.repartition(11), ["id"], 5, 3, label="y")
    assert sorted(a.collect()) == sorted(b.collect())
    sizes = [r["count"] for r in a.groupBy("y", "fold").count().collect()]
    by_class = {}
    for r in a.groupBy("y", "fold").count().collect():
        by_class.setdefault(r.y, []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in by_class.values()) and sum(sizes) == 1003


def test_exact_sample_size(spark):
    df = spark.range(0, 500)
    assert H.exact_sample(df, 100, ["id"], 1).count() == 100
    assert H.exact_sample(df, 1000, ["id"], 1).count() == 500


def test_union_align_nulls(spark):
    a = spark.createDataFrame([(1, 1.0)], "id int, x double")
    b = spark.createDataFrame([(2, 2.0)], "id int, z double")
    out = {r.id: r for r in H.union_align(a, b).collect()}
    assert out[1].z is None and out[2].x is None


def test_exact_sample_equals_global_order(spark):
    df = spark.range(0, 5000).withColumn("x", F.col("id") * 3)
    got = H.exact_sample(df, 1234, ["id"], 5)
    ref = df.withColumn("_h", seeded_hash(["id"], 5)).orderBy("_h", "id").limit(1234).drop("_h")
    assert sorted(got.collect()) == sorted(ref.collect())


def test_exact_sample_multilevel_refinement(spark, monkeypatch):
    monkeypatch.setattr(H, "EXACT_SAMPLE_BUCKET_ROWS", 0)   # force refinement down the hash levels
    df = spark.range(0, 3000)
    got = H.exact_sample(df, 777, ["id"], 11)
    ref = df.withColumn("_h", seeded_hash(["id"], 11)).orderBy("_h", "id").limit(777).drop("_h")
    assert sorted(got.collect()) == sorted(ref.collect())


def test_columns_side_by_side_need_no_long_form(spark, monkeypatch):
    """Without groups no row is made of every value; ranks, ties, infinities and
    empty columns as numpy has them."""
    import numpy as np
    from riskframe.operators import quantiles as Q

    def never(*_, **__):
        raise AssertionError("long form")
    monkeypatch.setattr(Q, "long_numeric", never)
    rnd = np.random.RandomState(3)
    a, b, c = rnd.standard_cauchy(3000), rnd.randint(0, 3, 3000).astype(float), np.exp(rnd.normal(0, 20, 3000))
    a[:5] = [np.nan, np.inf, -np.inf, 1.5e308, -1.5e308]
    df = spark.createDataFrame([(float(x), int(y), float(z), None) for x, y, z in zip(a, b, c)], "a double, `b.b` int, c double, d double").repartition(5)
    probs = [0.0, 0.013, 0.5, 0.99, 1.0]
    for kw in ({}, {"bins": 4, "exact_below": 10}):
        got = {(r["variable"], r["prob"]): r["value"] for r in Q.exact_quantiles(df, df.columns, probs, **kw).collect()}
        for name, x in (("a", a[np.isfinite(a)]), ("b.b", b), ("c", c)):
            x = np.sort(x)
            for p in probs:
                pos = p * (len(x) - 1)
                lo, hi = x[int(pos)], x[min(int(pos) + 1, len(x) - 1)]
                want = lo if pos == int(pos) or lo == hi else lo + (hi - lo) * (pos - int(pos))
                assert got[name, p] == want
        assert {got["d", p] for p in probs} == {None}
