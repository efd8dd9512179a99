import pytest
from pyspark.sql import functions as F

from riskframe.operators import assoc as G
from riskframe.operators import profile as P


def test_moments_adjusted(spark):
    # FIXTURES moments: 1,2,2,10,11
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 2.0, 10.0, 11.0)], "x double")
    r = P.moments(df, ["x"]).first()
    assert r.skew == pytest.approx(0.59977, abs=1e-5)
    assert r.kurtosis == pytest.approx(-3.14106, abs=1e-5)


def test_low_information_rules(spark):
    n = 1000
    rows = []
    for i in range(n):
        rows.append((i, None, None if i else 1.0, 7.0, 7.0 if i % 2 else None, 1.0 if i < 996 else 2.0, float(i)))
    df = spark.createDataFrame(rows, "id int, all_null double, quasi double, const double, const_null double, "
                                     "dominant double, ok double")
    rep = {r.feature: r.reason for r in P.low_information_report(df, ["id"], 0.995).collect()}
    assert rep == {"all_null": "all_missing", "quasi": "quasi_all_missing", "const": "constant",
                   "const_null": "constant"}
    tr = {r.feature: r.reason for r in P.train_pruning_report(df, ["id"], 0.995).collect()}
    assert tr["dominant"] == "quasi_constant_in_train" and "ok" not in tr


def test_duplicate_report_counts_null_key(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    r = P.duplicate_report(df, "k").first()
    assert (r.rows, r.unique_keys, r.duplicated_keys) == (5, 3, 2)


def test_chi2_yates_and_cramers_v(spark):
    # FIXTURES contingency [[10,5],[3,9]] -> chi2 3.11724 (Yates), p .07747, V .28297
    rows = [("a", 0)] * 10 + [("a", 1)] * 5 + [("b", 0)] * 3 + [("b", 1)] * 9
    df = spark.createDataFrame(rows, "x string, y int")
    r = G.categorical_association(df, ["x"], "y").first()
    assert r.chi2 == pytest.approx(3.11724, abs=1e-5)
    assert r.p_value == pytest.approx(0.07747, abs=1e-5)
    assert r.cramers_v == pytest.approx(0.28297, abs=1e-5)


def test_chi2_pvalue_dof_gt_1(spark):
    # 3x2 table; reference values from the chi-square survival function
    df = spark.createDataFrame([(7.0, 2)], "x double, d int")
    p = df.select(G.chi2_sf(F.col("x"), F.col("d"))).first()[0]
    assert p == pytest.approx(0.0301973834223185, rel=1e-9)
    df = spark.createDataFrame([(3.0, 5)], "x double, d int")
    assert df.select(G.chi2_sf(F.col("x"), F.col("d"))).first()[0] == pytest.approx(0.6999858358786271, rel=1e-9)


def test_correlation_guards_constant(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (2.0, 1), (None, 0)], "c double, y int")
    out = {r.variable: r for r in G.target_correlations(df.withColumn("k", F.lit(3.0)), "y", ["c", "k"]).collect()}
    assert out["k"].corr is None and out["c"].non_null_count == 3


def _q_series(x, dof):
    """Independent upper tail via the lower-gamma series with math.lgamma."""
    import math
    a, z = dof / 2.0, x / 2.0
    s, n = 0.0, 0
    while True:
        t = math.exp((a + n) * math.log(z) - z - math.lgamma(a + n + 1))
        s += t
        if n > z and t < 1e-18:
            break
        n += 1
    return max(0.0, 1.0 - s)


@pytest.mark.parametrize("x,dof", [(0.5, 1), (12.0, 7), (100.0, 80), (3.3, 2), (250.0, 200)])
def test_chi2_sf_against_series(spark, x, dof):
    df = spark.createDataFrame([(x, dof)], "x double, d int")
    got = df.select(G.chi2_sf(F.col("x"), F.col("d"))).first()[0]
    assert got == pytest.approx(_q_series(x, dof), rel=1e-9, abs=1e-12)


def test_chi2_sf_edges(spark):
    df = spark.createDataFrame([(0.0, 3), (5000.0, 1), (None, 2)], "x double, d int")
    got = [r[0] for r in df.select(G.chi2_sf(F.col("x"), F.col("d"))).collect()]
    assert got[0] == 1.0 and got[1] == 0.0 and got[2] is None


def test_distinct_rows_by_digest(spark):
    from riskframe.operators import profile as P
    rows = [(None, 1, 0.0), (1, None, -0.0), (1, None, 0.0), (None, 1, 0.0), (2, 2, float("nan")), (2, 2, float("nan")), (None, None, None)]
    df = spark.createDataFrame(rows, "a int, b int, c double")
    r = P.distinct_rows(df).first()
    assert (r["n_rows"], r["n_distinct"]) == (7, df.distinct().count()) == (7, 4)
    assert tuple(P.distinct_rows(df.limit(0)).first()) == (0, 0)
    # a digest that all rows share: the rows themselves decide
    same = df.select("a", "b")
    assert P.distinct_rows(same).first()["n_distinct"] == same.distinct().count()


def test_column_stats_of_all_types_in_two_jobs(spark):
    from riskframe.operators import profile as P
    df = spark.createDataFrame([(1, 10 ** 17 + 1, "x", True, 1.5, None), (2, 10 ** 17 + 1, "x", False, None, None), (2, 10 ** 17 + 2, None, True, 1.5, None)],
                               "i int, l long, s string, b boolean, d double, n string")
    r = {x["variable"]: x for x in P.column_stats(df).collect()}
    assert [(r[c]["nunique"], r[c]["top_value"], r[c]["top_count"], r[c]["null_count"]) for c in "ilsbdn"] == [
        (2, "2", 2, 0), (2, str(10 ** 17 + 1), 2, 0), (1, "x", 2, 1), (2, "true", 2, 0), (1, "1.5", 2, 1), (0, None, None, 3)]


def test_value_counts_of_numbers_are_made_in_batches(spark, monkeypatch):
    """Numbers take no wide aggregate; ties, NaN, large longs, text and empty frames as before."""
    from riskframe.operators import profile as P
    big = 2 ** 60
    rows = [(1, big, 1.5, 7, "x", None), (1, big + 1, float("nan"), 7, "y", None), (2, 9, float("inf"), 7, None, None), (2, 10, 1.5, None, "y", None), (None, 9, 0.5, 7, "x", None)]
    df = spark.createDataFrame(rows, "i int, l long, d double, one int, t string, none double")
    asked, real = [], P.column_facts
    monkeypatch.setattr(P, "column_facts", lambda d, c: asked.append(list(c)) or real(d, c))
    got = {r["variable"]: tuple(r)[2:] for r in P.column_stats(df).collect()}
    assert asked == [["t"]]
    assert got == {"i": (5, 1, 4, 2, 3, 2, "1", 2), "l": (5, 0, 5, 4, 4, 2, "9", 2), "d": (5, 2, 3, 2, 3, 2, "1.5", 2),
                   "one": (5, 1, 4, 1, 2, 4, "7", 4), "t": (5, 1, 4, 2, 3, 2, "x", 2), "none": (5, 5, 0, 0, 1, 5, None, None)}
    none = {r["variable"]: tuple(r)[2:] for r in P.column_stats(df.where("i > 5")).collect()}
    assert none["i"] == none["t"] == (0, 0, 0, 0, 0, None, None, None)


def test_residual_nulls_are_named(spark):
    from riskframe.operators.profile import assert_no_nulls
    df = spark.createDataFrame([(1.0, 2, "a", float("inf")), (2.0, None, None, 1.0)], "a double, b int, c string, d double")
    assert_no_nulls(df, ["a"])
    with pytest.raises(AssertionError, match=r"\{'b': 1, 'c': 1, 'd': 1\}"):
        assert_no_nulls(df)
