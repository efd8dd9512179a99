import math

import pytest

from riskframe.functions import expr as X
from riskframe.functions.rounding import sig_round_doubles


def test_safe_divide_null_rules(spark):
    # FIXTURES null_ratio: (1,2) (1,0) (1,null) (null,2) (NaN,1)
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0), (float("nan"), 1.0)],
                               "num double, den double")
    got = [r[0] for r in df.select(X.safe_divide("num", "den")).collect()]
    assert got == [0.5, None, None, None, None]


def test_clean_float_inf_nan(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (3.0,)], "x double")
    assert [r[0] for r in X.clean_floats(df).collect()] == [None, None, None, 3.0]


def test_not_equal_keeps_null_and_mapping(spark):
    df = spark.createDataFrame([(1, "F"), (2, "M"), (3, "XNA"), (4, None)], "id int, g string")
    kept = df.where(X.not_equal_keep_null("g", "XNA")).orderBy("id")
    assert [r.id for r in kept.collect()] == [1, 2, 4]
    mapped = [r[0] for r in df.orderBy("id").select(X.map_values("g", {"F": 0, "M": 1})).collect()]
    assert mapped == [0, 1, None, None]


def test_sentinel(spark):
    df = spark.createDataFrame([(1, 365243), (2, -100), (3, None)], "id int, d int")
    out = X.nullify_sentinels(df.withColumn("flag", X.sentinel_flag("d")), ["d"]).orderBy("id").collect()
    assert [r.flag for r in out] == [1, 0, 0]
    assert [r.d for r in out] == [None, -100, None]


def test_row_mean_std(spark):
    df = spark.createDataFrame([(1.0, 2.0, 6.0), (4.0, None, None), (None, None, None)], "a double, b double, c double")
    out = df.select(X.row_mean(["a", "b", "c"]).alias("m"), X.row_std(["a", "b", "c"]).alias("s")).collect()
    assert out[0].m == pytest.approx(3.0) and out[0].s == pytest.approx(math.sqrt(7.0))
    assert out[1].m == 4.0 and out[1].s is None
    assert out[2].m is None and out[2].s is None


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(5,), (-3,), (0,), (None,)], "d int")
    assert [r[0] for r in df.select(X.clip_at_zero("d")).collect()] == [5, 0, 0, None]


def test_sanitize_names_dedup():
    # FIXTURES names: a, a_2, A, é!, --
    assert X.sanitize_names(["a", "a_2", "A", "é!", "--"]) == ["a", "a_2", "a_3", "feature", "feature_2"]


def test_label_at_inclusive(spark):
    df = spark.createDataFrame([(0.1,), (0.5,), (0.9,), (0.49,)], "s double")
    assert [r[0] for r in df.select(X.label_at("s", 0.5)).collect()] == [0, 1, 1, 0]


def test_sig_rounding_agrees_with_python(spark):
    vals = [123456.789012345, -0.000123456789123, 2.0, 0.1 + 0.2, 1e15 / 3]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in sig_round_doubles(df).collect()]
    for v, g in zip(vals, got):
        assert g == pytest.approx(v, rel=1e-9)
