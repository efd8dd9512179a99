"""End-to-end: flagship query and invariants on the smallest test tables."""
import pytest
from pyspark.sql import functions as F

from paths import SF
from riskframe.operators import encode as E
from riskframe.operators.models import build_estimator
from riskframe.plans import mart as M
from riskframe.plans import tables as T


def test_entry_runs(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() == T.table(spark, SF, "customer").count()


def test_join_keeps_row_count(spark):
    mart = M.client_feature_mart(spark, SF)
    assert mart.count() == T.table(spark, SF, "customer").count()
    assert mart.select("c_custkey").distinct().count() == mart.count()


def test_registry_has_oracle_names(spark):
    import __spark_entry__ as entry
    qs, orc = entry.queries(), entry.oracle_sql()
    assert set(orc) <= set(qs) and len(orc) >= 60


def test_one_hot_no_text_left(spark):
    app = T.application(spark, SF)
    out, new = E.one_hot_encode(app, E.fit_vocabulary(app, max_categories=100))
    assert not [f for f in out.schema.fields if f.dataType.simpleString() == "string"]
    assert "c_mktsegment_nan" in new


def test_unknown_names_raise(spark):
    df = spark.createDataFrame([("a",)], "c string")
    with pytest.raises(ValueError):
        E.encode_column(df, "c", "target", max_categories=10)
    with pytest.raises(ValueError):
        E.encode_column(df, "missing", "onehot", max_categories=10)
    with pytest.raises(ValueError):
        build_estimator("xgboost")


def test_vocabulary_guard_and_multi_table_fit(spark):
    df = spark.range(0, 50).select(F.col("id").cast("string").alias("free_text"),
                                   (F.col("id") % 2).cast("string").alias("flag"))
    with pytest.raises(ValueError):
        E.fit_vocabulary(df, ["free_text"], max_categories=10)
    other = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    v = E.fit_vocabularies({"a": (df, ["flag"]), "b": (other, ["c"])}, max_categories=10)
    assert v == {"a": {"flag": ["0", "1"]}, "b": {"c": ["x", "y"]}}


def test_bucketed_blocks_join_without_a_shuffle(spark):
    from riskframe.plans import domain as D
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = D.q_bucketed_blocks(spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan and "Bucketed: true" in plan
        assert sorted(map(str, df.collect())) == sorted(map(str, D.q_post_join_ratios(spark, SF).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_model_matrix_has_short_methods_and_leaves_the_session_as_it_was(spark, monkeypatch):
    from riskframe.plans import modeling as ML
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name, None)
    fit, write = E.MedianImputer.fit, ML.cut_lineage
    monkeypatch.setattr(E.MedianImputer, "fit", lambda self, df: seen.append(spark.conf.get(name, None)) or fit(self, df))
    monkeypatch.setattr(ML, "cut_lineage", lambda df: seen.append(spark.conf.get(name, None)) or write(df))
    ML.model_matrix(spark, SF)
    assert seen == [before, "8000", "8000", "8000"]                      # the mart, the medians, the filled table, the split
    assert spark.conf.get(name, None) == before


def test_fold_loops_move_only_the_columns_they_read(spark, monkeypatch):
    from riskframe.operators import models as J
    rows = [(i, i % 2, float(i % 7), float(i % 2 + i % 5)) for i in range(120)]
    data = J.assemble(spark.createDataFrame(rows, "id long, y int, a double, b double"), ["a", "b"])
    moved, written = [], []
    fold, split, write = J.kfold_column, J.stratified_holdout, J.cut_lineage
    monkeypatch.setattr(J, "kfold_column", lambda d, *a, **k: moved.append(d.columns) or fold(d, *a, **k))
    monkeypatch.setattr(J, "stratified_holdout", lambda d, *a, **k: moved.append(d.columns) or split(d, *a, **k))
    monkeypatch.setattr(J, "cut_lineage", lambda d: written.append(d.columns) or write(d))
    summary, hold, _ = J.cross_validate_split("logistic", data, ["id"], 2)
    assert summary.count() and hold.count() == 1
    assert moved == [["id", "y", "features"]] * 2
    assert written[0] == ["id", "y", "features", "is_test"]              # the split is made once
    J.tuned_threshold("logistic", data, ["id"])
    J.grid_search("logistic", data, ["id"], grids={"logistic": {"regParam": [0.1]}}, k=2)
    assert J.out_of_fold("logistic", data, ["id"], 2).columns == ["id", "y", "fold", "score"]
    assert moved == [["id", "y", "features"]] * 5


def test_permutation_scores_of_a_logistic_model_equal_the_row_by_row_ones(spark, monkeypatch):
    from riskframe.operators import explain as L
    from riskframe.operators import models as J
    rows = [(i, None if i == 7 else int(i % 3 == 0 or i % 5 == 1), float(i % 7), float(i % 2 + i % 5), float(i % 3) / 3) for i in range(90)]
    data = J.assemble(spark.createDataFrame(rows, "id long, y int, a double, b double, c double"), ["a", "b", "c"])
    model, _ = J.fit("logistic", data.where("y IS NOT NULL"), "y")
    made = []
    replaced = L.replaced_entry
    monkeypatch.setattr(L, "replaced_entry", lambda *a: made.append(a) or replaced(*a))
    quick = L.permutation_importance(model, data, ["a", "b", "c"], "id", n_repeats=2, columns=["c", "a"]).collect()
    assert not made                                                      # no row per column
    monkeypatch.setattr(L, "LogisticRegressionModel", int)
    slow = L.permutation_importance(model, data, ["a", "b", "c"], "id", n_repeats=2, columns=["c", "a"]).collect()
    assert made and [r["feature"] for r in quick] == [r["feature"] for r in slow] and len(quick) == 2
    assert all(abs(q[c] - s[c]) < 1e-12 for q, s in zip(quick, slow) for c in ("importance_mean", "importance_std"))
