import pytest
from pyspark.sql import functions as F

from riskframe.operators.aggspec import aggregate_block


def test_subset_null_rules(spark):
    # FIXTURES child: client 1 only Active, client 2 only Closed, client 3 all-null x, client 4 single row
    rows = [(1, "Active", 1.0), (1, "Active", 3.0), (2, "Closed", 5.0), (3, "Active", None), (3, "Active", None),
            (4, "Closed", 7.0)]
    df = spark.createDataFrame(rows, "k int, status string, x double")
    out = {r.k: r for r in aggregate_block(
        df, "k", "B", {"x": ["min", "max", "mean", "sum", "var", "size"]},
        subsets={"ACTIVE": F.col("status") == "Active", "CLOSED": F.col("status") == "Closed"},
        count_name="B_COUNT").collect()}
    # client 1 has no closed row: every CLOSED column is NULL, including the count and the sum
    assert out[1].CLOSED_COUNT is None and out[1].CLOSED_x_SUM is None and out[1].CLOSED_x_MEAN is None
    assert out[1].ACTIVE_COUNT == 2 and out[1].ACTIVE_x_SUM == 4.0 and out[1].ACTIVE_x_VAR == pytest.approx(2.0)
    # client 3: rows exist but all x missing -> sum 0 (pandas), mean NULL
    assert out[3].B_x_SUM == 0.0 and out[3].B_x_MEAN is None and out[3].ACTIVE_x_SUM == 0.0
    # single row: sample variance undefined
    assert out[4].B_x_VAR is None and out[4].B_COUNT == 1 and out[4].B_x_SIZE == 1


def test_unknown_agg_raises(spark):
    df = spark.createDataFrame([(1, 1.0)], "k int, x double")
    with pytest.raises(ValueError):
        aggregate_block(df, "k", "B", {"x": ["median_abs"]})


def test_distinct_counts_of_subsets_copy_and_move_no_row_again(spark):
    rows = [(1, "p", "x"), (1, "p", "y"), (1, "q", "y"), (1, None, "x"), (2, None, "y"), (3, "r", "x"), (3, "r", "x"), (None, "s", "x")]
    d = spark.createDataFrame(rows, "k int, v string, s string").repartition(4, "k")
    b = aggregate_block(d, "k", "B", {"v": ["nunique"]}, {"X": F.col("s") == "x", "Y": F.col("s") == "y"})
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "hashpartitioning(k" in plan and plan.count("ENSURE_REQUIREMENTS") == plan.count("SinglePartition")
    found = {r["k"]: (r["B_v_NUNIQUE"], r["X_v_NUNIQUE"], r["Y_v_NUNIQUE"], r["B_COUNT"]) for r in b.collect()}
    assert found == {1: (2, 1, 2, 4), 2: (0, None, 0, 1), 3: (1, 1, None, 2), None: (None, None, None, 1)}
