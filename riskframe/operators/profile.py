"""Profiling, data quality and column pruning.

Most per-column statistics come from ONE long-form value-count job:
``unpivot(columns as text) -> groupBy(variable, value).count()``.  It yields
null counts, distinct counts (with and without NULL), the dominant share and
the top modality of every column at once, with map-side partial aggregation
(a hot value is pre-counted per partition, never shuffled row by row) and
without the Expand that many ``count(DISTINCT)`` in one aggregate would cause.
The resulting per-variable tables have one row per column; only those small
decision tables (e.g. which columns to drop) reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import (categorical_columns, clean_float, clean_floats, numeric_columns, sanitize_names,
                              temporal_columns)
from ..session import cut_lineage, ship_package
from .quantiles import exact_quantiles, long_numeric, quantiles_from_long


def _text(df: DataFrame, c: str):
    f = df.schema[c]
    x = F.col(f"`{c}`")
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        x = clean_float(x)
    return x.cast("string").alias(c)


def dtypes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Schema as a (variable, dtype) frame -- no data job."""
    spark = df.sparkSession
    cols = list(columns) if columns is not None else df.columns
    return spark.createDataFrame([(c, df.schema[c].dataType.simpleString()) for c in cols],
                                 "variable string, dtype string")


def value_counts_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(variable, value, n): counts of every value (NULL included) of every
    column, values as text."""
    cols = list(columns) if columns is not None else df.columns
    long = df.select(*[_text(df, c) for c in cols]).unpivot([], cols, "variable", "value")
    return long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def _typed(df: DataFrame, c: str):
    x = F.col(f"`{c}`")
    return clean_float(x) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else x


def column_facts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column, from ONE wide aggregate without any shuffle of values: rows,
    null_count, non_null, whether it has a single value (min = max), and the
    smallest value as text."""
    cols = list(columns) if columns is not None else df.columns
    n = F.count(F.lit(1))

    def row(c):
        x = _typed(df, c)
        return F.struct(F.lit(c).alias("variable"), n.alias("rows"), (n - F.count(x)).alias("null_count"),
                        F.count(x).alias("non_null"), (F.min(x) == F.max(x)).alias("single"), F.min(x).cast("string").alias("least"))
    return _inline(df, cols, row)


def _value_count_pass(numbers: int):
    """(id, number, whole, n): the values of each column, counted in each batch;
    the first ``numbers`` columns are doubles, the others longs.  Id -1 has the
    number of rows."""
    def run(batches):
        rows = 0
        for rb in batches:
            rows += rb.num_rows
            for i in range(rb.num_columns):
                x = rb.column(i).drop_null().to_numpy(zero_copy_only=False)
                if i < numbers:
                    x = x[np.isfinite(x)]
                value, n = np.unique(x, return_counts=True)
                if not len(value):
                    continue
                empty = pa.nulls(len(value), pa.int64() if i < numbers else pa.float64())
                pair = [pa.array(value), empty] if i < numbers else [empty, pa.array(value)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), i), pa.int32()), *pair, pa.array(n, pa.int64())],
                                                 ["id", "number", "whole", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.nulls(1, pa.float64()), pa.nulls(1, pa.int64()), pa.array([rows], pa.int64())],
                                         ["id", "number", "whole", "n"])
    return run


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, null_count, non_null, nunique (NULL excluded),
    nunique_with_null, dominant_count (NULL counts as a value), top_value
    (most frequent non-null, lowest on ties, as text) and top_count, plus dtype.

    Numbers are counted in Arrow batches, column by column, so that a row of the
    shuffle is one value of one batch and its count; other columns (text, dates)
    take two jobs: one wide aggregate for null counts and single-valued columns,
    and one count of the values of the rest, as text, side by side in one row."""
    cols = list(columns) if columns is not None else df.columns
    spark = df.sparkSession
    whole = [c for c in cols if isinstance(df.schema[c].dataType, T.LongType)]
    numbers = [c for c in cols if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType))]
    others = [c for c in cols if c not in numbers and c not in whole]
    facts = {r["variable"]: r for r in column_facts(df, others).collect()} if others else {}      # one row per column
    ids = {c: i for i, c in enumerate([*numbers, *whole, *(c for c in others if facts[c]["non_null"] and not facts[c]["single"])])}

    parts = []
    if numbers or whole:
        ship_package(spark)
        one_column = df.select(*[F.col(f"`{c}`").cast("double" if c in numbers else "long").alias(f"x{ids[c]}") for c in [*numbers, *whole]])
        parts.append(one_column.mapInArrow(_value_count_pass(len(numbers)), "id int, number double, whole long, n long")
                     .groupBy("id", "number", "whole").agg(F.sum("n").alias("n"))
                     .select("id", "number", F.col("whole").cast("string").alias("text"), "n"))
    if many := [c for c in others if c in ids]:
        entries = [F.struct(F.lit(ids[c]).alias("id"), _typed(df, c).cast("string").alias("text")) for c in many]
        parts.append(df.select(F.inline(F.array(*entries))).where("text IS NOT NULL").groupBy("id", "text").agg(F.count(F.lit(1)).alias("n"))
                     .select("id", F.lit(None).cast("double").alias("number"), "text", "n"))
    found, rows = {}, facts[others[0]]["rows"] if others else None
    if parts:
        counts = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        best = F.min(F.struct((-F.col("n")).alias("a"), "number", "text"))
        one = counts.groupBy("id").agg(F.count_if(F.col("id") >= 0).alias("nunique"), F.sum("n").alias("non_null"), best.alias("t")).select(
            "id", "nunique", "non_null", (-F.col("t.a")).alias("top_count"), F.coalesce("t.text", F.col("t.number").cast("string")).alias("top_value"))
        found = {r["id"]: r for r in one.collect()}        # one row per column, and one (-1) with the rows
    if rows is None:
        rows = found[-1]["non_null"] if -1 in found else 0
    for c in [*numbers, *whole]:
        present = found[ids[c]]["non_null"] if ids[c] in found else 0
        facts[c] = {"rows": rows, "null_count": rows - present, "non_null": present}
    out = []
    for c in cols:
        n, nulls, present = facts[c]["rows"], facts[c]["null_count"], facts[c]["non_null"]
        if c in ids and ids[c] in found:
            r = found[ids[c]]
            nunique, top_count, top = r["nunique"], r["top_count"], r["top_value"]
            field = df.schema[c].dataType
            if c in numbers and not isinstance(field, (T.DoubleType, T.FloatType)):
                top = str(int(float(top)))
        elif present:
            nunique, top_count, top = 1, present, facts[c]["least"]
        else:
            nunique, top_count, top = 0, None, None
        out.append((c, df.schema[c].dataType.simpleString(), n, nulls, present, nunique, nunique + (nulls > 0),
                    max(nulls, top_count or 0) if n else None, top, top_count))
    return spark.createDataFrame(out, "variable string, dtype string, rows long, null_count long, non_null long, nunique long, "
                                      "nunique_with_null long, dominant_count long, top_value string, top_count long")


# --- F1 ------------------------------------------------------------------------
def distinct_rows(df: DataFrame) -> DataFrame:
    """(n_rows, n_distinct).  Rows are counted by a 128-bit digest, so that whole
    rows are not shuffled; only rows that share a digest are compared as they are
    (digests skip NULLs, and any digest can collide)."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    one, two = F.xxhash64(*cols).alias("_h1"), F.xxhash64(F.lit(17), *cols, F.concat(*[c.isNull().cast("string") for c in cols])).alias("_h2")
    counts = df.select(one, two).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    alone = counts.agg(F.sum("_n").alias("n_rows"), F.count_if(F.col("_n") == 1).alias("alone"))
    shared = counts.where("_n > 1").select("_h1", "_h2")
    others = df.select(*cols, one, two).join(shared, ["_h1", "_h2"], "left_semi").drop("_h1", "_h2").distinct().agg(F.count(F.lit(1)).alias("others"))
    return alone.crossJoin(others).select(F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
                                          (F.col("alone") + F.col("others")).alias("n_distinct"))      # one row each


def overview(df: DataFrame) -> DataFrame:
    """rows, columns, duplicate rows (rows - distinct rows) and their share (%)."""
    both = distinct_rows(df)
    return both.select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"),
        (F.col("n_rows") - F.col("n_distinct")).alias("duplicates"),
        F.when(F.col("n_rows") > 0, (F.col("n_rows") - F.col("n_distinct")) * 100.0 / F.col("n_rows"))
        .otherwise(F.lit(0.0)).alias("pct_duplicates"))


# --- F2 ------------------------------------------------------------------------
def column_quality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """variable, dtype, pct_null, non_null, null_count, n_uniques; sorted by
    dtype asc, pct_null desc."""
    s = column_stats(df, columns)
    return s.select("variable", "dtype",
                    (F.col("null_count") * 100.0 / F.col("rows")).alias("pct_null"),
                    "non_null", "null_count", F.col("nunique").alias("n_uniques")) \
            .orderBy(F.col("dtype").asc(), F.col("pct_null").desc(), "variable")


# --- F3 ------------------------------------------------------------------------
def _inline(df: DataFrame, cols: Sequence[str], row) -> DataFrame:
    """One row per column from ONE wide aggregate: ``row(c)`` is a struct of
    aggregate expressions of column c."""
    return df.agg(F.array(*[row(c) for c in cols]).alias("rows")).select(F.inline("rows"))


def numeric_completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """variable, pct_nan_zero, pct_nan, pct_zero (percent of rows), from one
    pass of conditional counts; sorted pct_nan_zero desc."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    n = F.count(F.lit(1))

    def row(c):
        x = clean_float(c)
        return F.struct(F.lit(c).alias("variable"), (F.count_if(x.isNull()) * 100.0 / n).alias("pct_nan"),
                        (F.count_if(x == 0) * 100.0 / n).alias("pct_zero"))
    out = _inline(df, cols, row).withColumn("pct_nan_zero", F.col("pct_nan") + F.col("pct_zero"))
    return out.orderBy(F.col("pct_nan_zero").desc(), "variable")


# --- F4 ------------------------------------------------------------------------
def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact Q1 / median / Q3, fences Q1 - 1.5 IQR and Q3 + 1.5 IQR, counts
    below / above, share of non-null values (0 when none), min, max."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    # the long form feeds the quantile passes and the fence counts: write it once
    long = cut_lineage(long_numeric(df, cols))
    q = quantiles_from_long(long, cols, [0.25, 0.5, 0.75])
    qw = q.groupBy("variable").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
    qw = qw.withColumn("lower", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
           .withColumn("upper", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    # fences table: one row per column -> proven small broadcast
    cnt = long.join(F.broadcast(qw.select("variable", "lower", "upper")), "variable").groupBy("variable").agg(
        F.count_if(F.col("x") < F.col("lower")).alias("n_low"),
        F.count_if(F.col("x") > F.col("upper")).alias("n_high"),
        F.count(F.lit(1)).alias("non_null"),
        F.min("x").alias("min"), F.max("x").alias("max"))
    out = qw.join(cnt, "variable", "left")
    return out.select(
        "variable",
        F.coalesce((F.col("n_low") + F.col("n_high")) * 100.0 / F.nullif(F.col("non_null"), F.lit(0)),
                   F.lit(0.0)).alias("pct_outliers"),
        F.coalesce("n_low", F.lit(0)).alias("n_low"), F.coalesce("n_high", F.lit(0)).alias("n_high"),
        "min", "q1", "median", "q3", "max", "lower", "upper")


# --- F5 ------------------------------------------------------------------------
def moments(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """n, min, max and the bias-adjusted skewness G1 (n >= 3) and excess
    kurtosis G2 (n >= 4) of the finite values; a zero-variance column gives 0.
    One pass, one wide aggregate."""
    cols = list(columns) if columns is not None else numeric_columns(df)

    def row(c):
        x = clean_float(c)
        return F.struct(F.lit(c).alias("variable"), F.count(x).alias("n"), F.min(x).alias("min"), F.max(x).alias("max"),
                        F.var_pop(x).alias("_m2"), F.skewness(x).alias("_g1"), F.kurtosis(x).alias("_g2"))
    g = _inline(df, cols, row).where(F.col("n") > 0)
    n = F.col("n").cast("double")
    zero_var = F.col("_m2") == 0
    skew = F.when(n >= 3, F.when(zero_var, F.lit(0.0)).otherwise(
        F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2)))
    kurt = F.when(n >= 4, F.when(zero_var, F.lit(0.0)).otherwise(
        ((n + 1) * F.col("_g2") + 6) * (n - 1) / ((n - 2) * (n - 3))))
    return g.select("variable", "n", "min", "max", skew.alias("skew"), kurt.alias("kurtosis"))


# --- F6 ------------------------------------------------------------------------
def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """n_uniques, null_count, pct_null, top_value (lowest of ties), top_count;
    sorted pct_null desc, n_uniques desc."""
    cols = list(columns) if columns is not None else categorical_columns(df)
    s = column_stats(df, cols)
    return s.select("variable", F.col("nunique").alias("n_uniques"), "null_count",
                    (F.col("null_count") * 100.0 / F.col("rows")).alias("pct_null"),
                    "top_value", F.coalesce("top_count", F.lit(0)).alias("top_count")) \
            .orderBy(F.col("pct_null").desc(), F.col("n_uniques").desc(), "variable")


# --- F7 ------------------------------------------------------------------------
def temporal_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """min, max, null_count, pct_null of every date/timestamp column (one agg)."""
    cols = list(columns) if columns is not None else temporal_columns(df)
    n = F.count(F.lit(1))
    return _inline(df, cols, lambda c: F.struct(
        F.lit(c).alias("variable"), F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max"),
        F.count_if(F.col(c).isNull()).alias("null_count"), (F.count_if(F.col(c).isNull()) * 100.0 / n).alias("pct_null")))


# --- F8 / F13 ------------------------------------------------------------------
def missing_values_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with at least one missing value: missing_count, missing_ratio,
    dtype, nunique; sorted by ratio then count, descending."""
    s = column_stats(df, columns)
    return (s.where(F.col("null_count") > 0)
            .select("variable", F.col("null_count").alias("missing_count"),
                    (F.col("null_count") / F.col("rows")).alias("missing_ratio"), "dtype", "nunique")
            .orderBy(F.col("missing_ratio").desc(), F.col("missing_count").desc(), "variable"))


def all_missing_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """columns without any value (a one-row aggregate reaches the driver)."""
    cols = list(columns) if columns is not None else df.columns
    row = df.agg(*[F.count(clean_float(c) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
                           else F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"c{i}"] == 0]


# --- F9 / F10 ------------------------------------------------------------------
def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """rows, unique_keys (NULL counts as one key), duplicated_keys, ratio."""
    k = F.col(key)
    agg = df.agg(F.count(F.lit(1)).alias("rows"),
                 (F.count_distinct(k) + F.max(k.isNull().cast("int"))).alias("unique_keys"))
    return agg.select(
        "rows", F.coalesce("unique_keys", F.lit(0)).alias("unique_keys"),
        (F.col("rows") - F.coalesce("unique_keys", F.lit(0))).alias("duplicated_keys"),
        F.when(F.col("rows") > 0, (F.col("rows") - F.col("unique_keys")) / F.col("rows"))
        .otherwise(F.lit(0.0)).alias("duplicated_ratio"))


def grain_report(tables: Mapping[str, tuple[DataFrame, str | None, str | None]]) -> DataFrame:
    """F9 for the main and the parent key of every table (NULL metrics
    where the table has no such key)."""
    parts = []
    for name, (df, main_key, parent_key) in tables.items():
        for role, key in (("main", main_key), ("parent", parent_key)):
            if key is None:
                r = df.sparkSession.createDataFrame(
                    [(name, role, None, None, None, None, None)],
                    "table string, key_role string, key string, rows long, unique_keys long, "
                    "duplicated_keys long, duplicated_ratio double")
            else:
                r = duplicate_report(df, key).select(F.lit(name).alias("table"), F.lit(role).alias("key_role"),
                                                     F.lit(key).alias("key"), "*")
            parts.append(r)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- F11 -----------------------------------------------------------------------
def low_information_report(df: DataFrame, protected: Sequence[str] = (), threshold: float = 0.995) -> DataFrame:
    """all_missing -> quasi_all_missing (ratio >= threshold) -> constant
    (nunique <= 1 ignoring NULL); sorted by reason, ratio, feature."""
    cols = [c for c in df.columns if c not in set(protected)]
    s = column_stats(df, cols)
    ratio = F.col("null_count") / F.col("rows")
    reason = (F.when(F.col("non_null") == 0, "all_missing")
              .when(ratio >= threshold, "quasi_all_missing")
              .when(F.col("nunique") <= 1, "constant"))
    return (s.select(F.col("variable").alias("feature"), reason.alias("reason"),
                     ratio.alias("missing_ratio"), "nunique")
            .where(F.col("reason").isNotNull()).orderBy("reason", "missing_ratio", "feature"))


def drop_low_information_columns(df: DataFrame, protected: Sequence[str] = (),
                                 threshold: float = 0.995) -> tuple[DataFrame, DataFrame]:
    """(pruned frame, report).  The decision table (<= one row per
    column) is collected to build the projection."""
    report = low_information_report(df, protected, threshold)
    drop = [r["feature"] for r in report.select("feature").collect()]
    return df.drop(*drop), report


# --- F12 -----------------------------------------------------------------------
def train_pruning_report(train: DataFrame, protected: Sequence[str] = (), threshold: float = 0.995) -> DataFrame:
    """all_missing_in_train -> constant_in_train (nunique <= 1 ignoring NULL)
    -> quasi_constant_in_train (dominant share, NULL counted as a value, >=
    threshold); sorted reason asc, dominant desc, missing desc, feature."""
    cols = [c for c in train.columns if c not in set(protected)]
    s = column_stats(train, cols)
    miss = F.col("null_count") / F.col("rows")
    dom = F.col("dominant_count") / F.col("rows")
    reason = (F.when(miss == 1.0, "all_missing_in_train")
              .when(F.col("nunique") <= 1, "constant_in_train")
              .when(dom >= threshold, "quasi_constant_in_train"))
    return (s.select(F.col("variable").alias("feature"), reason.alias("reason"),
                     miss.alias("missing_ratio_train"), F.col("nunique").alias("nunique_train"),
                     dom.alias("dominant_ratio_train"))
            .where(F.col("reason").isNotNull())
            .orderBy(F.col("reason").asc(), F.col("dominant_ratio_train").desc(),
                     F.col("missing_ratio_train").desc(), F.col("feature").asc()))


def prune_train_test(train: DataFrame, test: DataFrame, protected: Sequence[str] = (),
                     threshold: float = 0.995) -> tuple[DataFrame, DataFrame, DataFrame]:
    report = train_pruning_report(train, protected, threshold)
    drop = sorted(r["feature"] for r in report.select("feature").collect())
    return train.drop(*drop), test.drop(*[c for c in drop if c in test.columns]), report


# --- F15 / F16 -----------------------------------------------------------------
def modeling_quality_report(train: DataFrame, id_col: str, target: str,
                            missing_threshold: float = 0.95) -> DataFrame:
    """Kept features after dropping (train only) missing ratio > threshold and
    nunique (NULL included) <= 1: feature, missing_ratio_train, dtype,
    nunique_train; sorted missing desc, nunique asc."""
    cols = [c for c in train.columns if c not in (id_col, target)]
    s = column_stats(train, cols)
    miss = F.col("null_count") / F.col("rows")
    kept = s.where((miss <= missing_threshold) & (F.col("nunique_with_null") > 1))
    return (kept.select(F.col("variable").alias("feature"), miss.alias("missing_ratio_train"), "dtype",
                        F.col("nunique").alias("nunique_train"))
            .orderBy(F.col("missing_ratio_train").desc(), F.col("nunique_train").asc(), "feature"))


def prepare_modeling_tables(train: DataFrame, test: DataFrame, id_col: str, target: str,
                            missing_threshold: float = 0.95) -> tuple[DataFrame, DataFrame, DataFrame]:
    """F15 end to end: Inf and NaN become NULL; text columns that only hold
    true/false (over train and test) become 1/0 and other text columns are
    dropped; train-only pruning by missing ratio and number of values; test is
    aligned to train's columns; names are sanitised.  Returns (X_train with
    target, X_test, report).  The report lists the kept features and, with the
    reason ``dropped_text``, the text columns that were dropped."""
    from .encode import apply_text_booleans, fit_text_booleans
    from .split import left_align
    spark = train.sparkSession
    train, test = clean_floats(train), clean_floats(test)
    text = [c for c in categorical_columns(train) if c not in (id_col, target)]
    booleans, dropped = fit_text_booleans(train, test, columns=text)
    train, test = apply_text_booleans(train, booleans, dropped), apply_text_booleans(test, booleans, dropped)
    report = modeling_quality_report(train, id_col, target, missing_threshold).withColumn("status", F.lit("kept"))
    kept = {r["feature"] for r in report.select("feature").collect()}
    features = [c for c in train.columns if c in kept]
    types = {c: train.schema[c].dataType for c in features}
    clean = dict(zip(features, sanitize_names(features)))
    x_train = train.select(id_col, target, *[F.col(c).alias(clean[c]) for c in features])
    x_test = left_align(test, [id_col, *features], types).select(id_col, *[F.col(c).alias(clean[c]) for c in features])
    if dropped:
        gone = spark.createDataFrame([(c, "string", "dropped_text") for c in dropped], "feature string, dtype string, status string")
        report = report.unionByName(gone, allowMissingColumns=True)
    return x_train, x_test, report


# --- F17 -----------------------------------------------------------------------
def assert_no_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> None:
    """raise when any column still has missing values, NaN and Inf
    included.  Numbers are first tested by groups of columns (x * 0 is 0 for what
    is neither NULL, NaN nor Inf); only where a group fails, or a column is no
    number, are the columns counted one by one."""
    cols = list(columns) if columns is not None else df.columns
    numeric = [c for c in cols if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType))]
    groups = [numeric[i:i + 16] for i in range(0, len(numeric), 16)]
    if groups:
        zero = [reduce(add, [F.col(f"`{c}`").cast("double") * 0.0 for c in g]) for g in groups]
        row = df.agg(*[F.count_if(F.coalesce(z != 0.0, F.lit(True))).alias(f"c{i}") for i, z in enumerate(zero)]).first()
        cols = [c for c in cols if c not in numeric or row[f"c{next(i for i, g in enumerate(groups) if c in g)}"]]
    if not cols:
        return
    missing = {c: (clean_float(c) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)).isNull()
               for c in cols}
    row = df.agg(*[F.count_if(missing[c]).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    bad = {c: row[f"c{i}"] for i, c in enumerate(cols) if row[f"c{i}"]}
    if bad:
        raise AssertionError(f"residual nulls after imputation: {bad}")


# --- E11 / E12 / E14 -------------------------------------------------------------
def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """count and share per target value, NULL included (window over the
    handful of class rows)."""
    c = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    return c.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy()))


def median_by_class(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Exact median of each column per class (0/1) with gap = m1 - m0."""
    q = exact_quantiles(df.where(F.col(target).isNotNull()), columns, [0.5], by=[target])
    w = q.groupBy("variable").agg(
        F.max(F.when(F.col(target) == 0, F.col("value"))).alias("median_0"),
        F.max(F.when(F.col(target) == 1, F.col("value"))).alias("median_1"))
    return w.withColumn("gap", F.col("median_1") - F.col("median_0")) \
            .withColumn("abs_gap", F.abs(F.col("gap")))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def dtype_counts(df: DataFrame) -> DataFrame:
    return dtypes(df).groupBy("dtype").agg(F.count(F.lit(1)).alias("count"))


# --- A3 ------------------------------------------------------------------------
def source_overview(tables: Mapping[str, DataFrame], keys: Mapping[str, tuple] | None = None,
                    target: str = "TARGET") -> DataFrame:
    """One row per table: row count (one count per table, unioned) plus
    schema facts -- n_columns, main/parent key, has_target, first 8 column
    names."""
    keys = keys or {}
    rows = []
    for name, df in tables.items():
        main, parent = keys.get(name, (None, None))
        rows.append((name, len(df.columns), main, parent, target in df.columns, ", ".join(df.columns[:8])))
    spark = next(iter(tables.values())).sparkSession
    schema = spark.createDataFrame(rows, "table string, n_columns int, main_key string, parent_key string, "
                                         "has_target boolean, first_columns string")
    counts = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        counts = c if counts is None else counts.unionByName(c)
    return schema.join(counts, "table", "left")
