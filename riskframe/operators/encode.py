"""Encoding and scaling.

Every encoder is fit/transform: the fit is one distributed job whose small
result (a vocabulary, one median per column, ...) reaches the driver; the
transform is a single ``select`` of built-in expressions, so train, test and
later batches share the same static projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import categorical_columns, clean_float, numeric_columns
from ..session import cut_lineage
from .quantiles import quantile_map
from .rank import row_number_by_buckets

ENCODINGS = ("onehot", "binary", "ordinal")


def _long_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    vals = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return vals.unpivot([], list(columns), "variable", "value")


def _checked_values(distinct: DataFrame, by: Sequence[str], max_categories: int) -> list:
    """Collect (by..., value) rows after an exact count per column: a column with
    more than ``max_categories`` values raises, so at most that many strings
    for each named column reach the driver."""
    distinct = cut_lineage(distinct)
    too_big = distinct.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_categories).collect()
    if too_big:
        found = {".".join(str(r[b]) for b in by): r["n"] for r in too_big}
        raise ValueError(f"too many categories to one-hot encode (limit {max_categories}): {found}")
    return distinct.collect()


def fit_vocabulary(df: DataFrame, columns: Sequence[str] | None = None, *, max_categories: int) -> dict[str, list[str]]:
    """C1 fit: sorted distinct non-null values of each categorical column, in one
    ``unpivot -> distinct`` job for all columns.

    ``max_categories`` is the most dummy columns that one column may turn
    into; a column with more values raises, for it needs another encoding
    (C3, C4), which has no limit."""
    if columns is None:
        columns = categorical_columns(df)
    columns = list(columns)
    if not columns:
        return {}
    distinct = _long_text(df, columns).where(F.col("value").isNotNull()).distinct()
    vocab: dict[str, list[str]] = {c: [] for c in columns}
    for r in _checked_values(distinct, ["variable"], max_categories):
        vocab[r["variable"]].append(r["value"])
    return {c: sorted(v) for c, v in vocab.items()}


def fit_vocabularies(frames: Mapping[str, tuple[DataFrame, Sequence[str]]], *,
                     max_categories: int) -> dict[str, dict[str, list[str]]]:
    """C1 fit for several tables in ONE job: {table: {column: values}}.  Values
    are tagged with their table, so columns of the same name in different
    tables keep vocabularies of their own."""
    long = None
    for name, (df, cols) in frames.items():
        part = _long_text(df, list(cols)).withColumn("table", F.lit(name))
        long = part if long is None else long.unionByName(part)
    distinct = long.where(F.col("value").isNotNull()).distinct()
    vocab = {name: {c: [] for c in cols} for name, (_, cols) in frames.items()}
    for r in _checked_values(distinct, ["table", "variable"], max_categories):
        vocab[r["table"]][r["variable"]].append(r["value"])
    return {t: {c: sorted(v) for c, v in cols.items()} for t, cols in vocab.items()}


def one_hot_columns(vocabulary: Mapping[str, Sequence[str]], nan_as_category: bool = True,
                    dtype: str = "int") -> dict[str, Column]:
    """``{col}_{value}`` -> 0/1 (NULL input -> 0) and ``{col}_nan``."""
    out: dict[str, Column] = {}
    for c, values in vocabulary.items():
        x = F.col(c).cast("string")
        for v in values:
            out[f"{c}_{v}"] = F.coalesce(x == F.lit(v), F.lit(False)).cast(dtype)
        if nan_as_category:
            out[f"{c}_nan"] = F.col(c).isNull().cast(dtype)
    return out


def one_hot_encode(df: DataFrame, vocabulary: Mapping[str, Sequence[str]],
                   nan_as_category: bool = True) -> tuple[DataFrame, list[str]]:
    """Replace every column of the vocabulary by its dummies; values
    unseen at fit time give all zeros.  Returns (frame, new column names)."""
    if not vocabulary:
        return df, []
    dummies = one_hot_columns(vocabulary, nan_as_category)
    keep = [F.col(c) for c in df.columns if c not in vocabulary]
    return df.select(*keep, *[e.alias(n) for n, e in dummies.items()]), list(dummies)


def _check(df: DataFrame, col: str, encoding: str) -> None:
    """C5."""
    if col not in df.columns:
        raise ValueError(f"column {col!r} not found")
    if encoding not in ENCODINGS:
        raise ValueError(f"unknown encoding {encoding!r}; expected one of {ENCODINGS}")


def category_codes(df: DataFrame, col: str, categories: Sequence[str] | None = None, first: int = 0) -> DataFrame:
    """(value, code): position of each distinct non-null value in sorted order
    (or of the given categories), from ``first``.  Any number of values: they
    are range-partitioned, numbered inside their part, and shifted by the
    counts of the parts before."""
    spark = df.sparkSession
    if categories is not None:
        return spark.createDataFrame([(v, i) for i, v in enumerate(categories, first)], "value string, code long")
    values = df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    parts = cut_lineage(values.repartitionByRange("value").withColumn("_part", F.spark_partition_id()))
    ranked = row_number_by_buckets(parts, ["value"], F.col("_part"), name="code")
    return ranked.select("value", (F.col("code") - 1 + first).alias("code"))


def _coded(df: DataFrame, col: str, codes: DataFrame, unknown: int) -> DataFrame:
    """``df`` with ``_code``: an equi-join on the value (a hot value is split by
    AQE, a small vocabulary broadcast by its size on disk)."""
    return (df.join(codes.select(F.col("value").alias("_value"), F.col("code").alias("_code")),
                    F.col(col).cast("string") == F.col("_value"), "left").drop("_value")
            .withColumn("_code", F.coalesce("_code", F.lit(unknown))))


def ordinal_encode(df: DataFrame, col: str, categories: Sequence[str] | None = None) -> DataFrame:
    """C4: code = position in the given order (or sorted values) from 0;
    unseen and NULL -> -1."""
    _check(df, col, "ordinal")
    coded = _coded(df, col, category_codes(df, col, categories), -1)
    return coded.withColumn(col, F.col("_code").cast("int")).drop("_code")


def binary_encode(df: DataFrame, col: str, categories: Sequence[str] | None = None) -> DataFrame:
    """Ordinal code from 1 (categories in sorted order -- deterministic,
    where the reference used order of first appearance), written as bits
    ``{col}_0`` (most significant) .. ``{col}_{k-1}``; unseen / NULL -> 0s."""
    _check(df, col, "binary")
    codes = cut_lineage(category_codes(df, col, categories, first=1))
    n_bits = max(1, int(codes.agg(F.max("code")).first()[0] or 0).bit_length())
    bits = {f"{col}_{i}": F.shiftright("_code", n_bits - 1 - i).bitwiseAND(F.lit(1)).cast("int")
            for i in range(n_bits)}
    keep = [F.col(c) for c in df.columns if c != col]
    return _coded(df, col, codes, 0).select(*keep, *[e.alias(n) for n, e in bits.items()])


def encode_column(df: DataFrame, col: str, encoding: str, ordinal_categories=None, *, max_categories: int) -> DataFrame:
    """C2-C5 dispatcher (``max_categories``: see ``fit_vocabulary``)."""
    _check(df, col, encoding)
    if encoding == "onehot":
        return one_hot_encode(df, fit_vocabulary(df, [col], max_categories=max_categories))[0]
    if encoding == "binary":
        return binary_encode(df, col)
    return ordinal_encode(df, col, ordinal_categories)


@dataclass
class MedianImputer:
    """Exact interpolated median fitted on one frame (train), applied to
    any frame.  Not ``ml.Imputer`` (its median is not interpolated)."""
    columns: list[str] | None = None
    medians: dict[str, float] = field(default_factory=dict)

    def fit(self, df: DataFrame, exclude: Sequence[str] = ()) -> "MedianImputer":
        cols = self.columns or numeric_columns(df, exclude)
        q = quantile_map(df, cols, [0.5])
        self.columns = cols
        self.medians = {c: q[(c, 0.5)] for c in cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        fill = {c: F.coalesce(clean_float(c), F.lit(v))
                for c, v in self.medians.items() if c in df.columns and v is not None}
        return df.withColumns(fill) if fill else df


@dataclass
class StandardScaler:
    """(x - mean) / population std; a zero std leaves the column centred."""
    columns: list[str] | None = None
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame, exclude: Sequence[str] = ()) -> "StandardScaler":
        cols = self.columns or numeric_columns(df, exclude)
        row = df.agg(*[F.avg(clean_float(c)).alias(f"m_{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(clean_float(c)).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
        self.columns = cols
        self.stats = {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(cols)}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (m, s) in self.stats.items():
            if c in df.columns and m is not None:
                scale = s if s else 1.0
                out[c] = (clean_float(c) - F.lit(m)) / F.lit(scale)
        return df.withColumns(out) if out else df


def balanced_class_weight(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """w = n / (n_classes * n_class) as a column, via window counts over
    the label (partial aggregation of two counts, no collect)."""
    from pyspark.sql import Window
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n_class"))
    every = Window.partitionBy()  # over the (#classes)-row count table only
    w = counts.select(label, (F.sum("_n_class").over(every)
                              / (F.count(F.lit(1)).over(every) * F.col("_n_class")))
                      .alias(weight_col))
    return df.join(w, label, "left")  # one row per class; rows without a label have no weight


@dataclass
class Winsorizer:
    """Clip to the exact [lower, upper] quantiles of the fitted frame; a
    column is left unchanged when a bound is missing or lower >= upper."""
    lower: float = 0.01
    upper: float = 0.99
    columns: list[str] | None = None
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame, exclude: Sequence[str] = ()) -> "Winsorizer":
        cols = self.columns or numeric_columns(df, exclude)
        q = quantile_map(df, cols, [self.lower, self.upper])
        self.columns = cols
        self.bounds = {c: (q[(c, self.lower)], q[(c, self.upper)]) for c in cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (lo, hi) in self.bounds.items():
            if c in df.columns and lo is not None and hi is not None and lo < hi:
                # infinite values are clipped to the bounds, NaN is missing
                x = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
                out[c] = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))
        return df.withColumns(out) if out else df


def minmax_scale(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """(s - min) / (max - min + 1e-12), min and max from one aggregate
    (a one-row result, applied as literals)."""
    row = df.agg(F.min(col).alias("mn"), F.max(col).alias("mx")).first()
    mn, mx = row["mn"], row["mx"]
    if mn is None:
        return df.withColumn(name or col, F.lit(None).cast("double"))
    return df.withColumn(name or col, (F.col(col) - F.lit(float(mn))) / F.lit(float(mx) - float(mn) + 1e-12))


TRUE_FALSE = ("true", "false")


def fit_text_booleans(*frames: DataFrame, columns: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """B16 fit over the union of frames (train and test): text columns whose
    trimmed lower-case non-null values are all in {true, false} are kept as
    booleans, the other text columns are reported for dropping.  One
    distinct job over the text columns."""
    cols = list(columns) if columns is not None else categorical_columns(frames[0])
    if not cols:
        return [], []
    long = None
    for f in frames:
        present = [c for c in cols if c in f.columns]
        part = f.select(*[F.lower(F.trim(F.col(c).cast("string"))).alias(c) for c in present]) \
                .unpivot([], present, "variable", "value")
        long = part if long is None else long.unionByName(part)
    bad = {r["variable"] for r in long.where(F.col("value").isNotNull() & ~F.col("value").isin(*TRUE_FALSE))
           .select("variable").distinct().collect()}
    return [c for c in cols if c not in bad], [c for c in cols if c in bad]


def apply_text_booleans(df: DataFrame, keep: Sequence[str], drop: Sequence[str]) -> DataFrame:
    """B16 transform: 'true' -> 1.0, 'false' -> 0.0, else NULL; drop the rest."""
    v = {c: F.when(F.lower(F.trim(F.col(c))) == "true", 1.0)
         .when(F.lower(F.trim(F.col(c))) == "false", 0.0) for c in keep if c in df.columns}
    out = df.withColumns(v) if v else df
    return out.drop(*[c for c in drop if c in df.columns])
