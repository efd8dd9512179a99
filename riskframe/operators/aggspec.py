"""Named aggregation specs: ``{column: [agg, ...]}`` -> ``PREFIX_COLUMN_AGG``.

This is the core operator of the feature layer.  A whole block -- the full
aggregate, every filtered subset (ACTIVE/CLOSED, APPROVED/REFUSED, ...) and the
one-hot frequencies -- is ONE ``groupBy(key).agg(...)``: a single shuffle with
map-side partial aggregation, instead of one group-by and one join per subset.

Subset semantics match a "filter, group, left-join back" pipeline:
  * a key with no row in the subset gets NULL for every subset column,
    including its count and sums;
  * a key with subset rows whose values are all missing gets sum = 0
    (pandas' sum of nothing), NULL for min/max/mean/var;
  * ``var`` is the sample variance (ddof=1), NULL for fewer than two values;
  * ``size`` counts rows, ``nunique`` counts distinct non-null values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import clean_float

AGGS = ("min", "max", "mean", "sum", "var", "std", "size", "count", "nunique", "median")


def _name(prefix: str | None, rest: str) -> str:
    return f"{prefix}_{rest}" if prefix else rest


def _value(col: str, where: Column | None) -> Column:
    x = F.col(col)
    return x if where is None else F.when(where, x)


def agg_column(col: str, agg: str, where: Column | None = None, numeric: bool = True,
               is_float: bool | None = None) -> Column:
    """One aggregate expression with the null rules of the module docstring.
    NaN and Inf count as missing in every aggregate of a float column
    (``is_float``); False skips that guard (integer columns need none), None
    (unknown type) applies it where the aggregate is numeric anyway."""
    x = _value(col, where)
    if numeric and agg in ("mean", "sum", "var", "std", "median"):
        x = x.cast("double") if is_float is False else clean_float(x)
    elif numeric and is_float and agg in ("min", "max", "nunique", "count"):
        x = clean_float(x)

    def n_rows() -> Column:
        return F.count(F.lit(1)) if where is None else F.count(F.when(where, F.lit(1)))

    if agg == "min":
        return F.min(x)
    if agg == "max":
        return F.max(x)
    if agg == "mean":
        return F.avg(x)
    if agg == "sum":
        s = F.coalesce(F.sum(x), F.lit(0.0))
        return s if where is None else F.when(n_rows() > 0, s)
    if agg == "var":
        return F.var_samp(x)
    if agg == "std":
        return F.stddev_samp(x)
    if agg == "median":
        return F.percentile(x, 0.5)
    if agg in ("size",):
        return n_rows() if where is None else F.nullif(n_rows(), F.lit(0))
    if agg == "count":
        c = F.count(x)
        return c if where is None else F.when(n_rows() > 0, c)
    if agg == "nunique":
        c = F.count_distinct(x)
        return c if where is None else F.when(n_rows() > 0, c)
    raise ValueError(f"unknown aggregation {agg!r}; expected one of {AGGS}")


def agg_exprs(
    spec: Mapping[str, Sequence[str]],
    prefix: str,
    where: Column | None = None,
    numeric: bool = True,
    float_cols: set | None = None,
) -> list[Column]:
    """``[agg(col).alias(f"{prefix}_{col}_{AGG}")]`` for every (col, agg).
    ``float_cols``: the float/double columns, None when unknown."""
    out = []
    for col, aggs in spec.items():
        is_float = None if float_cols is None else col in float_cols
        for a in aggs:
            out.append(agg_column(col, a, where, numeric, is_float).alias(_name(prefix, f"{col}_{a.upper()}")))
    return out


def count_expr(name: str, where: Column | None = None) -> Column:
    """Row count per key; with a subset predicate, NULL when no row matches."""
    if where is None:
        return F.count(F.lit(1)).alias(name)
    return F.nullif(F.count(F.when(where, F.lit(1))), F.lit(0)).alias(name)


def dummy_mean_exprs(
    vocabulary: Mapping[str, Sequence[str]],
    prefix: str,
    nan_as_category: bool = True,
) -> list[Column]:
    """Frequencies of one-hot categories without materialising the dummies:
    ``avg(col == v)`` -> ``{prefix}_{col}_{v}_MEAN`` (NULL category counts as
    not-equal), plus ``{col}_nan`` when ``nan_as_category``."""
    out = []
    for col, values in vocabulary.items():
        for v in values:
            out.append(F.avg(F.when(F.col(col) == F.lit(v), 1.0).otherwise(0.0))
                       .alias(_name(prefix, f"{col}_{v}_MEAN")))
        if nan_as_category:
            out.append(F.avg(F.when(F.col(col).isNull(), 1.0).otherwise(0.0))
                       .alias(_name(prefix, f"{col}_nan_MEAN")))
    return out


def aggregate_block(
    df: DataFrame,
    key: str,
    prefix: str,
    spec: Mapping[str, Sequence[str]],
    subsets: Mapping[str, Column] | None = None,
    subset_spec: Mapping[str, Sequence[str]] | None = None,
    vocabulary: Mapping[str, Sequence[str]] | None = None,
    count_name: str | None = None,
    nan_as_category: bool = True,
) -> DataFrame:
    """One client-level block: ``PREFIX_*`` aggregates, the row count, and for
    each named subset ``NAME_*`` aggregates plus ``NAME_COUNT`` -- all in a
    single hash aggregate keyed on ``key``."""
    distinct_spec = {c: [a for a in aggs if a == "nunique"] for c, aggs in spec.items()}
    main_spec = {c: [a for a in aggs if a != "nunique"] for c, aggs in spec.items()}
    sub_spec = subset_spec or spec
    sub_distinct = {c: [a for a in aggs if a == "nunique"] for c, aggs in sub_spec.items()}
    sub_main = {c: [a for a in aggs if a != "nunique"] for c, aggs in sub_spec.items()}

    from pyspark.sql import types as T
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    exprs = agg_exprs(main_spec, prefix, float_cols=floats)
    if vocabulary:
        exprs += dummy_mean_exprs(vocabulary, prefix, nan_as_category)
    exprs.append(count_expr(count_name or f"{prefix}_COUNT"))
    for name, pred in (subsets or {}).items():
        exprs += agg_exprs(sub_main, name, where=pred, float_cols=floats)
        exprs.append(count_expr(f"{name}_COUNT", where=pred))
    main = df.groupBy(key).agg(*exprs)

    # Distinct counts in their own narrow aggregate: a count(DISTINCT) in the
    # wide aggregate would make Spark shuffle every aggregation buffer twice
    # (once by (key, value), once by key).  Both results are hash-partitioned
    # on the key, so the join adds no exchange.
    dexprs = agg_exprs({c: a for c, a in distinct_spec.items() if a}, prefix, float_cols=floats)
    for name, pred in (subsets or {}).items():
        dexprs += agg_exprs({c: a for c, a in sub_distinct.items() if a}, name, where=pred, float_cols=floats)
    if not dexprs:
        return main
    needed = {key} | {c for c, a in distinct_spec.items() if a} | {c for c, a in sub_distinct.items() if a}
    if len(needed) == 2:
        dist = _distinct_counts(df, key, (needed - {key}).pop(), prefix, distinct_spec, sub_distinct, subsets or {}, floats)
        out = main.join(dist, key, "left")
        return out.select(key, *_output_names(spec, sub_spec, prefix, subsets, vocabulary, count_name, nan_as_category))
    narrow_cols = [c for c in df.columns if c in needed]
    # subset predicates may read other columns: keep what they reference
    narrow = df if subsets else df.select(*narrow_cols)
    dist = narrow.groupBy(key).agg(*dexprs)
    out = main.join(dist, key, "left")
    names = [e for e in _output_names(spec, sub_spec, prefix, subsets, vocabulary, count_name, nan_as_category)]
    return out.select(key, *names)


def _distinct_counts(df, key, col, prefix, spec, sub_spec, subsets, floats) -> DataFrame:
    """Distinct counts of one column, of all rows and of subsets: one group per
    (key, value) knows the subsets that hold it.  Spark's plan for several
    distinct counts would copy every row once for each of them."""
    x = clean_float(F.col(col)) if col in floats else F.col(col)
    counted = {n: p for n, p in subsets.items() if sub_spec.get(col)}
    marks = {n: f"_in{i}" for i, n in enumerate(counted)}
    rows = df.select(F.col(key), x.alias("_x"), *[F.coalesce(p, F.lit(False)).alias(marks[n]) for n, p in counted.items()])
    each = rows.groupBy(key, "_x").agg(*[F.max(m).alias(m) for m in marks.values()]) if marks else rows.distinct()
    exprs = [F.count("_x").alias(_name(prefix, f"{col}_NUNIQUE"))] if spec.get(col) else []
    exprs += [F.when(F.max(m), F.count(F.when(F.col(m), F.col("_x")))).alias(_name(n, f"{col}_NUNIQUE")) for n, m in marks.items()]
    return each.groupBy(key).agg(*exprs)


def _output_names(spec, sub_spec, prefix, subsets, vocabulary, count_name, nan_as_category) -> list[str]:
    """Column order of ``aggregate_block``'s output (as if one aggregate)."""
    names = [_name(prefix, f"{c}_{a.upper()}") for c, aggs in spec.items() for a in aggs]
    for col, values in (vocabulary or {}).items():
        names += [_name(prefix, f"{col}_{v}_MEAN") for v in values]
        if nan_as_category:
            names.append(_name(prefix, f"{col}_nan_MEAN"))
    names.append(count_name or f"{prefix}_COUNT")
    for name in (subsets or {}):
        names += [_name(name, f"{c}_{a.upper()}") for c, aggs in sub_spec.items() for a in aggs]
        names.append(f"{name}_COUNT")
    return names
