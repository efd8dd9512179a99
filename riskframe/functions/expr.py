"""Scalar column expressions (projection layer).

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing runs in Python per row.

Null conventions follow the pandas pipeline this package re-expresses:
NaN and +/-Inf are missing values, a ratio with a missing or zero
denominator is missing, and a clipped missing value stays missing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values shared with the reference pipeline.
MISSING_TOKEN = "__MISSING__"   # null category label
DAYS_SENTINEL = 365243          # "no date" marker in day-offset columns

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- B15 ---------------------------------------------------------------------
def clean_float(c: ColumnOrName) -> Column:
    """NaN and +/-Inf -> NULL (Spark NaN is not NULL and poisons max/avg)."""
    x = _c(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def clean_floats(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Apply ``clean_float`` to all float/double columns (or the given ones)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cols = list(columns)
    return df.withColumns({c: clean_float(c) for c in cols}) if cols else df


# --- B1 / B10 / B11 ----------------------------------------------------------
def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, NULL when either side is missing (NULL/NaN/Inf) or den == 0.

    ``nullif`` keeps ANSI division from raising on zero."""
    n = clean_float(num)
    d = clean_float(den)
    return n / F.nullif(d, F.lit(0.0))


# --- B2 ----------------------------------------------------------------------
def not_equal_keep_null(c: ColumnOrName, value) -> Column:
    """Predicate ``c != value`` that keeps NULL rows (plain != drops them)."""
    return ~_c(c).eqNullSafe(F.lit(value))


# --- B3 ----------------------------------------------------------------------
def map_values(c: ColumnOrName, mapping: Mapping) -> Column:
    """Lookup; values outside the mapping become NULL."""
    out = None
    for k, v in mapping.items():
        out = (F.when(_c(c) == F.lit(k), F.lit(v)) if out is None
               else out.when(_c(c) == F.lit(k), F.lit(v)))
    return out if out is not None else F.lit(None)


# --- B4 / B5 -----------------------------------------------------------------
def sentinel_flag(c: ColumnOrName, value=DAYS_SENTINEL) -> Column:
    """1 where the column equals the sentinel, else 0 (NULL -> 0)."""
    return F.coalesce(_c(c) == F.lit(value), F.lit(False)).cast("int")


def nullify(c: ColumnOrName, value=DAYS_SENTINEL) -> Column:
    return F.nullif(_c(c), F.lit(value))


def nullify_sentinels(df: DataFrame, columns: Sequence[str], value=DAYS_SENTINEL) -> DataFrame:
    cols = [c for c in columns if c in df.columns]
    return df.withColumns({c: nullify(c, value) for c in cols}) if cols else df


# --- B6 / B7 -----------------------------------------------------------------
def _present(cols: Sequence[ColumnOrName]) -> Column:
    return F.filter(F.array(*[clean_float(c) for c in cols]), lambda x: x.isNotNull())


def row_mean(cols: Sequence[ColumnOrName]) -> Column:
    """Mean of the non-missing values of a row; all missing -> NULL."""
    arr = _present(cols)
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(arr) > 0, total / F.size(arr))


def row_std(cols: Sequence[ColumnOrName]) -> Column:
    """Sample std (ddof=1) of the non-missing values; fewer than 2 -> NULL."""
    arr = _present(cols)
    n = F.size(arr)
    mean = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x) / n
    ss = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.when(n >= 2, F.sqrt(ss / (n - 1)))


# --- B12 ---------------------------------------------------------------------
def clip_at_zero(c: ColumnOrName) -> Column:
    """max(c, 0) with NULL kept NULL (``greatest`` alone would return 0)."""
    x = _c(c)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0)))


# --- B18 ---------------------------------------------------------------------
def category_label(c: ColumnOrName) -> Column:
    """Category as text with NULL replaced by the missing token."""
    return F.coalesce(_c(c).cast("string"), F.lit(MISSING_TOKEN))


# --- B19 ---------------------------------------------------------------------
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in ex]


def temporal_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
            and f.name not in ex]


def dtype_name(field: T.StructField) -> str:
    return field.dataType.simpleString()


# --- B20 ---------------------------------------------------------------------
def drop_if_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Existence-tolerant drop."""
    return df.drop(*[c for c in columns if c in df.columns])


# --- B21 ---------------------------------------------------------------------
def label_at(score: ColumnOrName, threshold: float) -> Column:
    """Score -> 0/1 label; the threshold is inclusive (score >= t)."""
    return (_c(score) >= F.lit(float(threshold))).cast("int")


# --- B23 ---------------------------------------------------------------------
def modality_label(variable: ColumnOrName, modality: ColumnOrName) -> Column:
    return F.concat_ws(" = ", _c(variable), _c(modality))


# --- B17 ---------------------------------------------------------------------
_BAD = re.compile(r"[^0-9a-zA-Z_]+")
_MULTI = re.compile(r"_+")


def sanitize_names(names: Sequence[str]) -> list[str]:
    """Lowercase, non-[0-9a-zA-Z_] runs -> '_', collapse and strip '_',
    empty -> 'feature'; repeats get '_2', '_3', ... and a suffix never
    collides with another name (the reference could emit two 'a_2')."""
    base = []
    for n in names:
        s = _MULTI.sub("_", _BAD.sub("_", str(n).lower())).strip("_")
        base.append(s or "feature")
    taken = set()
    out = []
    for s in base:
        cand, k = s, 1
        while cand in taken:
            k += 1
            cand = f"{s}_{k}"
        taken.add(cand)
        out.append(cand)
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitize_names(df.columns))
