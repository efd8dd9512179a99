"""Significant-digit rounding used when results are compared across engines.

Two engines summing the same doubles in a different order differ in the last
bits; rounding every double to a fixed number of significant digits makes the
outputs bit-identical.  The same SQL template is used on the Spark side
(``F.expr``) and in the DuckDB oracle text, so both compute it the same way:
scale into [1, 10) by an exact power of ten, ``round`` at a literal scale,
scale back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIG_DIGITS = 10       # exact for money-like sums; far from half boundaries
NOISY_DIGITS = 6      # second-moment statistics (var, std, corr, skew, ...)
# The cut between rounding down and up sits at fraction 0.618 of the last
# digit instead of 0.5: decimal data (money with 2 decimals, their means over
# 2, 4, 8 rows ...) lands exactly on .5 far more often than on .618, and a
# one-ulp difference between engines would flip a value sitting on the cut.
CUT = 0.3819660113


def sig_sql(expr: str, digits: int = SIG_DIGITS) -> str:
    """SQL text (valid in Spark SQL and DuckDB) rounding ``expr`` to
    ``digits`` significant digits with ``floor(v + CUT)`` on the binary value
    (identical IEEE operations in both engines; ``round`` differs: Spark rounds
    the decimal string).  NULL, NaN and 0 pass through."""
    x = f"CAST(({expr}) AS DOUBLE)"
    k = f"({digits - 1} - floor(log10(abs({x}))))"
    return (
        f"(CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = 0 THEN {x} "
        f"WHEN {k} >= 0 THEN floor({x} * power(10, {k}) + {CUT}) / power(10, {k}) "
        f"ELSE floor({x} / power(10, -{k}) + {CUT}) * power(10, -{k}) END)"
    )


def sig(col: str, digits: int = SIG_DIGITS) -> Column:
    return F.expr(sig_sql(f"`{col}`", digits)).alias(col)


NOISY_SUFFIXES = ("_VAR", "_STD", "var", "std", "corr", "skew", "kurtosis", "cramers_v",
                  "chi2", "p_value", "spearman")


def digits_for(name: str) -> int:
    return NOISY_DIGITS if name.lower().endswith(tuple(s.lower() for s in NOISY_SUFFIXES)) else SIG_DIGITS


def _round_lambda(digits: int):
    def f(x):
        k = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
        up = F.floor(x * F.pow(F.lit(10.0), k) + CUT) / F.pow(F.lit(10.0), k)
        down = F.floor(x / F.pow(F.lit(10.0), -k) + CUT) * F.pow(F.lit(10.0), -k)
        return F.when(x.isNull() | F.isnan(x) | (x == 0), x).when(k >= 0, up).otherwise(down)
    return f


def sig_round_doubles(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Round every float/double column of ``df`` (other columns untouched);
    by default second-moment columns get fewer digits (``digits_for``).

    The doubles are packed into one array per digit count and rounded by a
    single ``transform``: the per-column rounding expression appears once, so
    wide frames do not blow the generated-code size limit."""
    fields = df.schema.fields
    groups: dict[int, list[int]] = {}
    for i, f in enumerate(fields):
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            groups.setdefault(digits or digits_for(f.name), []).append(i)
    if not groups:
        return df
    packed = [F.col(f"`{f.name}`") for f in fields]
    where = {}
    for d, idx in groups.items():
        arr = F.array(*[F.col(f"`{fields[i].name}`").cast("double") for i in idx])
        packed.append(F.transform(arr, _round_lambda(d)).alias(f"__r{d}"))
        for pos, i in enumerate(idx):
            where[i] = (f"__r{d}", pos)
    tmp = df.select(*packed)
    out = []
    for i, f in enumerate(fields):
        if i in where:
            name, pos = where[i]
            out.append(F.col(name).getItem(pos).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return tmp.select(*out)
