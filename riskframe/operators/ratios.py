"""Application-level derived features (B6-B9): row-wise mean / std of the
external scores, the std's missing values filled with its median, and the
nine business ratios -- one projection of built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import row_mean, row_std, safe_divide
from .quantiles import quantile_map

# The nine application ratios of the reference pipeline,
# (output name, numerator role, denominator role).
APPLICATION_RATIOS = [
    ("CREDIT_TO_ANNUITY_RATIO", "AMT_CREDIT", "AMT_ANNUITY"),
    ("CREDIT_TO_GOODS_RATIO", "AMT_CREDIT", "AMT_GOODS_PRICE"),
    ("ANNUITY_TO_INCOME_RATIO", "AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    ("CREDIT_TO_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
    ("INCOME_PER_PERSON", "AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    ("DAYS_EMPLOYED_PERC", "DAYS_EMPLOYED", "DAYS_BIRTH"),
    ("PAYMENT_RATE", "AMT_ANNUITY", "AMT_CREDIT"),
    ("PHONE_CHANGE_TO_BIRTH_RATIO", "DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    ("ID_PUBLISH_TO_BIRTH_RATIO", "DAYS_ID_PUBLISH", "DAYS_BIRTH"),
]


def add_application_ratios(df: DataFrame, roles: Mapping[str, str],
                           ratios: Sequence[tuple[str, str, str]] = APPLICATION_RATIOS) -> DataFrame:
    """Each ratio whose two roles are mapped to columns of ``df``."""
    new = {name: safe_divide(roles[num], roles[den]) for name, num, den in ratios
           if roles.get(num) in df.columns and roles.get(den) in df.columns}
    return df.withColumns(new) if new else df


def add_score_summary(df: DataFrame, sources: Sequence[str], prefix: str = "EXT_SOURCES") -> DataFrame:
    """Mean and sample std over the non-missing sources of each
    row; a std that cannot be computed takes the exact median of the std
    column over the same frame."""
    out = df.withColumns({f"{prefix}_MEAN": row_mean(sources), f"{prefix}_STD": row_std(sources)})
    med = quantile_map(out, [f"{prefix}_STD"], [0.5])[(f"{prefix}_STD", 0.5)]
    if med is None:
        return out
    return out.withColumn(f"{prefix}_STD", F.coalesce(F.col(f"{prefix}_STD"), F.lit(float(med))))
