"""Joins of pre-aggregated feature blocks.

Blocks are aggregated to one row per key *before* they are joined, so a left
join never fans out.  All blocks come out of a hash aggregate on the same key,
so the join chain reuses that hash partitioning (one shuffle of the base
table); AQE turns joins with small blocks into broadcast joins from runtime
sizes, so no block is broadcast on a guess.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys with each other: a group whose key
    is NULL keeps its rows."""
    new = {c: f"_right_{c}" for c in on}
    r = right.withColumnsRenamed(new)
    cond = None
    for c, n in new.items():
        same = left[c].eqNullSafe(r[n])
        cond = same if cond is None else cond & same
    return left.join(r, cond, how).drop(*new.values())


def join_child_summary(parent: DataFrame, child_summary: DataFrame, key: str,
                       drop_key: bool = True) -> DataFrame:
    """Parent ⟕ child summary on ``key`` (then optionally drop the key)."""
    out = parent.join(child_summary, key, "left")
    return out.drop(key) if drop_key else out


def join_blocks(base: DataFrame, blocks: Mapping[str, DataFrame], key: str) -> DataFrame:
    """D3: chain of left joins of unique-per-key blocks onto ``base``.
    Every base row is kept; a block's columns are NULL where it has no row."""
    out = base
    for _, blk in blocks.items():
        out = out.join(blk, key, "left")
    return out


def join_audit(base: DataFrame, blocks: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row per join step with the row count before and after and the
    number of added columns.  A left join multiplies a base row by the number of
    block rows of its key (by one where there is none), so all counts follow
    from the rows per key: one narrow count of each side, joined on the key
    once, and one aggregate; no block is joined in full."""
    keys = base.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    for i, blk in enumerate(blocks.values()):
        keys = keys.join(blk.groupBy(key).agg(F.count(F.lit(1)).alias(f"_m{i}")), key, "left")
    so_far, sums = F.col("_rows"), [F.sum("_rows")]
    for i in range(len(blocks)):
        so_far = so_far * F.coalesce(F.col(f"_m{i}"), F.lit(1))
        sums.append(F.sum(so_far))
    sums = [F.coalesce(x, F.lit(0)) for x in sums]
    steps = [F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("block"), sums[i].alias("rows_before"),
                      sums[i + 1].alias("rows_after"), F.lit(len([c for c in blk.columns if c != key])).alias("added_columns"))
             for i, (name, blk) in enumerate(blocks.items())]
    return keys.agg(F.array(*steps).alias("steps")).select(F.inline("steps"))


def lookup_with_default(df: DataFrame, catalog: DataFrame, key: str,
                        defaults: Mapping[str, object]) -> DataFrame:
    """Left join of a small catalog with a default for absent keys."""
    out = df.join(catalog, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def keep_members(df: DataFrame, members: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Membership filter as a left-semi join."""
    return df.join(members, on, "left_semi")
