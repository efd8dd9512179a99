"""Set operations, alignment, splits, folds and exact samples (H1-H9).

Every "random" choice is a seeded md5 order, so a split is reproducible,
independent of partitioning and checkable in SQL.  Ranks inside a class are
computed with hash buckets (``rank.hash_rank``): a class holding most rows is
still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_null_safe
from .rank import hash_rank, seeded_hash


def union_align(*frames: DataFrame) -> DataFrame:
    """H1: UNION ALL by name; a column absent from a frame is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def left_align(df: DataFrame, reference_columns: Sequence[str], types: dict | None = None) -> DataFrame:
    """H2: take the reference's columns in its order; absent ones are NULL."""
    types = types or {}
    return df.select(*[F.col(c) if c in df.columns
                       else F.lit(None).cast(types.get(c, "double")).alias(c)
                       for c in reference_columns])


def split_on_target(df: DataFrame, target: str = "TARGET") -> tuple[DataFrame, DataFrame]:
    """H3: train = labelled rows (target cast to int), test = the others
    without the target column."""
    train = df.where(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("int"))
    test = df.where(F.col(target).isNull()).drop(target)
    return train, test


EXACT_SAMPLE_BUCKET_ROWS = 1_000_000  # the one bucket that gets ordered is refined below this size


def exact_sample(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """H4 / H9: exactly min(n, rows) rows -- the n smallest seeded hashes
    (ties broken by the key).  Not ``orderBy().limit(n)``: that would merge n
    rows from every partition in one task.  Instead rows are counted per
    16-bit slice of the hash (a table of at most 65 536 rows), buckets before
    the one holding the n-th row are kept whole, and that one bucket is
    refined with the next 16 bits until it holds few rows; only then is it
    ordered."""
    h = df.withColumn("_h", seeded_hash(key, seed))
    parts, taken, cur = [], 0, h
    for level in range(8):  # 8 x 16 bits = the whole md5
        b = F.conv(F.substring("_h", 4 * level + 1, 4), 16, 10).cast("long")
        counts = sorted((r["b"], r["c"]) for r in
                        cur.groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("c")).collect())
        cut = None
        for bv, c in counts:
            if taken + c >= n:
                cut, cut_rows = bv, c
                break
            taken += c
        if cut is None:  # fewer than n rows left: all of them
            parts.append(cur)
            break
        parts.append(cur.where(b < cut))
        cur = cur.where(b == cut)
        if cut_rows <= EXACT_SAMPLE_BUCKET_ROWS or level == 7:
            parts.append(cur.orderBy("_h", *key).limit(n - taken))
            break
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("_h")


def _n_test(n, pct: int):
    """round-half-up(n * pct / 100) in integer arithmetic."""
    return F.floor((n * F.lit(pct) + F.lit(50)) / F.lit(100)).cast("long")


def stratified_holdout(df: DataFrame, label: str, key: Sequence[str], test_pct: int = 20,
                       seed: int = 42, name: str = "is_test") -> DataFrame:
    """H5: per class, the round(test_pct% of the class) rows with the smallest
    seeded hash are test rows; class shares are kept.  Rows without a label are
    a class of their own."""
    ranked = hash_rank(df, key, seed, by=[label], name="_rn")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))  # one row per class
    return (join_null_safe(ranked, sizes, [label])
            .withColumn(name, (F.col("_rn") <= _n_test(F.col("_nc"), test_pct)).cast("int"))
            .drop("_rn", "_nc"))


def holdout(df: DataFrame, key: Sequence[str], test_pct: int = 20, seed: int = 42,
            name: str = "is_test") -> DataFrame:
    """H6: unstratified version of H5."""
    ranked = hash_rank(df, key, seed, name="_rn")
    n = df.count()
    n_test = (n * test_pct + 50) // 100
    return ranked.withColumn(name, (F.col("_rn") <= F.lit(n_test)).cast("int")).drop("_rn")


def kfold(df: DataFrame, key: Sequence[str], k: int = 5, seed: int = 42,
          label: str | Sequence[str] | None = None, name: str = "fold") -> DataFrame:
    """H7 / H8: fold = (rank - 1) mod k in seeded-hash order, within each class
    when ``label`` is given (fold sizes differ by at most one per class);
    several stratification columns may be given."""
    by = [] if label is None else ([label] if isinstance(label, str) else list(label))
    ranked = hash_rank(df, key, seed, by=by, name="_rn")
    return ranked.withColumn(name, ((F.col("_rn") - 1) % k).cast("int")).drop("_rn")
