"""Ordering, ranking and top-k (I1-I5) plus the distributed row-number /
running-sum helpers used by splits, folds and the curve metrics.

A window with an ORDER BY but no PARTITION BY runs in ONE task.  To number
or accumulate rows in a global order at scale, the order is cut into
contiguous buckets by a bucket expression that is monotone in the order key:

  * for hash orders (seeded md5 -- splits, folds, samples) the bucket is the
    top bits of the hash, which is uniform, so every bucket has about n / B
    rows, whatever the skew of the data;
  * for value orders (scores) the bucket comes from approximate quantiles of
    the distinct values (the inputs are pre-aggregated to distinct values).

Per (group, bucket) totals are a small table (groups x B rows); their
running sum gives each bucket's offset, and the window only runs inside one
(group, bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_null_safe

HASH_BUCKET_BITS = 20  # ~1e6 rows per ranking window at 1e12 rows


def seeded_hash(cols: Sequence[str], seed: int) -> Column:
    """md5 over 'seed:col1:col2...' -- the deterministic 'random' order used
    for samples, splits and folds (identical text in Spark and DuckDB)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def hash_bucket(h: Column, bits: int = HASH_BUCKET_BITS) -> Column:
    """Top ``bits`` bits of a hex md5 (monotone in the hash order)."""
    hexd = (bits + 3) // 4
    v = F.conv(F.substring(h, 1, hexd), 16, 10).cast("long")
    return F.shiftright(v, hexd * 4 - bits)


def row_number_by_buckets(df: DataFrame, order: Sequence[str], bucket: Column,
                          by: Sequence[str] = (), name: str = "rn") -> DataFrame:
    """``row_number() over (partition by by order by order)`` computed as
    bucket offset + row number inside (by, bucket).  ``bucket`` must be
    non-decreasing in ``order`` within each group."""
    by = list(by)
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*by, "_bucket").orderBy(*order)
    return (join_null_safe(b, offsets, [*by, "_bucket"])
            .withColumn(name, F.col("_off") + F.row_number().over(inner))
            .drop("_bucket", "_off"))


def hash_rank(df: DataFrame, key: Sequence[str], seed: int, by: Sequence[str] = (),
              name: str = "rn", bits: int = HASH_BUCKET_BITS) -> DataFrame:
    """Row number within ``by`` in seeded-md5 order of ``key`` (ties on the
    hash are broken by the key itself)."""
    h = seeded_hash(key, seed)
    d = df.withColumn("_h", h)
    return row_number_by_buckets(d, ["_h", *key], hash_bucket(F.col("_h"), bits), by, name).drop("_h")


def running_totals(df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (),
                   n_buckets: int | None = None, prefix: str = "cum_", materialize: bool = True) -> DataFrame:
    """Inclusive running sums of ``sums`` in ascending ``order`` within each
    ``by`` group (order values unique per group, e.g. the distinct scores of
    a curve).  Buckets come from approximate quantiles of ``order`` (shared by
    all groups); per (group, bucket) totals give the offsets (a window over at
    most ``n_buckets`` rows per group) and the running sum itself is a window
    over one (group, bucket) only."""
    by = list(by)
    spark = df.sparkSession
    if n_buckets is None:
        n_buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = df.withColumn("_o", F.col(order).cast("double"))
    if materialize:
        # read twice (bucket bounds, then the sums): write the (distinct-value)
        # input once instead of recomputing its aggregation
        from ..session import cut_lineage
        d = cut_lineage(d)
    bounds = []
    if n_buckets > 1:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        bounds = sorted(set(x for x in (d.approxQuantile("_o", probs, 0.001) or []) if x is not None))
    if bounds:
        # binary search on the JVM (any bucketing monotone in the order works)
        from pyspark.ml.feature import Bucketizer
        splits = [float("-inf")] + [float(x) for x in bounds] + [float("inf")]
        d = Bucketizer(splits=splits, inputCol="_o", outputCol="_bucket", handleInvalid="keep").transform(d)
    else:
        d = d.withColumn("_bucket", F.lit(0.0))
    tot = d.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    w_off = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*by, "_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}")
                                        for c in sums])
    inner = Window.partitionBy(*by, "_bucket").orderBy("_o").rowsBetween(Window.unboundedPreceding, 0)
    out = join_null_safe(d, offs, [*by, "_bucket"])  # groups x buckets rows; AQE broadcasts it when small
    out = out.withColumns({f"{prefix}{c}": F.col(f"_off_{c}") + F.sum(c).over(inner) for c in sums})
    return out.drop("_o", "_bucket", *[f"_off_{c}" for c in sums])


# --- I1-I5 -------------------------------------------------------------------
def sort_by(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """Multi-key mixed-direction sort, nulls last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last()
                        for c, asc in keys])


def top_k(df: DataFrame, keys: Sequence[tuple[str, bool]], k: int) -> DataFrame:
    """Top-k head (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return sort_by(df, keys).limit(k)


def positional_rank(df: DataFrame, keys: Sequence[tuple[str, bool]], name: str = "rank") -> DataFrame:
    """Unique positional rank (method='first').  Meant for report-sized
    frames (one row per model / variable / threshold)."""
    w = Window.orderBy(*[F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last()
                         for c, asc in keys])
    return df.withColumn(name, F.row_number().over(w))


def best_row(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """I4: the best row under tie-breaking keys."""
    return top_k(df, keys, 1)


def arg_max(df: DataFrame, value: str, score: str) -> DataFrame:
    """``max_by(value, score)`` as one aggregate."""
    return df.agg(F.max_by(value, score).alias(value), F.max(score).alias(score))
