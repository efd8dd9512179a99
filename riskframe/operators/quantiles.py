"""Exact, distributed quantiles (linear interpolation, like pandas / numpy,
Spark ``percentile`` and DuckDB ``quantile_cont``).

Spark's exact ``percentile`` keeps a value->count map per group, so a global
median of a continuous column would put every distinct value of the column
into one aggregation buffer.  Here each requested order statistic is found by
iterative histogram narrowing:

  1. one aggregate gives n, min, max per (group, variable);
  2. each target rank r keeps an interval [lo, hi] that contains it and the
     number of values below ``lo``.  One pass buckets the values inside every
     interval into ``bins`` equal-width buckets (``groupBy(target, bucket)``
     with map-side partial aggregation), picks the bucket holding r with a
     window over at most ``bins`` rows per target, and shrinks the interval to
     that bucket's [min, max] -- actual data values;
  3. once an interval holds few values (<= ``exact_below``) the next pass
     groups by the value itself, which resolves the rank exactly.

Only one row per target reaches the driver per pass; the target table that
is broadcast has one row per (group, variable, rank) -- bounded by the
request, not by the data.  Typically 2-3 passes.

Without groups the columns stay side by side: a task counts the buckets of its
own rows with numpy, column by column, and only those counts are shuffled.  A
long form would make one row of every value in every pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import clean_float
from ..session import cut_lineage, ship_package

# Equal-width buckets shrink an interval by their number in every pass, unless
# the values crowd at one end of it.  Intervals that are still open after this
# many passes are resolved by grouping on the values themselves, which always
# ends; the grouping is a distributed aggregate, only larger.
WIDTH_PASSES = 16


def long_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, x) with finite double values only (NaN and Inf count
    as missing)."""
    vals = df.select(*by, *[clean_float(c).alias(c) for c in columns])
    long = vals.unpivot(list(by), list(columns), "variable", "x")
    return long.where(F.col("x").isNotNull())


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    bins: int = 2048,
    exact_below: int = 20000,
    materialize: bool = True,
) -> DataFrame:
    """Long table ``(by..., variable, prob, value)``; value is NULL when the
    column has no non-missing value in the group.

    With ``materialize`` the columns (with ``by``: the narrow long form) are
    written once as a reliable checkpoint, so the passes do not recompute the
    input plan (and survive executor loss)."""
    if not by:
        wide = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
        if materialize:
            wide = cut_lineage(wide)
        return _quantiles_of_columns(wide, list(columns), [float(p) for p in probs], bins, exact_below)
    long = long_numeric(df, columns, by)
    if materialize:
        long = cut_lineage(long)
    key_fields = [f for f in df.select(*by).schema.fields]
    return quantiles_from_long(long, columns, probs, by, key_fields, bins, exact_below)


def _finite(column) -> np.ndarray:
    x = column.to_numpy(zero_copy_only=False)
    return x[np.isfinite(x)]


def _bucket_rows(ids, bucket, count, least, most) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int32()), pa.array(bucket, pa.float64()), pa.array(count, pa.int64()),
         pa.array(least, pa.float64()), pa.array(most, pa.float64())], ["hid", "b", "c", "bmn", "bmx"])


BUCKET_ROWS = "hid int, b double, c long, bmn double, bmx double"


def _range_pass(columns: int):
    """Number, least and greatest of the finite values of each column."""
    def run(batches):
        n, least, most = np.zeros(columns, np.int64), np.full(columns, np.inf), np.full(columns, -np.inf)
        for rb in batches:
            for i in range(columns):
                x = _finite(rb.column(i))
                if len(x):
                    n[i] += len(x)
                    least[i], most[i] = min(least[i], x.min()), max(most[i], x.max())
        at = np.flatnonzero(n)
        yield _bucket_rows(at, np.zeros(len(at)), n[at], least[at], most[at])
    return run


def _bucket_pass(intervals: list[tuple[int, float, float, bool]], bins: int):
    """Count, least and greatest value of each bucket of each interval
    (column, lo, hi, exact); an exact interval's buckets are its values."""
    def run(batches):
        wide = {}
        for rb in batches:
            for h, (i, lo, hi, exact) in enumerate(intervals):
                x = _finite(rb.column(i))
                x = x[(x >= lo) & (x <= hi)]
                if not len(x):
                    continue
                if exact:
                    values, count = np.unique(x, return_counts=True)
                    yield _bucket_rows(np.full(len(values), h), values, count, values, values)
                    continue
                # halves keep (hi - lo) finite for values near the double range limits
                b = np.minimum(np.floor((x / 2 - lo / 2) / (hi / 2 - lo / 2) * bins), bins - 1).astype(np.int64)
                order = np.argsort(b, kind="stable")
                b, x = b[order], x[order]
                cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
                if h not in wide:
                    wide[h] = np.zeros(bins, np.int64), np.full(bins, np.inf), np.full(bins, -np.inf)
                c, least, most = wide[h]
                b = b[cut]
                c[b] += np.diff(np.append(cut, len(x)))
                least[b] = np.minimum(least[b], np.minimum.reduceat(x, cut))
                most[b] = np.maximum(most[b], np.maximum.reduceat(x, cut))
        for h, (c, least, most) in wide.items():
            at = np.flatnonzero(c)
            yield _bucket_rows(np.full(len(at), h), at, c[at], least[at], most[at])
    return run


def _quantiles_of_columns(wide: DataFrame, columns: list[str], probs: list[float], bins: int, exact_below: int) -> DataFrame:
    """``exact_quantiles`` without groups; ``wide`` has the columns as doubles, in order."""
    spark = wide.sparkSession
    ship_package(spark)
    stats = {r["hid"]: r for r in wide.mapInArrow(_range_pass(len(columns)), BUCKET_ROWS).groupBy("hid")
             .agg(F.sum("c").alias("n"), F.min("bmn").alias("mn"), F.max("bmx").alias("mx")).collect()}  # one row per column
    ranks: dict[tuple[int, int], dict] = {}                # (column, rank): the interval that holds it
    for i, r in stats.items():
        for p in probs:
            for rank in (math.floor(p * (r["n"] - 1)), min(math.floor(p * (r["n"] - 1)) + 1, r["n"] - 1)):
                ranks[i, rank] = {"lo": r["mn"], "hi": r["mx"], "below": 0, "cnt": r["n"]}
    passes = 0
    while open_ := {k: t for k, t in ranks.items() if t["lo"] != t["hi"]}:
        passes += 1
        interval = {k: (k[0], t["lo"], t["hi"], t["cnt"] <= exact_below or passes > WIDTH_PASSES) for k, t in open_.items()}
        shared = list(dict.fromkeys(interval.values()))    # ranks of one interval share its buckets
        wanted = spark.createDataFrame([(*k, shared.index(interval[k]), k[1] - t["below"]) for k, t in open_.items()],
                                       "i int, r long, hid int, rel long")
        hist = (wide.mapInArrow(_bucket_pass(shared, bins), BUCKET_ROWS).groupBy("hid", "b")
                .agg(F.sum("c").alias("c"), F.min("bmn").alias("bmn"), F.max("bmx").alias("bmx")))
        w = Window.partitionBy("hid").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("cum", F.sum("c").over(w))
        for r in (hist.join(F.broadcast(wanted), "hid").where((F.col("cum") - F.col("c") <= F.col("rel")) & (F.col("rel") < F.col("cum")))
                  .select("i", "r", (F.col("cum") - F.col("c")).alias("prev"), "c", "bmn", "bmx").collect()):    # one row per rank
            t = ranks[r["i"], r["r"]]
            t["below"] += r["prev"]
            t["lo"], t["hi"], t["cnt"] = r["bmn"], r["bmx"], r["c"]
    out = []
    for i, c in enumerate(columns):
        for p in probs:
            value = None
            if i in stats:
                pos, n = p * (stats[i]["n"] - 1), stats[i]["n"]
                v0, v1 = ranks[i, math.floor(pos)]["lo"], ranks[i, min(math.floor(pos) + 1, n - 1)]["lo"]
                frac = pos - math.floor(pos)
                value = float(v0 if frac == 0 or v0 == v1 else v0 + (v1 - v0) * frac)
            out.append((c, p, value))
    return spark.createDataFrame(out, "variable string, prob double, value double")


def quantiles_from_long(long: DataFrame, columns: Sequence[str], probs: Sequence[float],
                        by: Sequence[str] = (), key_fields=(), bins: int = 2048,
                        exact_below: int = 20000) -> DataFrame:
    """``exact_quantiles`` on an already built long form (by..., variable, x)."""
    spark = long.sparkSession
    by = list(by)
    columns = list(columns)
    probs = [float(p) for p in probs]
    key_fields = list(key_fields)

    stats = (long.groupBy(*by, "variable")
             .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx"))
             .collect())

    # one target per distinct needed rank of every (group, variable)
    targets: dict[int, dict] = {}
    needs: list[tuple] = []  # (group tuple, variable, prob, tid_lo, tid_hi, frac)
    for row in stats:
        g = tuple(row[b] for b in by)
        n = row["n"]
        by_rank: dict[int, int] = {}
        for p in probs:
            pos = p * (n - 1)
            r0 = int(math.floor(pos))
            r1 = min(r0 + 1, n - 1)
            ids = []
            for r in (r0, r1):
                if r not in by_rank:
                    tid = len(targets)
                    by_rank[r] = tid
                    targets[tid] = {"g": g, "variable": row["variable"], "r": r,
                                    "lo": row["mn"], "hi": row["mx"], "below": 0,
                                    "cnt": n, "done": row["mn"] == row["mx"]}
                ids.append(by_rank[r])
            needs.append((g, row["variable"], p, ids[0], ids[1], pos - r0))

    tschema = T.StructType(
        [T.StructField("tid", T.LongType())]
        + [T.StructField(f.name, f.dataType) for f in key_fields]
        + [T.StructField("variable", T.StringType()),
           T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()),
           T.StructField("rel", T.LongType()), T.StructField("exact", T.BooleanType())])

    passes = 0
    while True:
        passes += 1
        open_ = [(tid, t) for tid, t in targets.items() if not t["done"]]
        if not open_:
            break
        tdf = spark.createDataFrame(
            [(tid, *t["g"], t["variable"], float(t["lo"]), float(t["hi"]),
              int(t["r"] - t["below"]), t["cnt"] <= exact_below or passes > WIDTH_PASSES) for tid, t in open_],
            tschema)
        j = long.join(F.broadcast(tdf), [*by, "variable"]).where(
            (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
        # halves keep (hi - lo) finite for values near the double range limits
        width = F.col("hi") / 2 - F.col("lo") / 2
        bucket = F.when(F.col("exact"), F.col("x")).otherwise(
            F.least(F.floor((F.col("x") / 2 - F.col("lo") / 2) / width * bins), F.lit(bins - 1))
            .cast("double"))
        hist = (j.groupBy("tid", "rel", bucket.alias("b"))
                .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("bmn"), F.max("x").alias("bmx")))
        w = Window.partitionBy("tid").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("cum", F.sum("c").over(w))
        chosen = (hist.where((F.col("cum") - F.col("c") <= F.col("rel")) & (F.col("rel") < F.col("cum")))
                  .select("tid", (F.col("cum") - F.col("c")).alias("prev"), "c", "bmn", "bmx")
                  .collect())
        for row in chosen:
            t = targets[row["tid"]]
            t["below"] += row["prev"]
            t["lo"], t["hi"], t["cnt"] = row["bmn"], row["bmx"], row["c"]
            t["done"] = row["bmn"] == row["bmx"]

    out = []
    seen = set()
    for g, var, p, t0, t1, frac in needs:
        v0, v1 = targets[t0]["lo"], targets[t1]["lo"]
        val = v0 if frac == 0 or v0 == v1 else v0 + (v1 - v0) * frac
        out.append((*g, var, p, float(val)))
        seen.add((g, var))
    # columns with no value in a group -> NULL rows, so callers see every column
    groups = {tuple(r[b] for b in by) for r in stats} or ({()} if not by else set())
    for g in groups:
        for var in columns:
            if (g, var) not in seen:
                for p in probs:
                    out.append((*g, var, p, None))
    oschema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in key_fields]
        + [T.StructField("variable", T.StringType()), T.StructField("prob", T.DoubleType()),
           T.StructField("value", T.DoubleType())])
    return spark.createDataFrame(out, oschema)


def quantile_map(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict:
    """{(variable, prob): value} for ungrouped quantiles (small, for fitting)."""
    rows = exact_quantiles(df, columns, probs).collect()
    return {(r["variable"], r["prob"]): r["value"] for r in rows}
