"""Association with a binary target.

All statistics are computed for all variables at once from long-form
aggregates: ``unpivot -> groupBy(variable[, value], y)``; the only driver
collects are decision tables with one row per variable.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import MISSING_TOKEN, clean_float, numeric_columns
from ..session import cut_lineage
from .profile import column_stats, median_by_class
from .rank import running_totals
from .split import exact_sample


# --- G1 ------------------------------------------------------------------------
def target_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every column with the target on pair-complete
    rows; NULL for fewer than 2 pairs or zero variance (Spark's ``corr``
    raises on zero variance under ANSI, so it is written as a guarded
    covariance ratio).  Also returns the pair count."""
    cols = list(columns) if columns is not None else numeric_columns(df, [target])
    y = clean_float(target)
    long = (df.select(y.alias("_y"), *[clean_float(c).alias(c) for c in cols])
            .unpivot(["_y"], cols, "variable", "x")
            .where(F.col("x").isNotNull() & F.col("_y").isNotNull()))
    g = long.groupBy("variable").agg(
        F.count(F.lit(1)).alias("non_null_count"), F.covar_pop("x", "_y").alias("_cov"),
        F.stddev_pop("x").alias("_sx"), F.stddev_pop("_y").alias("_sy"))
    corr = F.when(F.col("non_null_count") >= 2,
                  F.col("_cov") / F.nullif(F.col("_sx") * F.col("_sy"), F.lit(0.0)))
    return g.select("variable", corr.alias("corr"), F.abs(corr).alias("abs_corr"), "non_null_count")


# --- G2 ------------------------------------------------------------------------
def numeric_target_report(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with more than 2 distinct values: corr, abs_corr, missing
    ratio, nunique, medians by class and their gap; sorted abs_corr desc."""
    cols = list(columns) if columns is not None else numeric_columns(df, [target])
    stats = column_stats(df, cols).where(F.col("nunique") > 2)
    keep = [r["variable"] for r in stats.select("variable").collect()]  # <= one row per column
    if not keep:
        return df.sparkSession.createDataFrame(
            [], "variable string, corr double, abs_corr double, missing_ratio double, nunique long, "
                "median_0 double, median_1 double, gap double, abs_gap double")
    corr = target_correlations(df, target, keep)
    med = median_by_class(df, target, keep)
    out = (stats.select("variable", (F.col("null_count") / F.col("rows")).alias("missing_ratio"), "nunique")
           .join(corr.select("variable", "corr", "abs_corr"), "variable")
           .join(med, "variable", "left"))
    return out.select("variable", "corr", "abs_corr", "missing_ratio", "nunique", "median_0", "median_1",
                      "gap", "abs_gap").orderBy(F.col("abs_corr").desc_nulls_last(), "variable")


# --- G3 / G12 -------------------------------------------------------------------
def select_informative(report: DataFrame, min_corr_abs: float, top_n: int,
                       max_missing_ratio: float = 0.40, min_unique_values: int = 10) -> DataFrame:
    """Filter the G2 report, sort by abs_corr, keep top_n; when the filter
    leaves nothing, fall back to the unfiltered top_n."""
    f = report.where((F.col("abs_corr") >= min_corr_abs) & (F.col("missing_ratio") <= max_missing_ratio)
                     & (F.col("nunique") >= min_unique_values))
    order = [F.col("abs_corr").desc_nulls_last(), F.col("variable")]
    if f.limit(1).count() == 0:
        return report.orderBy(*order).limit(top_n)
    return f.orderBy(*order).limit(top_n)


def coverage_filtered_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                                   max_missing: float = 0.60, min_non_null: int = 500,
                                   min_share: float = 0.10) -> DataFrame:
    """Correlation report restricted to columns with enough coverage:
    missing ratio <= max_missing and pair count >= max(min_non_null,
    min_share * rows)."""
    cols = list(columns) if columns is not None else numeric_columns(df, [target])
    corr = target_correlations(df, target, cols)
    stats = column_stats(df, cols).select("variable", (F.col("null_count") / F.col("rows")).alias("missing_ratio"),
                                          "rows")
    j = corr.join(stats, "variable")
    floor_n = F.greatest(F.lit(float(min_non_null)), F.lit(min_share) * F.col("rows"))
    return (j.where((F.col("missing_ratio") <= max_missing) & (F.col("non_null_count") >= floor_n))
            .select("variable", "corr", "abs_corr", "missing_ratio", "non_null_count")
            .orderBy(F.col("abs_corr").desc_nulls_last(), "variable"))


# --- G4 ------------------------------------------------------------------------
RANK_BROADCAST_ROWS = 200_000  # rank tables up to this size are broadcast, larger ones joined by a shuffle


def spearman_matrix(df: DataFrame, columns: Sequence[str], key: Sequence[str] = (), sample_n: int | None = None,
                    seed: int = 42) -> DataFrame:
    """Spearman correlation (average ranks over pair-complete rows, as pandas'
    pairwise ``corr(method="spearman")``) of every pair of columns, on the
    whole frame (or on an exact seeded sample of ``sample_n`` rows when given).
    Columns with a single value have no ranks to correlate and are left out.

    A column's ranks are computed over its non-missing rows; a pair whose
    partner column has missing values gets its own ranks over the
    pair-complete rows.  All rank tables come from ONE long-form count of
    distinct values and one grouped, bucketed running sum (average rank =
    #smaller + (#equal + 1) / 2).  All ranks of a column are one table by value,
    joined back once: by broadcast where its counted size allows, so that only
    columns of many distinct values (which have no hot value) shuffle rows.
    Every pair correlation comes from one aggregate."""
    s = df.select(*key, *[clean_float(c).alias(c) for c in columns])
    if sample_n:
        s = exact_sample(s, sample_n, list(key), seed)
    s = cut_lineage(s.select(*columns))  # read by the rank tables and the final aggregate
    none = df.sparkSession.createDataFrame([], "var_a string, var_b string, spearman double, n long")
    facts = s.agg(*[x for c in columns for x in (F.count_if(F.col(c).isNull()).alias(f"null_{c}"),
                                                 (F.min(c) < F.max(c)).alias(f"varies_{c}"))]).first()
    columns = [c for c in columns if facts[f"varies_{c}"]]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    if not pairs:
        return none
    nullable = {c for c in columns if facts[f"null_{c}"] > 0}
    # rank id -> (column, partner or None)
    specs: list[tuple[str, str | None]] = [(c, None) for c in columns]
    for a, b in pairs:
        for x, y in ((a, b), (b, a)):
            if y in nullable:
                specs.append((x, y))
    items = []
    for rid, (x, y) in enumerate(specs):
        cond = F.col(x).isNotNull() if y is None else F.col(x).isNotNull() & F.col(y).isNotNull()
        items.append(F.when(cond, F.struct(F.lit(rid).alias("rid"), F.col(x).alias("v"))))
    long = s.select(F.explode(F.filter(F.array(*items), lambda e: e.isNotNull())).alias("e")).select("e.rid", "e.v")
    counts = long.groupBy("rid", "v").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    cum = running_totals(counts, "v", ["_n"], by=["rid"])
    table = cut_lineage(cum.select("rid", "v", (F.col("cum__n") - F.col("_n") + (F.col("_n") + 1) / 2).alias("r")))
    sizes = {r["rid"]: r["n"] for r in table.groupBy("rid").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per rank id
    ranked, name = s, {}
    for c in columns:
        mine = [rid for rid, (x, _) in enumerate(specs) if x == c]
        name.update({specs[rid]: f"_r{rid}" for rid in mine})
        t = (table.where(F.col("rid").isin(mine)).groupBy(F.col("v").alias("_v"))
             .agg(*[F.max(F.when(F.col("rid") == rid, F.col("r"))).alias(f"_r{rid}") for rid in mine]))
        if max(sizes.get(rid, 0) for rid in mine) <= RANK_BROADCAST_ROWS:
            t = F.broadcast(t)
        ranked = ranked.join(t, F.col(c) == F.col("_v"), "left").drop("_v")
    rows = []
    for a, b in pairs:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        ra = F.when(both, F.col(name.get((a, b), name[(a, None)])))
        rb = F.when(both, F.col(name.get((b, a), name[(b, None)])))
        n = F.count_if(both)
        rho = F.when(n >= 2, F.covar_pop(ra, rb) / F.nullif(F.stddev_pop(ra) * F.stddev_pop(rb), F.lit(0.0)))
        rows.append(F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), rho.alias("spearman"), n.alias("n")))
    return ranked.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


# --- G5 / G6 / G7 ----------------------------------------------------------------
CF_TERMS = 400  # of the continued fraction; it converges like its terms / sqrt(z)


def chi2_sf(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution, Q(dof/2, x/2), as a
    JVM-side expression (a = dof/2, z = x/2; a is a multiple of 1/2).

    Below z = a + 1 it is one minus the power series of the lower regularized
    gamma function.  Above, where that difference would lose every digit, it
    is Legendre's continued fraction of the upper one,
    z^a e^-z / Gamma(a) * 1/(z+1-a - 1(1-a)/(z+3-a - 2(2-a)/(z+5-a - ...))),
    evaluated from its far end; small tails keep their relative precision down
    to the smallest doubles."""
    a = dof.cast("double") / 2
    z = x.cast("double") / 2
    # lnGamma(a + 1) for a = m/2: sum of ln(a - i) over the integer steps, times Gamma(1.5) when m is odd
    steps = F.floor(a).cast("int")
    lg = F.aggregate(F.sequence(F.lit(0), steps - 1), F.lit(0.0), lambda acc, i: acc + F.log(a - i))
    lg = F.when(steps > 0, lg).otherwise(F.lit(0.0)) + F.when(a - F.floor(a) > 0, F.lit(math.log(math.sqrt(math.pi) / 2))).otherwise(F.lit(0.0))
    n_terms = (z + F.lit(12.0) * F.sqrt(z + 1) + F.lit(40)).cast("int")
    first = a * F.log(z) - z - lg
    acc0 = F.struct(first.alias("lt"), F.exp(first).alias("s"))
    series = F.aggregate(
        F.sequence(F.lit(1), n_terms), acc0,
        lambda acc, n: F.struct((acc["lt"] + F.log(z) - F.log(a + n)).alias("lt"),
                                (acc["s"] + F.exp(acc["lt"] + F.log(z) - F.log(a + n))).alias("s")),
        lambda acc: acc["s"])
    far_end = z + F.lit(2.0 * CF_TERMS + 1) - a
    fraction = F.aggregate(F.sequence(F.lit(CF_TERMS), F.lit(1), F.lit(-1)), far_end,
                           lambda acc, n: z + 2 * n - 1 - a - n * (n - a) / acc)
    # z^a e^-z / Gamma(a) = a * z^a e^-z / Gamma(a + 1)
    upper = a * F.exp(first) / fraction
    return (F.when(x.isNull() | dof.isNull(), F.lit(None).cast("double"))
            .when(z <= 0, F.lit(1.0))
            .when(z > a + 1, upper)
            .otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - series)))


def _label(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TOKEN))


def contingency_long(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(variable, value, y, o): non-zero contingency cells of every variable
    (NULL category -> missing token; rows with a NULL target are left out)."""
    cols = list(columns)
    long = (df.where(F.col(target).isNotNull())
            .select(F.col(target).alias("_y"), *[_label(c).alias(c) for c in cols])
            .unpivot(["_y"], cols, "variable", "value"))
    return long.groupBy("variable", "value", "_y").agg(F.count(F.lit(1)).alias("o"))


def categorical_association(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """chi2 (Yates-corrected when dof = 1, as scipy's default), p_value,
    nb_modalities and the bias-corrected Cramer's V of every variable;
    variables with fewer than 2 modalities or classes are skipped; sorted V
    desc, chi2 desc.

    Zero cells are not materialised: each modality row adds the term of the
    classes it lacks from the class totals (a literal array over the few
    target classes), so no grid of all (value, class) pairs is built."""
    cells = contingency_long(df, columns, target)
    rows_t = cells.groupBy("variable", "value").agg(F.sum("o").alias("ri"),
                                                    F.collect_set("_y").alias("present"))
    cols_t = cells.groupBy("variable", "_y").agg(F.sum("o").alias("cj"))
    dims = (cols_t.groupBy("variable").agg(F.count(F.lit(1)).alias("k"), F.sum("cj").alias("n"),
                                           F.collect_list(F.struct("_y", "cj")).alias("classes"))
            .join(rows_t.groupBy("variable").agg(F.count(F.lit(1)).alias("r")), "variable"))
    yates = (F.col("r") == 2) & (F.col("k") == 2)

    def term(o: Column, e: Column) -> Column:
        d = e - o
        adj = F.when(yates, o + F.signum(d) * F.least(F.lit(0.5), F.abs(d))).otherwise(o)
        return (adj - e) * (adj - e) / e

    # observed cells
    c = (cells.join(rows_t.select("variable", "value", "ri"), ["variable", "value"])
         .join(cols_t, ["variable", "_y"]).join(dims.select("variable", "n", "r", "k"), "variable"))
    obs = c.groupBy("variable").agg(F.sum(term(F.col("o").cast("double"),
                                               F.col("ri") * F.col("cj") / F.col("n"))).alias("_obs"))
    # zero cells: per modality, the classes it does not contain
    z = rows_t.join(dims, "variable").select(
        "variable",
        F.aggregate(F.filter("classes", lambda s: ~F.array_contains(F.col("present"), s["_y"])),
                    F.lit(0.0),
                    lambda acc, s: acc + term(F.lit(0.0), F.col("ri") * s["cj"] / F.col("n"))).alias("_zt"))
    zero = z.groupBy("variable").agg(F.sum("_zt").alias("_zero"))
    stats = dims.join(obs, "variable").join(zero, "variable", "left").where((F.col("r") >= 2) & (F.col("k") >= 2))
    chi2 = F.col("_obs") + F.coalesce(F.col("_zero"), F.lit(0.0))
    n = F.col("n").cast("double")
    r = F.col("r").cast("double")
    k = F.col("k").cast("double")
    phi2corr = F.greatest(F.lit(0.0), F.col("chi2") / n - (k - 1) * (r - 1) / (n - 1))
    denom = F.least(k - (k - 1) * (k - 1) / (n - 1) - 1, r - (r - 1) * (r - 1) / (n - 1) - 1)
    v = F.when((n > 1) & (denom > 0), F.sqrt(phi2corr / denom))
    dof = (F.col("r") - 1) * (F.col("k") - 1)
    out = stats.withColumn("chi2", chi2).select(
        "variable", "chi2", chi2_sf(F.col("chi2"), dof).alias("p_value"),
        F.col("r").alias("nb_modalities"), dof.alias("dof"), v.alias("cramers_v"))
    return out.orderBy(F.col("cramers_v").desc_nulls_last(), F.col("chi2").desc(), "variable")


# --- G8 / G9 -------------------------------------------------------------------
def modality_gaps(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Per variable and modality (NULL -> missing token): n_obs, share_obs,
    n_target_1, target_rate, gap / ratio vs the global rate, abs_gap; sorted
    abs_gap desc, n_obs desc."""
    cols = list(columns)
    y = F.col(target).cast("double")
    long = (df.select(y.alias("_y"), *[_label(c).alias(c) for c in cols])
            .unpivot(["_y"], cols, "variable", "modality"))
    g = long.groupBy("variable", "modality").agg(
        F.count(F.lit(1)).alias("n_obs"), F.count("_y").alias("_ny"),
        F.sum("_y").alias("n_target_1"), F.avg("_y").alias("target_rate"))
    # every row appears once per variable, so the global totals are sums over
    # the variable's modalities: one row per variable, joined back (a proven
    # bound -- no window holding all modalities of a high-cardinality column)
    tot = g.groupBy("variable").agg(F.sum("n_obs").alias("_n"),
                                    (F.sum("n_target_1") / F.sum("_ny")).alias("_rate"))
    j = g.join(F.broadcast(tot), "variable")
    gap = F.col("target_rate") - F.col("_rate")
    return (j.select("variable", "modality", "n_obs", (F.col("n_obs") / F.col("_n")).alias("share_obs"),
                     "n_target_1", "target_rate", gap.alias("gap_vs_global"),
                     F.when(F.col("_rate") > 0, F.col("target_rate") / F.col("_rate")).alias("ratio_vs_global"),
                     F.abs(gap).alias("abs_gap"))
            .orderBy(F.col("abs_gap").desc_nulls_last(), F.col("n_obs").desc(), "variable", "modality"))


def binary_flag_columns(df: DataFrame, target: str) -> list[str]:
    """Columns (target excluded) with exactly 2 distinct non-null values."""
    cols = [c for c in df.columns if c != target]
    s = column_stats(df, cols).where(F.col("nunique") == 2).select("variable").collect()
    keep = {r["variable"] for r in s}
    return [c for c in cols if c in keep]


def binary_flag_gaps(df: DataFrame, target: str) -> DataFrame:
    """``modality_gaps`` over the detected binary columns."""
    return modality_gaps(df, binary_flag_columns(df, target), target)


# --- G10 / G11 -------------------------------------------------------------------
def supported_gaps(gaps: DataFrame, min_obs: int, min_gap: float, fallback_n: int) -> DataFrame:
    """Modalities with n_obs >= min_obs and abs_gap >= min_gap; falls back to
    the first ``fallback_n`` rows of the sorted table when none qualifies."""
    order = [F.col("abs_gap").desc_nulls_last(), F.col("n_obs").desc(), "variable", "modality"]
    f = gaps.where((F.col("n_obs") >= min_obs) & (F.col("abs_gap") >= min_gap))
    if f.limit(1).count() == 0:
        return gaps.orderBy(*order).limit(fallback_n)
    return f.orderBy(*order)


def riskiest(gaps: DataFrame, n: int = 20, protective: bool = False) -> DataFrame:
    """Modalities with the highest (or lowest) gap, then most observed."""
    g = F.col("gap_vs_global")
    return gaps.orderBy(g.asc() if protective else g.desc(), F.col("n_obs").desc(),
                        "variable", "modality").limit(n)
