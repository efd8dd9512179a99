"""Registered queries of the feature layer (A, B, D, E operators) and their
DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions.rounding import sig_round_doubles
from ..operators.aggspec import aggregate_block
from ..operators.encode import fit_vocabulary
from ..operators.joins import join_audit
from . import mart as M
from . import sqlgen as S
from . import tables as T

# Fixed category values of the test tables (used by the oracle text only; the
# Spark side fits them from the data).
RETURNFLAGS = ["A", "N", "R"]
ORDER_STATUSES = ["F", "O", "P"]
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

DAYS_ORDER_SQL = "(CAST(o_orderdate AS DATE) - DATE '2002-01-01')"


# ---------------------------------------------------------------------------
# client_feature_mart (A5, B1, B13, C1 fit, D1-D3, E1-E10, H3 nullness)
# ---------------------------------------------------------------------------
def q_client_feature_mart(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(M.client_feature_mart(spark, sf))


def _lines_cte(doubles: set) -> str:
    items = S.spec_select(M.LINE_SPEC, None, doubles, {"l_quantity"})
    items += S.dummy_means("l_returnflag", RETURNFLAGS, None, doubles)
    return f"SELECT l_orderkey, {', '.join(items)} FROM lineitem GROUP BY l_orderkey"


def _ord_parts():
    """CTEs and output columns of the ORD block, reference style."""
    dbl: set = set()
    lines = _lines_cte(dbl)
    o_cte = (f"SELECT o.*, CAST({DAYS_ORDER_SQL} AS INTEGER) AS DAYS_ORDER, li.* EXCLUDE (l_orderkey) "
             f"FROM orders o LEFT JOIN lines li ON o.o_orderkey = li.l_orderkey")
    spec = dict(M.ORD_SPEC)
    for v in RETURNFLAGS + ["nan"]:
        spec[f"l_returnflag_{v}_MEAN"] = ["mean"]
    double_in = {"o_totalprice", "l_quantity_MIN", "l_quantity_MAX"}
    out_cols = []
    items = S.spec_select(spec, "ORD", dbl, double_in)
    items += S.dummy_means("o_orderstatus", ORDER_STATUSES, "ORD", dbl)
    items += S.dummy_means("o_orderpriority", ORDER_PRIORITIES, "ORD", dbl)
    items.append('count(*) AS "ORD_COUNT"')
    ord_cte = f"SELECT o_custkey AS c_custkey, {', '.join(items)} FROM o GROUP BY o_custkey"
    out_cols += [i.rsplit(" AS ", 1)[1].strip('"') for i in items]
    subs = {}
    for name, status in (("ACTIVE", T.ORDER_STATUS_ACTIVE), ("CLOSED", T.ORDER_STATUS_CLOSED)):
        sitems = S.spec_select(M.SUBSET_SPEC, name, dbl, double_in)
        sitems.append(f'count(*) AS "{name}_COUNT"')
        subs[name] = (f"SELECT o_custkey AS c_custkey, {', '.join(sitems)} FROM o "
                      f"WHERE o_orderstatus = '{status}' GROUP BY o_custkey")
        out_cols += [i.rsplit(" AS ", 1)[1].strip('"') for i in sitems]
    return lines, o_cte, ord_cte, subs, out_cols, dbl


def _evt_parts():
    dbl: set = set()
    dummies = ", ".join(f"CASE WHEN event_type = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"event_type_{v}\""
                        for v in EVENT_TYPES)
    ev = (f"SELECT user_id AS c_custkey, value, {dummies}, "
          f"CASE WHEN event_type IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS event_type_nan FROM events")
    cols = ["value"] + [f"event_type_{v}" for v in EVENT_TYPES] + ["event_type_nan"]
    spec = {c: M.EVT_SPEC_AGGS for c in cols}
    items = S.spec_select(spec, "EVT", dbl, set(cols))
    items.append('count(*) AS "EVT_COUNT"')
    evt = f"SELECT c_custkey, {', '.join(items)} FROM ev GROUP BY c_custkey"
    return ev, evt, [i.rsplit(" AS ", 1)[1].strip('"') for i in items], dbl


def sql_client_feature_mart() -> str:
    lines, o_cte, ord_cte, subs, ord_cols, dbl = _ord_parts()
    ev, evt, evt_cols, dbl2 = _evt_parts()
    dbl |= dbl2
    ratios = []
    for name, num, den in M.POST_JOIN_RATIOS:
        ratios.append(f"{S.safe_div_sql(S.q(num), S.q(den))} AS {S.q(name)}")
        dbl.add(name)
    base_cols = ["c_custkey", "TARGET", "c_nationkey", "n_regionkey", "c_mktsegment"]
    joined = (f"SELECT app.*, ord.* EXCLUDE (c_custkey), act.* EXCLUDE (c_custkey), "
              f"clo.* EXCLUDE (c_custkey), evt.* EXCLUDE (c_custkey) FROM app "
              f"LEFT JOIN ord ON app.c_custkey = ord.c_custkey "
              f"LEFT JOIN act ON app.c_custkey = act.c_custkey "
              f"LEFT JOIN clo ON app.c_custkey = clo.c_custkey "
              f"LEFT JOIN evt ON app.c_custkey = evt.c_custkey")
    with_ratios = f"SELECT *, {', '.join(ratios)} FROM joined"
    cols = base_cols + ord_cols + evt_cols + [n for n, _, _ in M.POST_JOIN_RATIOS]
    return (f"WITH app AS {T.APPLICATION_SQL}, lines AS ({lines}), o AS ({o_cte}), "
            f"ord AS ({ord_cte}), act AS ({subs['ACTIVE']}), clo AS ({subs['CLOSED']}), "
            f"ev AS ({ev}), evt AS ({evt}), joined AS ({joined}), wr AS ({with_ratios}) "
            + S.outer_select(cols, dbl, "wr"))


# ---------------------------------------------------------------------------
# two_hop_agg (E1 + D1): lineitem -> order -> client
# ---------------------------------------------------------------------------
TWO_HOP_SPEC = {"l_quantity_MIN": ["min"], "l_quantity_MAX": ["max"],
                "l_quantity_SIZE": ["mean", "sum"]}


def q_two_hop_agg(spark: SparkSession, sf: str) -> DataFrame:
    orders = T.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    lines = M.line_summary(li, fit_vocabulary(li, ["l_returnflag"], max_categories=T.MAX_DUMMIES))
    o = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey", "o_orderkey")
    out = aggregate_block(o.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "ORD",
                          TWO_HOP_SPEC, count_name="ORD_COUNT")
    return sig_round_doubles(out)


def sql_two_hop_agg() -> str:
    dbl: set = set()
    lines = _lines_cte(dbl)
    items = S.spec_select(TWO_HOP_SPEC, "ORD", dbl, {"l_quantity_MIN", "l_quantity_MAX"})
    items.append('count(*) AS "ORD_COUNT"')
    cols = ["c_custkey"] + [i.rsplit(" AS ", 1)[1].strip('"') for i in items]
    return (f"WITH lines AS ({lines}), o AS (SELECT o.o_custkey, li.* FROM orders o "
            f"LEFT JOIN lines li ON o.o_orderkey = li.l_orderkey), "
            f"agg AS (SELECT o_custkey AS c_custkey, {', '.join(items)} FROM o GROUP BY o_custkey) "
            + S.outer_select(cols, dbl, "agg"))


# ---------------------------------------------------------------------------
# filtered_agg (E3/E6): ACTIVE / CLOSED subsets in one pass
# ---------------------------------------------------------------------------
FILTER_SPEC = {"o_totalprice": ["min", "max", "mean", "var", "sum"], "o_orderkey": ["nunique"]}


def q_filtered_agg(spark: SparkSession, sf: str) -> DataFrame:
    o = T.table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    out = aggregate_block(o, "c_custkey", "ORD", FILTER_SPEC,
                          subsets={"ACTIVE": F.col("o_orderstatus") == T.ORDER_STATUS_ACTIVE,
                                   "CLOSED": F.col("o_orderstatus") == T.ORDER_STATUS_CLOSED},
                          count_name="ORD_COUNT")
    return sig_round_doubles(out)


def sql_filtered_agg() -> str:
    dbl: set = set()
    parts, cols = {}, ["c_custkey"]
    for name, where in (("ORD", ""), ("ACTIVE", f"WHERE o_orderstatus = '{T.ORDER_STATUS_ACTIVE}'"),
                        ("CLOSED", f"WHERE o_orderstatus = '{T.ORDER_STATUS_CLOSED}'")):
        items = S.spec_select(FILTER_SPEC, name, dbl, {"o_totalprice"})
        items.append(f'count(*) AS "{name}_COUNT"')
        parts[name] = f"SELECT o_custkey AS c_custkey, {', '.join(items)} FROM orders {where} GROUP BY o_custkey"
        cols += [i.rsplit(" AS ", 1)[1].strip('"') for i in items]
    j = ("SELECT a.*, b.* EXCLUDE (c_custkey), c.* EXCLUDE (c_custkey) FROM a "
         "LEFT JOIN b ON a.c_custkey = b.c_custkey LEFT JOIN c ON a.c_custkey = c.c_custkey")
    return (f"WITH a AS ({parts['ORD']}), b AS ({parts['ACTIVE']}), c AS ({parts['CLOSED']}), "
            f"j AS ({j}) " + S.outer_select(cols, dbl, "j"))


# ---------------------------------------------------------------------------
# all_columns_agg (E9): every non-id column x {min,max,mean,sum,var}
# ---------------------------------------------------------------------------
def q_all_columns_agg(spark: SparkSession, sf: str) -> DataFrame:
    return sig_round_doubles(M.events_block(spark, sf))


def sql_all_columns_agg() -> str:
    ev, evt, cols, dbl = _evt_parts()
    return f"WITH ev AS ({ev}), evt AS ({evt}) " + S.outer_select(["c_custkey"] + cols, dbl, "evt")


# ---------------------------------------------------------------------------
# join_audit (D4): rows before / after each block join
# ---------------------------------------------------------------------------
def q_join_audit(spark: SparkSession, sf: str) -> DataFrame:
    return join_audit(T.application(spark, sf), M.feature_blocks(spark, sf), M.KEY)


def sql_join_audit() -> str:
    lines, o_cte, ord_cte, subs, ord_cols, _ = _ord_parts()
    ev, evt, evt_cols, _ = _evt_parts()
    n_ord = len(ord_cols)
    n_evt = len(evt_cols)
    return (f"WITH app AS {T.APPLICATION_SQL}, lines AS ({lines}), o AS ({o_cte}), ord AS ({ord_cte}), "
            f"ev AS ({ev}), evt AS ({evt}), "
            f"j1 AS (SELECT app.c_custkey FROM app LEFT JOIN ord ON app.c_custkey = ord.c_custkey), "
            f"j2 AS (SELECT j1.c_custkey FROM j1 LEFT JOIN evt ON j1.c_custkey = evt.c_custkey) "
            f"SELECT 1 AS step, 'ORD' AS block, (SELECT count(*) FROM app) AS rows_before, "
            f"(SELECT count(*) FROM j1) AS rows_after, {n_ord} AS added_columns "
            f"UNION ALL SELECT 2, 'EVT', (SELECT count(*) FROM j1), (SELECT count(*) FROM j2), {n_evt}")


# ---------------------------------------------------------------------------
# safe_ratio (B1/B10/B11), sentinel (B4/B5), rowwise_stats (B6/B7),
# dpd_clip (B11/B12)
# ---------------------------------------------------------------------------
def q_safe_ratio(spark: SparkSession, sf: str) -> DataFrame:
    li = T.table(spark, sf, "lineitem")
    return sig_round_doubles(li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        X.safe_divide(F.col("l_extendedprice") * F.col("l_discount"), "l_tax").alias("DISCOUNT_TO_TAX"),
        X.safe_divide("l_tax", "l_discount").alias("TAX_TO_DISCOUNT")))


def sql_safe_ratio() -> str:
    return ("WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, "
            f"{S.safe_div_sql('l_extendedprice * l_discount', 'l_tax')} AS DISCOUNT_TO_TAX, "
            f"{S.safe_div_sql('l_tax', 'l_discount')} AS TAX_TO_DISCOUNT FROM lineitem) "
            + S.outer_select(["l_orderkey", "l_linenumber", "l_partkey", "DISCOUNT_TO_TAX",
                              "TAX_TO_DISCOUNT"], {"DISCOUNT_TO_TAX", "TAX_TO_DISCOUNT"}, "r"))


PART_SIZE_SENTINEL = 50  # plays the 365243 "no date" marker on part sizes


def q_sentinel(spark: SparkSession, sf: str) -> DataFrame:
    p = T.table(spark, sf, "part").select("p_partkey", "p_size", "p_type")
    flagged = p.withColumn("P_SIZE_ANOM", X.sentinel_flag("p_size", PART_SIZE_SENTINEL))
    cleaned = X.nullify_sentinels(flagged, ["p_size"], PART_SIZE_SENTINEL)
    return cleaned.where(X.not_equal_keep_null("p_type", "__never__"))


def sql_sentinel() -> str:
    k = PART_SIZE_SENTINEL
    return (f"SELECT p_partkey, nullif(p_size, {k}) AS p_size, p_type, "
            f"CAST(coalesce(p_size = {k}, false) AS INTEGER) AS P_SIZE_ANOM FROM part "
            f"WHERE p_type IS DISTINCT FROM '__never__'")


ROW_COLS = ["l_discount", "l_tax", "Q50"]


def _row_inputs(li: DataFrame) -> DataFrame:
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
                     F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
                     F.nullif(F.col("l_quantity") / 50, F.lit(1.0)).alias("Q50"))


def q_rowwise_stats(spark: SparkSession, sf: str) -> DataFrame:
    li = _row_inputs(T.table(spark, sf, "lineitem"))
    return sig_round_doubles(li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        X.row_mean(ROW_COLS).alias("ROW_MEAN"), X.row_std(ROW_COLS).alias("ROW_STD")))


def sql_rowwise_stats() -> str:
    lst = f"list_filter([{', '.join(ROW_COLS)}], lambda x: x IS NOT NULL)"
    mean = f"(CASE WHEN len({lst}) > 0 THEN list_sum({lst}) / len({lst}) END)"
    std = (f"(CASE WHEN len({lst}) >= 2 THEN sqrt(list_sum(list_transform({lst}, lambda x: "
           f"(x - list_sum({lst}) / len({lst})) * (x - list_sum({lst}) / len({lst})))) / (len({lst}) - 1)) END)")
    return ("WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0) AS l_discount, "
            "nullif(l_tax, 0) AS l_tax, nullif(l_quantity / 50, 1.0) AS Q50 FROM lineitem), "
            f"r AS (SELECT l_orderkey, l_linenumber, l_partkey, {mean} AS ROW_MEAN, {std} AS ROW_STD FROM i) "
            + S.outer_select(["l_orderkey", "l_linenumber", "l_partkey", "ROW_MEAN", "ROW_STD"],
                             {"ROW_MEAN", "ROW_STD"}, "r"))


SHIP_GRACE_DAYS = 60  # plays the instalment due date: order date + 60 days


def q_dpd_clip(spark: SparkSession, sf: str) -> DataFrame:
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
                                               "l_extendedprice", "l_discount")
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    late = (F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
            - F.lit(SHIP_GRACE_DAYS))
    paid = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return sig_round_doubles(j.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        X.clip_at_zero(late).alias("DPD"), X.clip_at_zero(-late).alias("DBD"),
        X.safe_divide(paid, "l_extendedprice").alias("PAYMENT_PERC"),
        (F.col("l_extendedprice") - paid).alias("PAYMENT_DIFF")))


def sql_dpd_clip() -> str:
    late = f"(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) - {SHIP_GRACE_DAYS})"
    return ("WITH r AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, "
            f"CAST(CASE WHEN {late} IS NOT NULL THEN greatest({late}, 0) END AS INTEGER) AS DPD, "
            f"CAST(CASE WHEN {late} IS NOT NULL THEN greatest(-{late}, 0) END AS INTEGER) AS DBD, "
            f"{S.safe_div_sql('l.l_extendedprice * (1.0 - l.l_discount)', 'l.l_extendedprice')} AS PAYMENT_PERC, "
            "l.l_extendedprice - l.l_extendedprice * (1.0 - l.l_discount) AS PAYMENT_DIFF "
            "FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey) "
            + S.outer_select(["l_orderkey", "l_linenumber", "l_partkey", "DPD", "DBD", "PAYMENT_PERC",
                              "PAYMENT_DIFF"], {"PAYMENT_PERC", "PAYMENT_DIFF"}, "r"))


# ---------------------------------------------------------------------------
# status_map (B3 value mapping, B23 label text, B18 missing token)
# ---------------------------------------------------------------------------
STATUS_CODES = {"F": 0, "O": 1}   # like F/M and N/Y -> 0/1; other values -> NULL


def q_status_map(spark: SparkSession, sf: str) -> DataFrame:
    o = T.table(spark, sf, "orders")
    return o.select("o_orderkey", X.map_values("o_orderstatus", STATUS_CODES).alias("STATUS_CODE"),
                    X.modality_label(F.lit("o_orderpriority"), X.category_label("o_orderpriority")).alias("LABEL"))


def sql_status_map() -> str:
    return ("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS STATUS_CODE, "
            "'o_orderpriority = ' || coalesce(o_orderpriority, '__MISSING__') AS LABEL FROM orders")


QUERIES = {
    "status_map": q_status_map,
    "client_feature_mart": q_client_feature_mart,
    "two_hop_agg": q_two_hop_agg,
    "filtered_agg": q_filtered_agg,
    "all_columns_agg": q_all_columns_agg,
    "join_audit": q_join_audit,
    "safe_ratio": q_safe_ratio,
    "sentinel": q_sentinel,
    "rowwise_stats": q_rowwise_stats,
    "dpd_clip": q_dpd_clip,
}

ORACLES = {
    "status_map": sql_status_map,
    "client_feature_mart": sql_client_feature_mart,
    "two_hop_agg": sql_two_hop_agg,
    "filtered_agg": sql_filtered_agg,
    "all_columns_agg": sql_all_columns_agg,
    "join_audit": sql_join_audit,
    "safe_ratio": sql_safe_ratio,
    "sentinel": sql_sentinel,
    "rowwise_stats": sql_rowwise_stats,
    "dpd_clip": sql_dpd_clip,
}


def mart_columns() -> list[str]:
    """Output columns of the client feature mart, in oracle order."""
    _, _, _, _, ord_cols, _ = _ord_parts()
    _, _, evt_cols, _ = _evt_parts()
    return (["c_custkey", "TARGET", "c_nationkey", "n_regionkey", "c_mktsegment"] + ord_cols + evt_cols
            + [n for n, _, _ in M.POST_JOIN_RATIOS])


def mart_numeric_columns() -> list[str]:
    return [c for c in mart_columns() if c not in ("c_custkey", "TARGET", "c_mktsegment")]
