"""Registered queries of the domain blocks: the given tables take the roles of
the reference's tables (``ROLES``), whose columns are derived from them.

Amounts are the tables' amounts times powers of two, so both engines hold the
same numbers before the aggregates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.rounding import sig_round_doubles
from ..operators import blocks as B
from ..operators.encode import fit_vocabularies
from ..session import ensure_checkpoint_dir
from ..sources.files import hand_over_bucketed
from . import sqlgen as S
from . import tables as T

KEY = B.KEY


def _roles(days) -> dict[str, str]:
    """SELECT of each role; ``days(column)`` = day offset in the engine's SQL.
    The statements are otherwise common to both engines."""
    return {
        "application": f"""SELECT c_custkey AS SK_ID_CURR, abs(c_acctbal) * 4 AS AMT_CREDIT,
            CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE abs(c_acctbal) * 2 END AS AMT_INCOME_TOTAL FROM customer""",
        "bureau": f"""SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
            CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Sold' END AS CREDIT_ACTIVE,
            o_orderpriority AS CREDIT_TYPE, {days('o_orderdate')} AS DAYS_CREDIT,
            CASE WHEN o_orderstatus <> 'P' THEN {days('o_orderdate')} + 365 END AS DAYS_CREDIT_ENDDATE,
            {days('o_orderdate')} + 30 AS DAYS_CREDIT_UPDATE, o_orderkey % 7 AS CREDIT_DAY_OVERDUE,
            CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 0.25e0 END AS AMT_CREDIT_MAX_OVERDUE, o_totalprice AS AMT_CREDIT_SUM,
            CASE o_orderstatus WHEN 'O' THEN o_totalprice * 0.5e0 WHEN 'F' THEN 0e0 END AS AMT_CREDIT_SUM_DEBT,
            CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 0.125e0 ELSE 0e0 END AS AMT_CREDIT_SUM_OVERDUE,
            CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice * 2e0 END AS AMT_CREDIT_SUM_LIMIT,
            o_totalprice * 0.0625e0 AS AMT_ANNUITY, o_orderkey % 3 AS CNT_CREDIT_PROLONG FROM orders""",
        "balance": f"""SELECT l_orderkey AS SK_ID_BUREAU, CAST(floor({days('l_shipdate')} / 30e0) AS INT) AS MONTHS_BALANCE,
            l_returnflag AS STATUS FROM lineitem""",
        "previous": f"""SELECT o_custkey AS SK_ID_CURR, l_orderkey * 8 + l_linenumber AS SK_ID_PREV,
            CASE l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
            l_linestatus AS NAME_CONTRACT_TYPE, l_extendedprice * 0.0625e0 AS AMT_ANNUITY, l_extendedprice AS AMT_APPLICATION,
            CASE WHEN l_quantity > 40 THEN 0e0 WHEN l_quantity > 20 THEN l_extendedprice * 2e0 ELSE l_extendedprice END AS AMT_CREDIT,
            CASE WHEN l_discount > 0.02e0 THEN l_extendedprice * 0.125e0 END AS AMT_DOWN_PAYMENT, l_extendedprice AS AMT_GOODS_PRICE,
            l_linenumber AS HOUR_APPR_PROCESS_START, l_discount AS RATE_DOWN_PAYMENT, {days('l_shipdate')} AS DAYS_DECISION,
            l_quantity AS CNT_PAYMENT, CASE WHEN l_returnflag = 'N' THEN 365243 ELSE {days('l_shipdate')} END AS DAYS_TERMINATION
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "pos": """SELECT user_id AS SK_ID_CURR, -(event_id % 36) AS MONTHS_BALANCE, event_id % 5 AS SK_DPD,
            CASE WHEN event_type <> 'click' THEN event_id % 2 END AS SK_DPD_DEF, event_type AS NAME_CONTRACT_STATUS FROM events""",
        "instalments": f"""SELECT o_custkey AS SK_ID_CURR, l_linenumber AS NUM_INSTALMENT_VERSION,
            {days('o_orderdate')} + 60 AS DAYS_INSTALMENT, CASE WHEN l_linenumber <> 3 THEN {days('l_shipdate')} END AS DAYS_ENTRY_PAYMENT,
            l_extendedprice AS AMT_INSTALMENT, CASE WHEN l_quantity > 10 THEN l_extendedprice ELSE l_extendedprice * 0.5e0 END AS AMT_PAYMENT
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "card": """SELECT user_id AS SK_ID_CURR, event_id AS SK_ID_PREV, value AS AMT_BALANCE, event_id % 4 AS CNT_DRAWINGS,
            event_type AS NAME_CONTRACT_STATUS FROM events""",
    }


_SPARK_DAYS = lambda c: f"datediff(CAST({c} AS DATE), DATE '{T.REFERENCE_DATE}')"
_DUCK_DAYS = lambda c: f"CAST(CAST({c} AS DATE) - DATE '{T.REFERENCE_DATE}' AS INTEGER)"
TEXT = {"bureau": ["CREDIT_ACTIVE", "CREDIT_TYPE"], "balance": ["STATUS"], "previous": ["NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE"],
        "pos": ["NAME_CONTRACT_STATUS"], "card": ["NAME_CONTRACT_STATUS"]}
VALUES = {("bureau", "CREDIT_ACTIVE"): ["Active", "Closed", "Sold"],
          ("bureau", "CREDIT_TYPE"): ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
          ("balance", "STATUS"): ["A", "N", "R"], ("previous", "NAME_CONTRACT_STATUS"): ["Approved", "Canceled", "Refused"],
          ("previous", "NAME_CONTRACT_TYPE"): ["F", "O"]}


ORDER_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def role_tables(spark: SparkSession, sf: str, names, order_lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """``order_lines``: the lines joined with their orders, if they are at hand."""
    sources = ("customer", "orders", "lineitem", "events")
    out = {}
    for n in names:
        sql = _roles(_SPARK_DAYS)[n]
        if order_lines is not None and ORDER_LINES in sql:
            out[n] = spark.sql(sql.replace(ORDER_LINES, "{order_lines}"), order_lines=order_lines)
            continue
        used = {t: T.table(spark, sf, t) for t in sources if f" {t}" in sql}
        for t in used:
            sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
        out[n] = spark.sql(sql, **used)
    return out


def _vocabularies(tables):
    return fit_vocabularies({n: (d, TEXT[n]) for n, d in tables.items() if n in TEXT}, max_categories=T.MAX_DUMMIES)


def q_bureau_block(spark: SparkSession, sf: str) -> DataFrame:
    t = role_tables(spark, sf, ["bureau", "balance"])
    v = _vocabularies(t)
    return sig_round_doubles(B.bureau_block(t["bureau"], t["balance"], v["bureau"], v["balance"]))


def _single(name: str, builder):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        t = role_tables(spark, sf, [name])
        v = _vocabularies(t) if name in TEXT else {}
        return sig_round_doubles(builder(t[name], v[name]) if name in TEXT else builder(t[name]))
    run.__name__ = f"q_{name}_block"
    return run


def q_post_join_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """The five-block build: every client once, and the nine ratios."""
    t = role_tables(spark, sf, list(_roles(_SPARK_DAYS)))
    app = t.pop("application")
    full = B.five_blocks(app, t, _vocabularies(t))
    return sig_round_doubles(full.select(KEY, "AMT_CREDIT", "BURO_COUNT", "PREV_COUNT", "POS_COUNT", "INSTAL_COUNT", "CC_COUNT",
                                         *[n for n, _, _ in B.POST_JOIN_RATIOS]))


def q_bucketed_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """D3: the same build with blocks handed over bucketed by client.  The lines
    with their orders, which two blocks and the vocabularies read, are joined and
    moved to their client once."""
    buckets = 16
    lines, orders = T.table(spark, sf, "lineitem"), T.table(spark, sf, "orders")
    lines = (lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
             .select("o_custkey", "o_orderdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                     "l_returnflag", "l_linestatus", "l_shipdate"))
    lines = hand_over_bucketed(lines, "o_custkey", buckets, f"{ensure_checkpoint_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}")
    t = role_tables(spark, sf, list(_roles(_SPARK_DAYS)), lines)
    app = t.pop("application")
    full = B.five_blocks(app, t, _vocabularies(t), buckets, ("previous", "instalments"))
    return sig_round_doubles(full.select(KEY, "AMT_CREDIT", "BURO_COUNT", "PREV_COUNT", "POS_COUNT", "INSTAL_COUNT", "CC_COUNT",
                                         *[n for n, _, _ in B.POST_JOIN_RATIOS]))


# --- oracles: one subquery per block and per subset, then left joins --------------------------------
_DOUBLE = {"AMT_CREDIT", "AMT_INCOME_TOTAL", "AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE",
           "AMT_CREDIT_SUM_LIMIT", "AMT_ANNUITY", "AMT_APPLICATION", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE", "RATE_DOWN_PAYMENT",
           "CNT_PAYMENT", "APP_CREDIT_PERC", "PAYMENT_PERC", "PAYMENT_DIFF", "AMT_INSTALMENT", "AMT_PAYMENT", "AMT_BALANCE"}


def _block_ctes(name: str, src: str, prefix: str, spec: dict, subsets: dict, dummies: list[tuple[str, list]], extra: dict):
    """(CTEs, output columns, double columns) of one block over the CTE ``src``."""
    dbl: set = set()
    doubles_in = _DOUBLE | set(extra)
    items = S.spec_select({**spec, **extra}, prefix, dbl, doubles_in)
    for col, values in dummies:
        items += S.dummy_means(col, values, prefix, dbl)
    items.append(f'count(*) AS "{prefix}_COUNT"')
    cols = [i.rsplit(" AS ", 1)[1].strip('"') for i in items]
    ctes = [f"{name}_main AS (SELECT {KEY}, {', '.join(items)} FROM {src} GROUP BY {KEY})"]
    joins = ""
    for sub, (col, value) in subsets.items():
        part = S.spec_select(spec, sub, dbl, doubles_in) + [f'count(*) AS "{sub}_COUNT"']
        ctes.append(f"{name}_{sub} AS (SELECT {KEY}, {', '.join(part)} FROM {src} WHERE {col} = '{value}' GROUP BY {KEY})")
        cols += [i.rsplit(" AS ", 1)[1].strip('"') for i in part]
        joins += f" LEFT JOIN {name}_{sub} ON {name}_main.{KEY} = {name}_{sub}.{KEY}"
    parts = ", ".join([f"{name}_main.*"] + [f"{name}_{s}.* EXCLUDE ({KEY})" for s in subsets])
    ctes.append(f"{name} AS (SELECT {parts} FROM {name}_main{joins})")
    return ctes, cols, dbl


def _bureau_ctes():
    r = _roles(_DUCK_DAYS)
    dbl: set = set()
    months = S.spec_select(B.BUREAU_BALANCE_SPEC, None, dbl, set()) + S.dummy_means("STATUS", VALUES["balance", "STATUS"], None, dbl)
    freq = {f"STATUS_{v}_MEAN": ["mean"] for v in [*VALUES["balance", "STATUS"], "nan"]}
    ctes = [f"bur AS ({r['bureau']})", f"bal AS ({r['balance']})",
            f"months AS (SELECT SK_ID_BUREAU, {', '.join(months)} FROM bal GROUP BY SK_ID_BUREAU)",
            "hist AS (SELECT bur.*, months.* EXCLUDE (SK_ID_BUREAU) FROM bur LEFT JOIN months ON bur.SK_ID_BUREAU = months.SK_ID_BUREAU)"]
    more, cols, d = _block_ctes("buro", "hist", "BURO", B.BUREAU_SPEC, B.BUREAU_SUBSETS,
                                [(c, VALUES["bureau", c]) for c in TEXT["bureau"]], freq)
    return ctes + more, cols, d


def _previous_ctes():
    src = (f"prv AS (SELECT *, {S.safe_div_sql('AMT_APPLICATION', 'AMT_CREDIT')} AS APP_CREDIT_PERC "
           f"FROM ({_roles(_DUCK_DAYS)['previous']}))")
    more, cols, d = _block_ctes("prev", "prv", "PREV", B.PREVIOUS_SPEC, B.PREVIOUS_SUBSETS,
                                [(c, VALUES["previous", c]) for c in TEXT["previous"]], {})
    return [src, *more], cols, d


def _pos_ctes():
    from .features import EVENT_TYPES
    more, cols, d = _block_ctes("pos", "psc", "POS", B.POS_SPEC, {}, [("NAME_CONTRACT_STATUS", EVENT_TYPES)], {})
    return [f"psc AS ({_roles(_DUCK_DAYS)['pos']})", *more], cols, d


def _instalments_ctes():
    late = "(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT)"
    src = (f"ins AS (SELECT *, {S.safe_div_sql('AMT_PAYMENT', 'AMT_INSTALMENT')} AS PAYMENT_PERC, AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF, "
           f"CASE WHEN {late} IS NOT NULL THEN greatest({late}, 0) END AS DPD, CASE WHEN {late} IS NOT NULL THEN greatest(-{late}, 0) END AS DBD "
           f"FROM ({_roles(_DUCK_DAYS)['instalments']}))")
    more, cols, d = _block_ctes("instal", "ins", "INSTAL", B.INSTALMENTS_SPEC, {}, [], {})
    return [src, *more], cols, d


def _card_ctes():
    from .features import EVENT_TYPES
    names = [f"NAME_CONTRACT_STATUS_{v}" for v in EVENT_TYPES] + ["NAME_CONTRACT_STATUS_nan"]
    dummies = [f"CASE WHEN NAME_CONTRACT_STATUS = '{v}' THEN 1e0 ELSE 0e0 END AS {S.q(n)}" for v, n in zip(EVENT_TYPES, names)]
    dummies.append(f"CASE WHEN NAME_CONTRACT_STATUS IS NULL THEN 1e0 ELSE 0e0 END AS {S.q(names[-1])}")
    src = f"crd AS (SELECT {KEY}, AMT_BALANCE, CNT_DRAWINGS, {', '.join(dummies)} FROM ({_roles(_DUCK_DAYS)['card']}))"
    more, cols, d = _block_ctes("cc", "crd", "CC", {"AMT_BALANCE": B.CARD_AGGREGATES, "CNT_DRAWINGS": B.CARD_AGGREGATES}, {}, [],
                                {n: B.CARD_AGGREGATES for n in names})
    return [src, *more], cols, d


def _block_sql(parts, name: str) -> str:
    ctes, cols, dbl = parts()
    return f"WITH {', '.join(ctes)} " + S.outer_select([KEY, *cols], dbl, name)


def sql_post_join_ratios() -> str:
    ctes, joins, known = [f"app AS ({_roles(_DUCK_DAYS)['application']})"], "", {}
    for name, parts in (("buro", _bureau_ctes), ("prev", _previous_ctes), ("pos", _pos_ctes), ("instal", _instalments_ctes), ("cc", _card_ctes)):
        more, cols, _ = parts()
        ctes += more
        known.update({c: f"{name}.{S.q(c)}" for c in cols})
        joins += f" LEFT JOIN {name} ON app.{KEY} = {name}.{KEY}"
    at = lambda c: known.get(c, f"app.{c}")
    counts = [f"{p}_COUNT" for p in ("BURO", "PREV", "POS", "INSTAL", "CC")]
    items = [f"app.{KEY}", "app.AMT_CREDIT", *[at(c) for c in counts],
             *[f"{S.safe_div_sql(at(a), at(b))} AS {n}" for n, a, b in B.POST_JOIN_RATIOS]]
    names = [n for n, _, _ in B.POST_JOIN_RATIOS]
    return (f"WITH {', '.join(ctes)}, r AS (SELECT {', '.join(items)} FROM app{joins}) "
            + S.outer_select([KEY, "AMT_CREDIT", *counts, *names], {"AMT_CREDIT", *names}, "r"))


QUERIES = {"bureau_block": q_bureau_block, "previous_block": _single("previous", B.previous_block), "pos_block": _single("pos", B.pos_block),
           "instalments_block": _single("instalments", B.instalments_block), "card_block": _single("card", B.card_block),
           "post_join_ratios": q_post_join_ratios, "bucketed_blocks": q_bucketed_blocks}
ORACLES = {"bureau_block": lambda: _block_sql(_bureau_ctes, "buro"), "previous_block": lambda: _block_sql(_previous_ctes, "prev"),
           "pos_block": lambda: _block_sql(_pos_ctes, "pos"), "instalments_block": lambda: _block_sql(_instalments_ctes, "instal"),
           "card_block": lambda: _block_sql(_card_ctes, "cc"), "post_join_ratios": sql_post_join_ratios,
           "bucketed_blocks": sql_post_join_ratios}
