"""Helpers that write the DuckDB oracle SQL for the registered queries.

The oracle is deliberately formulated the way the original pandas pipeline
works -- one aggregate per subset, then left joins -- so it checks the
single-pass conditional aggregation of the Spark side rather than mirroring
it.  Every double in an oracle result goes through the same significant-digit
rounding as the Spark result (``functions.rounding``).
"""

from __future__ import annotations

from ..functions.rounding import digits_for, sig_sql


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def agg_sql(col: str, agg: str) -> tuple[str, bool]:
    """(SQL aggregate, is_double) with the pandas null rules."""
    x = q(col)
    d = f"CAST({x} AS DOUBLE)"
    if agg == "min":
        return f"min({x})", None
    if agg == "max":
        return f"max({x})", None
    if agg == "mean":
        return f"avg({d})", True
    if agg == "sum":
        return f"CAST(coalesce(sum({d}), 0) AS DOUBLE)", True
    if agg == "var":
        return f"var_samp({d})", True
    if agg == "size":
        return "count(*)", False
    if agg == "nunique":
        return f"count(DISTINCT {x})", False
    raise ValueError(agg)


def spec_select(spec: dict, prefix: str | None, doubles: set, double_inputs: set) -> list[str]:
    """``agg AS "PREFIX_col_AGG"`` items; registers double outputs in
    ``doubles`` (min/max are double when the input column is)."""
    items = []
    for col, aggs in spec.items():
        for a in aggs:
            expr, is_d = agg_sql(col, a)
            name = f"{prefix}_{col}_{a.upper()}" if prefix else f"{col}_{a.upper()}"
            if is_d or (is_d is None and col in double_inputs):
                doubles.add(name)
            items.append(f"{expr} AS {q(name)}")
    return items


def dummy_means(col: str, values, prefix: str | None, doubles: set) -> list[str]:
    items = []
    for v in list(values) + [None]:
        label = "nan" if v is None else v
        name = f"{prefix}_{col}_{label}_MEAN" if prefix else f"{col}_{label}_MEAN"
        cond = f"{q(col)} IS NULL" if v is None else f"{q(col)} = '{v}'"
        items.append(f"avg(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END::DOUBLE) AS {q(name)}")
        doubles.add(name)
    return items


def outer_select(columns: list[str], doubles: set, source: str) -> str:
    """Final projection with significant-digit rounding of doubles."""
    items = []
    for c in columns:
        items.append(f"{sig_sql(q(c), digits_for(c))} AS {q(c)}" if c in doubles else q(c))
    return f"SELECT {', '.join(items)} FROM {source}"


def safe_div_sql(num: str, den: str) -> str:
    n = f"CAST({num} AS DOUBLE)"
    d = f"CAST({den} AS DOUBLE)"
    return f"({n} / nullif({d}, 0))"


def bigint_count_if(sql: str) -> str:
    """DuckDB's ``count_if`` returns HUGEINT where Spark's returns BIGINT:
    wrap every ``count_if(...)`` in ``CAST(... AS BIGINT)``."""
    out, i, token = [], 0, "count_if("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(token) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        out.append("CAST(" + bigint_count_if(sql[j:k + 1].replace(token, "\x00", 1)).replace("\x00", token)
                   + " AS BIGINT)")
        i = k + 1
