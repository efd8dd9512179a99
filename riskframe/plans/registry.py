"""All registered queries: name -> (spark, sf_dir) -> DataFrame, and the
DuckDB oracle SQL of those that have one."""

from __future__ import annotations

import importlib

from .sqlgen import bigint_count_if

_MODULES = ["features", "encoding", "profiling", "association", "evaluation", "modeling", "reports", "domain", "files"]


def _load():
    queries, oracles = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(f"{__package__}.{m}")
        queries.update(mod.QUERIES)
        oracles.update({k: bigint_count_if(v()) for k, v in mod.ORACLES.items()})
    return queries, oracles


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
