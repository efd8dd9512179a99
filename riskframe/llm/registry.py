"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import importlib

MODULES = ["ngram_join", "quality_lines", "language_ppm", "decontaminate", "packing", "kd_shards", "license_scan", "chat_format", "warc", "html_wrapper",
           "spelling", "lexical_search", "vector_search"]


def _modules():
    return [importlib.import_module(f"{__package__}.{m}") for m in MODULES]


def queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in _modules() for k, v in m.ORACLES.items()}
