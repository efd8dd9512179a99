"""Ranked lexical search against brute force."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from riskframe.llm import lexical_search as X

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def search(docs, items, k=50):
    docs = [(d, Counter(terms(t))) for d, t in docs]
    docs = [(d, c) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for i, ts in wanted.items():
        found = []
        for d, c in docs:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


EDGE = [(-1, None), (-2, ""), (-3, " .,; "), (None, "alpha beta gamma"), (None, "alpha beta gamma"), (-4, "alpha alpha ALPHA beta"),
        (-4, "alpha alpha ALPHA beta"), (-5, "beta " * 30000 + "alpha"), (-6, "Été ñandú 123 alpha"), (-7, "alpha"), (-8, "alpha")]
ITEMS = [(1, "alpha, Beta!"), (2, "gamma delta"), (2, "ñandú"), (3, None), (4, "..."), (None, "alpha"), (None, "123"), (5, "absent words")]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_edge_rows_match_brute_force(spark, k):
    docs = spark.createDataFrame([(*r, 1, "z") for r in EDGE], "doc_id long, text string, m long, term string")
    items = spark.createDataFrame([(*r, 1) for r in ITEMS], "item_id long, text string, q long")
    assert got(X.ranked_search(docs, items, k)) == search(EDGE, ITEMS, k)


def test_blocks_of_items_and_of_documents(spark, monkeypatch):
    monkeypatch.setattr(X, "ITEM_BLOCK", 7)
    monkeypatch.setattr(X, "FLUSH_DOCS", 32)
    monkeypatch.setattr(X, "FLUSH_POSTINGS", 500)
    monkeypatch.setattr(X, "CELLS", 300)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()] + EDGE
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:20] + ITEMS
    out = X.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 10)
    assert got(out) == search(docs, items, 10)


def test_index_of_all_terms(spark):
    docs = spark.createDataFrame(EDGE, "id long, text string")
    index = X.LexicalIndex(docs)
    want = Counter((50 + 50 * len(t) * 8 // sum(len(terms(x)) for _, x in EDGE), d) for d, t in ((d, terms(t)) for d, t in EDGE) if t)
    assert Counter((r["m"], d) for r in index.blocks.collect() for d in r["ids"]) == want
    assert index.docs == 8


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert X.ranked_search(none, items).count() == 0
    assert X.ranked_search(spark.createDataFrame(EDGE, "doc_id long, text string"), items.limit(0)).count() == 0
    assert X.ranked_search(none, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.sql(X.ORACLES["op12_lexical_search"])
    assert sorted(rel.fetchall(), key=str) == got(X.q_lexical_search(spark, SF))
