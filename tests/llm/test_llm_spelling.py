"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import brute
import duckdb
import pytest

from riskframe.llm import spelling as S

SF = "/root/testdata/sf0.001"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(counts, ratio=10):
    forms, out = {}, []
    for w, n in counts.items():
        others = [(-m, x) for x, m in counts.items() if near(w, x)]
        best = min(others, default=None)
        forms[w] = best[1] if best and -best[0] >= ratio * n else None
        out.append((w, n, len(others)))

    def root(w):
        return w if forms[w] is None else root(forms[w])
    return brute.order((w, forms[w], root(w), n, k, counts[forms[w]] if forms[w] else None) for w, n, k in out)


def got(df):
    return brute.order(tuple(r) for r in df.collect())


@pytest.mark.parametrize("symbols", [1, 3, 6, 10])
def test_variants_match_brute_force(spark, symbols):
    rng = random.Random(symbols)
    counts = Counter()
    for _ in range(60):
        w = "".join(rng.choice("abcdéÿzλ𝒳") for _ in range(rng.randint(1, 8)))
        for _ in range(6):
            counts[w] = rng.choice([1, 2, 3, 30, 400, 5000])
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice("abé") + w[i:], (w[:i] + w[i + 1:]) or "a", w[:i] + "z" + w[i + 1:]])
    rows = [(w, n, "x") for w, n in counts.items()]
    df = spark.createDataFrame(rows, "word string, n long, reduced string")
    assert got(S.spelling_variants(df, symbols=symbols)) == variants(counts)


def test_chains_ties_and_odd_rows(spark):
    rows = [("walking", 2), ("walkinge", 20), ("walkingen", 200), ("walkingens", 1000), ("walkingens", 1000), ("walkingenz", 2000),
            (None, 3), ("", 9), ("alone", None), ("single", 1)]
    out = {r["word"]: r for r in S.spelling_variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert set(out) == {"walking", "walkinge", "walkingen", "walkingens", "walkingenz", "single"}
    assert out["walkingen"]["form"] == "walkingens" and out["walking"]["root"] == "walkingens"
    assert out["walkingens"]["n"] == 2000 and out["walkingens"]["form"] is None and out["single"]["root"] == "single"
    empty = S.spelling_variants(spark.createDataFrame([], "word string, n long"))
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0


def test_runs_of_odd_documents(spark):
    rows = [(1, "Straßenbahn ABCDEFGH abcdefg_hijklmn", "x"), (1, None, "x"), (2, "", "x"), (None, "Überraschung " * 3, "x"), (3, "kurz", "x"), (4, "y" * 200000, "x")]
    rows += [(i, "electricity Été×÷ÿé", "x") for i in range(100)]
    want = Counter()
    for d, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = brute.lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                want[run] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, run string")
    assert Counter(r["word"] for r in S.noisy_runs(df).collect()) == want


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    rel = con.sql(S.ORACLES["op13_spelling"])
    df = S.q_spelling(spark, SF)
    assert rel.columns == df.columns and got(df) == brute.order(rel.fetchall())
