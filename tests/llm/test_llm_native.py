"""Decontamination, license scan and k-d sharding."""

import zlib
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from riskframe.llm import decontaminate as D
from riskframe.llm import kd_shards as K
from riskframe.llm import license_scan as L

SF = "/root/testdata/sf0.001"


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


ITEMS = [(900, "one two"), (901, "Zed"), (902, None), (903, "  . "), (904, "a b c d e f g h i j k l"), (905, "c d e f g h i j k l m n"),
         (904, "x y z"), (None, "null item words"), (906, "rep rep rep rep rep rep rep rep rep rep rep")]
EDGE = [(-1, None), (-2, ""), (None, "one, TWO three"), (-3, "q a b c d e f g h i j k l m n a b c d e f g h i j zed"), (-4, "zed"), (-4, "zed"),
        (-4, "x y z"), (-5, "rep " * 400), (-6, "éa b c d e f g h i j k"), (-7, "null-item/words")]


@pytest.mark.parametrize("bound", [D.BROADCAST_ROWS, 0])
def test_decontamination_matches_brute_force(spark, bound):
    rows = documents(spark)[:80] + EDGE
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()] + ITEMS
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, hash string")
    out = D.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=bound)
    got = brute.order(tuple(r) for r in out.select(
        "id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ",").cast("binary"), 256), "contaminated").collect())
    assert got == brute.contamination(rows, items)


def test_decontamination_of_empty_tables_and_stage(spark):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.contamination(docs.limit(0), bench).collect() == []
    assert D.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert D.contamination(docs, bench.limit(0)).count() == len(EDGE)


def test_license_base_matches_brute_force(spark):
    rows = documents(spark) + [(-1, None), (None, "CC BY cc by all rights reserved"), (-2, "the General Public  License, cc-BY 4"),
                               (-3, "CC"), (-3, "CC"), (-4, "cc by " * 500)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, hash string")
    out = L.scan(df).collect()
    got = brute.order((r["id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out)
    assert got == brute.phrases(rows, L.BASE)
    for r in out:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))


def test_license_templates_with_changes(spark):
    bsd = dict((a, b) for a, b in L.TEMPLATES if a == "bsd")["bsd"].split()
    cases = {1: " ".join(bsd), 2: "x y " + " ".join(bsd[:9] + ["new"] + bsd[9:]) + " z", 3: " ".join(bsd[:9] + bsd[10:]),
             4: " ".join(bsd[:8]), 5: " ".join(bsd[:12] + ["far"] * 40 + bsd[12:]), 6: "of the " * 50}
    df = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    labels = {r["id"]: r["labels"] for r in L.scan(df).collect()}
    assert labels == {1: "bsd", 2: "bsd", 3: "bsd", 4: "", 5: "", 6: ""}
    assert L.scan(df.limit(0)).collect() == []


def plain_labels(text, gap=L.GAP, cover=L.COVER):
    """{label} of the templates by trying every start and every slack."""
    w, out = brute.MARK_WORD.findall(brute.lower(text)), set()
    for label, template in L.TEMPLATES:
        t = template.split()
        g = len(t) - 1
        slack = gap + g // 10
        held = {i for i in range(len(w) - 1)}
        for d in range(-g, len(w)):
            covered = sum(any(j + d + x in held and w[j + d + x:j + d + x + 2] == t[j:j + 2] for x in range(slack + 1)) for j in range(g))
            if covered >= cover * g:
                out.add(label)
                break
    return out


def test_license_templates_among_repeats_of_their_own_words(spark):
    cases = []
    for label, template in L.TEMPLATES:
        t = template.split()
        for times in (0, 1, 3, 6):
            for tail in (t[-2:], t[:2], t[len(t) // 2:len(t) // 2 + 2]):
                cases.append((label, " ".join([*tail * times, *t, *tail * times])))
                cases.append((label, " ".join([*tail * times, *t[:5], "new", *t[5:], *(tail + ["x"]) * times])))
    cases += [(None, "license at " * 30), (None, "under the license " * 10)]
    rows = [(i, text) for i, (_, text) in enumerate(cases)] + [(1000 + i, t) for i, t in documents(spark)[:60]]
    got = {r["id"]: set(filter(None, r["labels"].split(","))) - {x for x, _ in L.BASE} for r in
           L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert got[i] - {"gpl"} == plain_labels(text) - {x for x, _ in L.BASE}, text
        if i < 1000 and cases[i][0] not in (None, "gpl") and text == " ".join(dict(L.TEMPLATES)[cases[i][0]].split()):
            assert cases[i][0] in got[i]


@pytest.mark.parametrize("shards", [40, 7, 1])
def test_shards_are_balanced_and_numbered(spark, shards):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    rows = K.shard(docs, shards).collect()
    assert len(rows) == len(texts)
    assert all(r["size"] == len(texts[r["id"]]) + 16 and r["crc"] == zlib.crc32(texts[r["id"]]) for r in rows)
    total = Counter()
    slots = {}
    for r in rows:
        total[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(total) == list(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, most = sum(total.values()) / shards, max(r["size"] for r in rows)
    assert all(abs(v - mean) <= most for v in total.values())


def test_shards_of_equal_null_and_no_rows(spark):
    rows = [(1, None, None, None)] + [(None, "a", "s", "en")] * 50 + [(7, "same text", "s", "en")] * 350
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    total = Counter()
    for r in K.shard(df, 8).collect():
        total[r["shard"]] += r["size"]
    assert len(total) == 8 and max(total.values()) - min(total.values()) <= 50
    assert K.shard(df.limit(0)).collect() == []
