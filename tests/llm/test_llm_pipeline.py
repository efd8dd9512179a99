import zlib

import brute
import numpy as np
import pytest

import corpus_pipeline
from riskframe.llm import language_ppm as L
from riskframe.llm import packing as P
from riskframe.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert len(corpus_pipeline.STAGES) == 5
    assert [f.__module__.rsplit(".", 1)[1] for _, f in corpus_pipeline.STAGES] == [
        "quality_lines", "language_ppm", "ngram_join", "decontaminate", "packing"]


def test_pipeline_matches_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text", "lang").collect()]
    ok = {r[0] for r in brute.quality([r[:3] for r in rows]) if r[7]}
    rows = [r for r in rows if r[0] in ok]
    kept = docs.filter(docs["doc_id"].isin([r[0] for r in rows]))
    ok = {r["id"] for r in L.identify(kept).collect() if r["has_letter"] and r["score"] >= L.MIN_SCORE}
    rows = [r for r in rows if r[0] in ok]
    ok = {d for d, _, c in brute.jaccard_components([(r[0], r[2]) for r in rows]) if d == c}
    rows = [r for r in rows if r[0] in ok]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    ok = {r[0] for r in brute.contamination([(r[0], r[2]) for r in rows], items) if not r[5]}
    texts = {r[0]: r[2] for r in rows if r[0] in ok}

    pieces = corpus_pipeline.run(spark, SF).toPandas()
    assert set(pieces.doc_id) == set(texts)
    encoder = P.Encoder(P.tokenizer_path())
    for d, g in pieces.sort_values("start").groupby("doc_id"):
        ids = np.append(np.frombuffer(encoder.whole(texts[d]), "<u2"), 2).astype("<u4")
        assert g.length.sum() == len(ids)
        assert all(zlib.crc32(ids[a:a + n].tobytes()) == c for a, n, c in zip(g.start, g.length, g.ids_crc32))


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_rows(spark, empty):
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, hash string, id string"
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (None, text, None, None), (2, None, None, None), (None, None, "en", None), (3, "", "en", "a"),
            (4, "x " * 60000, "en", "a"), (5, text + " more", "de", "a"), (1, "another text under the same id " + text[::-1], "en", "b")]
    docs = spark.createDataFrame([] if empty else [(*r, 1, "k", "h", "i") for r in rows], schema)
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = stage(function(spark, docs, SF), "test")
        assert out.columns == docs.columns, name
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert (last.count() > 0) != empty
