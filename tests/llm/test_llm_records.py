"""WARC conversion, chat formatting, HTML extraction and packing."""

import hashlib
import html
import io
import random
from collections import Counter
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import chat_format as C
from riskframe.llm import html_wrapper as H
from riskframe.llm import packing as P
from riskframe.llm.common import stage
from riskframe.llm import warc as W

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ WARC
def test_warc_matches_sql_on_repeated_payloads(spark, tmp_path):
    big = "x\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(1, "a b", None), (2, None, big), (3, "u", big), (5, "w", "é" * 600), (6, "w", "é" * 600), (4, "w", "é" * 600), (7, "", ""),
            (8, "x\n", "s"), (9, "x", "s"), (10, "http://x/é", "\x00  text \n\n")]
    pages = spark.createDataFrame([(*r, "v") for r in rows], "page_id long, url string, html string, value string").repartition(3)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = sorted(con.sql(W.ORACLES["op1_warc"]).fetchall())
    got = sorted(tuple(r) for r in W.q_warc(spark, str(tmp_path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    assert got == want and ("revisit" in {r[3] for r in got})


def test_warc_null_ids_repeated_rows_and_empty_table(spark):
    big = "y" * 1200
    pages = spark.createDataFrame([(3, "u", big), (3, "u", big), (None, "v", big), (None, None, "z" * 1000), (None, None, "z" * 1000)],
                                  "page_id long, url string, html string")
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in W.convert(pages).collect()), key=str)
    assert got == sorted([(3, "response", None), (3, "response", None), (None, "revisit", 3), (None, "response", None),
                          (None, "response", None)], key=str)
    assert W.convert(pages.limit(0)).collect() == []


@pytest.mark.parametrize("bound", [W.BROADCAST_ROWS, 0])
def test_warc_payload_of_a_third_of_all_pages(spark, tmp_path, bound):
    rows = [(i, f"http://h{i}/", "hot " * 400 if i % 3 == 0 else f"page {i} " * 200) for i in range(600)] + [(None, "n", "hot " * 400)]
    W.write_arc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), f"{tmp_path}/arc")
    records = W.to_warc(spark, f"{tmp_path}/arc", bound)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "payload" in plan and (bound or "LeftAnti" in plan)
    W.write_warc(records, f"{tmp_path}/warc")
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in W.read_warc(spark, f"{tmp_path}/warc").collect()), key=str)
    hot = {i for i, _, h in rows if h.startswith("hot")} - {597}
    assert got == sorted(((i, "revisit", 597) if i in hot else (i, "response", None) for i, _, _ in rows), key=str)


def test_arc_versions_and_broken_lengths():
    for version in (1, 2):
        block = f"{version} 0 org\n{W.ARC_FIELDS[version]}\n"
        text = f"{W.arc_header(version, 'filedesc://a', len(block), 'text/plain')}\n{block}\n{W.arc_header(version, 'http://a/', 3)}\nab\n\n"
        assert [(h["url"], b) for h, b in W.parse_arc(io.BytesIO(text.encode()))] == [("http://a/", b"ab\n")]
        with pytest.raises(ValueError):
            list(W.parse_arc(io.BytesIO(text.encode()[:-3])))


# ------------------------------------------------------------------ chat
def test_chat_round_trip_of_hostile_texts():
    rnd = random.Random(1)
    parts = ["\\", "### ", "</turn>", "\n", ":", "a", " ", "###", "Assistant:", "</turn>\n### user:\n", "%0A", "é", "\n</turn>\n", "\\\\", "</tu", "rn>"]
    for _ in range(4000):
        turns = [("".join(rnd.choice(parts) for _ in range(rnd.randint(0, 3))) if rnd.random() < .2 else rnd.choice(["user", "assistant", ""]),
                  "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 7)))) for _ in range(rnd.randint(1, 4))]
        pieces = [C.format_turn(r, c) for r, c in turns]
        assert C.parse("".join(p for p, _, _ in pieces)) == turns
        assert [C.unescape(p[a:b]) for p, a, b in pieces] == [c for _, c in turns]


def test_chat_digests_and_edge_rows(spark):
    x = C.EXTRA_TEXT
    rows = [(1, 0, "user", None), (1, 1, "assistant", "long " * 9000), (1, 1, "assistant", "b"), (2, None, None, ""), (None, 3, "assistant", "é"),
            (-7, 1, "assistant", x), (-7, 0, "user", x), (3, 0, "user", "same"), (3, 0, "user", "same")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, turns int")
    got = {r["conv_id"]: r for r in C.read_back(C.format_chats(df)).collect()}
    groups = {}
    for c, t, r, s in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        groups.setdefault(c, []).append((r or "", s or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        loss = "".join(s for r, s in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{s}\n" for r, s in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert C.format_chats(df.limit(0)).collect() == []


def test_one_conversation_of_a_third_of_all_rows(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"turn {i} </turn> ### ") for i in range(3000)]
    rows += [(None, i, "user", "x" * (i % 5)) for i in range(3000)] + [(100 + i, 0, "assistant", f"own {i}") for i in range(3000)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    formatted = stage(C.format_chats(df), "chats")
    one, other = (sorted(map(str, x.collect())) for x in (C.read_back(formatted), C.read_back(C.format_chats(df), ordered=True)))
    assert one == other and len(one) == 3002
    hot = C.read_back(formatted).filter("conv_id = 7").first()
    want = "".join(f"{'assistant' if i % 2 else 'user'}\nturn {i} </turn> ### \n" for i in range(3000))
    assert hot["n_turns"] == 3000 and hot["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    pieces = formatted.filter("conv_id = 7").orderBy("n").collect()
    text = "".join(r["piece"] for r in pieces)
    assert hot["formatted_chars"] == len(text) and all(text[r["start"]:].startswith(r["piece"]) for r in pieces[::100])
    assert [C.unescape(text[r["loss_start"]:r["loss_stop"]]) for r in pieces if r["loss_start"] is not None] == [f"turn {i} </turn> ### " for i in range(1, 3000, 2)]


# ------------------------------------------------------------------ HTML
def test_article_text_of_all_pages(spark):
    got = {r["page_id"]: r for r in H.q_html_wrapper(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        x = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", r["html"], re.S)[1]))
        assert got[r["page_id"]]["text"] == " ".join(html.unescape(x).split())
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_template_without_a_declared_article(spark):
    rows = [(i, "http://X.com/a", f'<html><body><div class="top">Site name</div><div id="c"><h2>Title {i}</h2><div>Body &amp; text {i}<p>more<br>x '
             f'<i>y</i>z<p>end {i}</div></div><div>Same line everywhere</div><div class="user-comments">c{i}</div><script>var a="<p>";</script></body>')
            for i in range(8)]
    rows += [(100, None, None), (101, "bad", ""), (102, "http://y.z/", "<p>a<p>b &lt; c"), (None, "http://y.z/", "plain < text & more"),
             (103, "http://q/", "<article><header><h1>T</h1></header><nav>n</nav><p>p1</p><aside>s</aside><section class=comments>c</section></article>"
                                "<footer>f"), (104, "http://q/", "<div hidden>h</div><main>m<form>f</form></main>tail"), (104, "http://q/", "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, skeleton int")
    got = {}
    for r in H.extract(df).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    assert all(got[i] == [f"Title {i} Body & text {i} more x yz end {i}"] or got[i] == [f"Title {i} Body & text {i} x z end {i}"]
               or got[i][0].startswith(f"Title {i} Body & text {i}") and "Same line" not in got[i][0] and "Site" not in got[i][0] for i in range(8))
    assert [got[i] for i in (100, 101, 102, None, 103)] == [[""], [""], ["a b < c"], ["plain < text & more"], ["T p1"]]
    assert sorted(got[104]) == ["m", "x"]
    assert H.extract(df.limit(0)).collect() == []


def test_tree_matching_against_plain_recursion():
    def plain(a, b, i, j):
        if a.label[i] != b.label[j]:
            return 0
        m = [[0] * (len(b.kids[j]) + 1) for _ in range(len(a.kids[i]) + 1)]
        for x, p in enumerate(a.kids[i], 1):
            for y, q in enumerate(b.kids[j], 1):
                m[x][y] = max(m[x - 1][y], m[x][y - 1], m[x - 1][y - 1] + plain(a, b, p, q))
        return m[-1][-1] + 1
    rnd = random.Random(2)

    def page(depth=0):
        return "".join(f"<{t}>{page(depth + 1) if depth < 3 else 'x'}</{t}>" for t in rnd.choices(["div", "ul", "section"], k=rnd.randint(0, 4)))
    for _ in range(60):
        a, b = H.Skeleton.of(H.tree(page())), H.Skeleton.of(H.tree(page()))
        pairs = H.align(a, b)
        assert len(pairs) == plain(a, b, 0, 0) and all(a.label[i] == b.label[j] for i, j in pairs)


def test_constant_boilerplate_without_telling_class_in_a_declared_article(spark):
    rows = [(i, "http://x.com/a", f'<body><article><h1>Title {i}</h1><div class="q7">Best offers of the shop</div><p>First {i} <b>bold</b> text.</p>'
             f'<p>All rights <a href="/r{i}">reserved</a> here.</p><p>Second {i}.</p><div class="zz">Reader mail goes to us</div><ul><li>own {i}<li>print'
             f'</ul><p>Third {i}.</p></article><div>Outside {i}</div></body>') for i in range(8)]
    rows += [(20 + i, "http://copies/", f"<title>{i}</title><article><p>One text on every page.</p></article>") for i in range(8)]
    rows += [(40 + i, "http://few/", f"<article><p>Own {i}.</p><p>Same.</p></article>") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(8)] == [f"Title {i} First {i} bold text. Second {i}. own {i} Third {i}." for i in range(8)]
    assert all(got[20 + i] == "One text on every page." for i in range(8))
    assert all(got[40 + i] == f"Own {i}. Same." for i in range(3))


def test_pages_nested_thousands_of_levels_deep(spark):
    n = 3000
    shapes = ["<div>" * n + "deep {i}" + "</div>" * n, "<font>" * n + "deep {i}", "<span>a" * n + " deep {i}", "<main>" + "<div>" * n + "deep {i}"]
    rows = [(10 * k + i, f"http://h{k}/", f"<body>{shape.format(i=i)}") for k, shape in enumerate(shapes) for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in H.extract(df).collect()}
    assert len(got) == len(rows) and all(got[10 * k + i].endswith(f"deep {i}") for k in range(len(shapes)) for i in range(6))


def plain_matching(a, b, i=0, j=0):
    """Size of the largest mapping, by the textbook recursion."""
    if a.label[i] != b.label[j]:
        return 0
    ka, kb = a.kids[i], b.kids[j]
    best = [[0] * (len(kb) + 1) for _ in range(len(ka) + 1)]
    for x, p in enumerate(ka, 1):
        for y, q in enumerate(kb, 1):
            best[x][y] = max(best[x - 1][y], best[x][y - 1], best[x - 1][y - 1] + plain_matching(a, b, p, q))
    return best[-1][-1] + 1


@pytest.mark.parametrize("cells", [H.TRACE_CELLS, 1])
def test_alignment_is_simple_tree_matching(monkeypatch, cells):
    monkeypatch.setattr(H, "TRACE_CELLS", cells)
    rnd = random.Random(8)

    def page(depth=0):
        return "t" if depth > 3 else "".join(f"<{t}>{page(depth + 1)}</{t}>" for t in (rnd.choice(["div", "p", "ul", "span"]) for _ in range(rnd.randint(0, 4))))
    for _ in range(150):
        a, b = H.Skeleton.of(H.tree(page())), H.Skeleton.of(H.tree(page()))
        pairs = H.align(a, b)
        assert len(pairs) == plain_matching(a, b) and len(dict(pairs)) == len({j for _, j in pairs}) == len(pairs)
        assert all(a.label[i] == b.label[j] for i, j in pairs)
        up = {k: i for i, kids in enumerate(a.kids) for k in kids}, {k: i for i, kids in enumerate(b.kids) for k in kids}
        assert all((up[0][i], up[1][j]) in pairs for i, j in pairs if i)
        for i, j in pairs:                                 # siblings keep their order
            order = [q for p, q in sorted(pairs) if up[0].get(p) == i]
            assert order == sorted(order)


def test_alignment_of_many_siblings_that_alternate():
    a = H.Skeleton.of(H.tree("<div>" + "<p>a</p><ul><li>b</li></ul>" * 1500 + "</div>"))
    b = H.Skeleton.of(H.tree("<div>" + "<p>a</p><ul><li>b</li></ul><h2>x</h2>" * 1000 + "</div>"))
    assert len(H.align(a, b)) == 2 + 1000 * 3


# ------------------------------------------------------------------ packing
@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.tokenizer_path())


def test_encoder_equals_the_tokenizer(tokenizer):
    encoder, rnd = P.Encoder(P.tokenizer_path()), random.Random(3)
    letters = "abzAZéßñÉüſİıʼnŉǅǆªºµ'’.,!?<|>-_#$%&0189 ÷× \n\tΣσς日́ \x1c"
    words = ["it's", "we'LL", "'s", "'S", "<|endoftext|>", "<|ENDOFTEXT|>", "don't", "a'", "'a"]
    for _ in range(8000):
        text = "".join(rnd.choice(letters) if rnd.random() < .9 else rnd.choice(words) for _ in range(rnd.randint(0, 14)))
        assert np.frombuffer(encoder.whole(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity,quantum,weights", [(4096, 512, None), (64, 100, None), (256, 32, {"src0": 5e5, "src1": 1.0})])
def test_pieces_tile_documents_and_sequences(spark, tokenizer, capacity, quantum, weights):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "text")
    extra = [(-1, None, None), (-2, "new", ""), (-3, None, "<|endoftext|> hi"), (-4, "x", "word " * 20000)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("n", F.lit(1))
    pieces = P.digests(P.pack(docs, capacity, quantum, weights)).toPandas()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(pieces.doc_id) == set(texts)
    for d, g in pieces.sort_values("start").groupby("doc_id"):
        ids = np.array(tokenizer.encode(texts[d] or "", add_special_tokens=False).ids + [2], "<u4")
        assert g.start.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() == len(ids) and set(g.doc_tokens) == {len(ids)}
        assert all(zlib.crc32(ids[a:a + n].tobytes()) == c for a, n, c in zip(g.start, g.length, g.ids_crc32))
    sizes = []
    for s, g in pieces.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]]
        sizes.append(g.length.sum())
    assert set(sizes[:-1]) <= {capacity} and 0 < sizes[-1] <= capacity
    if weights is None:                       # each source keeps within a quantum of its share
        source = {r["doc_id"]: str(r["source"]) for r in docs.collect()}
        sums = pieces.assign(source=pieces.doc_id.map(source)).groupby(["sequence_id", "source"]).length.sum().unstack(fill_value=0)
        target = np.outer(np.cumsum(sizes) / sum(sizes), sums.sum())
        assert np.abs(sums.cumsum().to_numpy() - target).max() <= quantum + capacity


def round_robin(docs, weights, capacity, quantum):
    """Plain deficit round-robin over (source, length) documents: the stream as
    (document, offset in it) tokens."""
    queues = {}
    for i, (s, n) in enumerate(docs):
        queues.setdefault(s, []).extend((i, k) for k in range(n))
    order = sorted(queues, key=lambda s: (s is not None, s or ""))
    weight = {s: weights.get(s, len(queues[s])) for s in order}
    total, stream, windows = sum(weight.values()), [], []
    credit, sent = dict.fromkeys(order, 0.0), dict.fromkeys(order, 0)
    while len(stream) < sum(map(len, queues.values())):
        held = Counter()
        for s in order:
            credit[s] += capacity * weight[s] / total
            while credit[s] >= quantum - 1e-9:
                credit[s] -= quantum
                part = queues[s][sent[s]:sent[s] + quantum]
                stream += part
                sent[s] += len(part)
                held[s] += len(part)
        windows.append((held, {s for s in order if sent[s] >= len(queues[s])}))
    return stream, windows, {s: weight[s] / total for s in order}


@pytest.mark.parametrize("sources, max_queues", [(3, 100), (3, 1), (200, 1000), (200, 10)])
def test_packing_is_a_plain_deficit_round_robin(spark, sources, max_queues):
    rnd = random.Random(sources)
    names = [None, *(f"s{i:03d}" for i in range(1, sources))]
    docs = [(rnd.choice(names), rnd.randint(1, 60)) for _ in range(sources * 8)]
    weights = {s: rnd.choice([1.0, 2.0, 5.0]) for s in names[1:]}            # unlike the corpus shares
    weights[None] = 3.0
    df = spark.createDataFrame([(i, s, "a " * (n - 1)) for i, (s, n) in enumerate(docs)], "doc_id long, source string, text string").coalesce(1)
    used = {s for s, _ in docs}
    weights = {s: w for s, w in weights.items() if s in used}
    capacity, quantum = 256, 16
    pieces = P.pack(df, capacity, quantum, weights, max_queues=max_queues).collect()
    got = {}
    for r in pieces:
        for k in range(r["length"]):
            got[r["sequence_id"] * capacity + r["offset"] + k] = (r["id"], r["start"] + k)
    stream, windows, share = round_robin(docs, weights, capacity, quantum)
    assert [got[i] for i in range(len(stream))] == stream
    total = Counter()
    for w, (held, dry) in enumerate(windows):              # each prefix within a quantum of the target until a queue is dry
        total.update(held)
        if dry:
            break
        assert all(abs(total[s] - (w + 1) * capacity * share[s]) <= quantum for s in share)


def test_packing_more_sources_than_a_broadcast_and_no_rows(spark):
    docs = spark.createDataFrame([(i, f"s{i}", "a b " * i) for i in range(40)], "doc_id long, source string, text string")
    one, other = (sorted(map(tuple, P.pack(docs, 64, 16, max_queues=n).collect())) for n in (7, 100))
    assert one == other and sum(r[2] for r in one) == sum(2 * i + 1 for i in range(40))
    assert P.pack(docs.limit(0)).collect() == []
    for bad in ({"s1": 0.0}, {"s1": -1.0}, {"s1": float("nan")}, {"nowhere": 1.0}):
        with pytest.raises(ValueError):
            P.pack(docs, proportions=bad)
