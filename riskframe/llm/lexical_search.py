"""Ranked lexical search over a length-stratified index.

A document's length normaliser m is an integer, so documents of equal m form a
stratum, and within a stratum what a term adds to a score depends on its
frequency tf alone: the impact is computed once per (stratum, tf).  The index
holds, for each stratum, the postings of a term by tf, and the largest tf of
each term, from which the best score that any document of the stratum can have
for an item follows.  An item visits the strata in the order of these bounds:
first the best ones until they hold a small share of the documents, then, in
two further rounds, only those whose bound reaches the score of its worst kept
document.

The index is built where the documents are read: a task writes the postings of
its documents in blocks of one stratum each, so no posting is shuffled; only
the strata's largest frequencies and the terms' document counts are.  A bitmap
of fixed size (hashes of the items' terms) keeps other terms out; false hits of
the bitmap are dropped by the join with the items' terms.  Items are searched
in blocks of bounded size, each against the whole index; a task scores the
documents of a block of the index for the items that visit its stratum as one
exact matrix product.

Terms are told apart by 64-bit hashes.

Defined cases: null and term-free texts are not documents (they count in
neither N nor L) and items without terms have no results; documents with a null
id take part and sort after equal scores; each repeated row is a document of
its own; rows of items that share an id (null included) are one item with the
terms of all of them; empty tables give an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytetext as B
from .common import column_or_null, map_batches, stage, table

TOP = 50
WANTED = 1 << 20               # bits of the bitmap of wanted terms
FLUSH_DOCS = 16_384            # documents (below 2^16) and postings a task holds before it writes blocks
FLUSH_POSTINGS = 1 << 20
ITEM_BLOCK = 256               # items of a block, and terms of all its items
TERM_BLOCK = 16_384
VISIT_CELLS = 1 << 24          # (stratum, item) pairs of a block of items
CELLS = 1 << 20                # of the matrix of documents by terms in a task
SHARES = (64, 8)               # a round ends after 1/64 and 1/8 of the documents
TERM = np.zeros(256, bool)
TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
U64 = np.uint64
INDEX = ("m long, docs long, n_max long, ids array<long>, terms array<long>, top array<long>, "
         "group_term array<int>, group_tf array<long>, group_len array<int>, places binary")


def term_counts(column) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, terms of each row, row, term hash, tf) of slices of a text
    column; the last three have an entry for each distinct term of a row."""
    for a, buf, off in B.slices(column):
        low = B.LOWER[buf]
        start, end, first = B.runs(TERM[low], off)
        h, row = B.span_hashes(low, start, end), B.row_of(first)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        cut = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else np.zeros(0, np.int64)
        yield a, np.diff(first), row[cut], h[cut], np.diff(np.append(cut, len(h)))


def _wanted(h: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return marks[(h & U64(WANTED - 1)).astype(np.int64)]


def _item_pass(batches):
    for rb in batches:
        for a, _, row, h, _ in term_counts(rb.column("text")):
            yield pa.RecordBatch.from_arrays([rb.column("item_id").take(pa.array(row + a)), pa.array(B.signed(h))], ["item_id", "term"])


def _count_pass(shared):
    """(term, df) of a batch; the row without a term has its documents and terms."""
    def run(batches):
        for rb in batches:
            docs = words = 0
            found = [np.zeros(0, U64)]
            for _, n, _, h, _ in term_counts(rb.column("text")):
                docs += int((n > 0).sum())
                words += int(n.sum())
                found.append(h[_wanted(h, shared.value)])
            h, df = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *B.signed(h).tolist()], pa.int64()), pa.array([docs, *df.tolist()], pa.int64()),
                 pa.array([words] + [0] * len(h), pa.int64())], ["term", "df", "words"])
    return run


def normaliser(n: int, docs: int, words: int) -> int:
    return 50 + (50 * n * docs) // words


def _index_pass(shared, docs: int, words: int):
    def flush(ids, n, row, h, tf):
        m = np.array([normaliser(int(x), docs, words) for x in n], np.int64)
        order = np.lexsort((row, -tf, h, m[row]))
        row, h, tf = row[order], h[order], tf[order]
        at = np.argsort(m, kind="stable")
        for a, b, c, d in _equal_runs(m[at], m[row]):
            mine, r, hh, t = at[a:b], row[c:d], h[c:d], tf[c:d]
            terms, group_of = np.unique(hh, return_inverse=True)
            cut = np.flatnonzero(np.concatenate([[True], (hh[1:] != hh[:-1]) | (t[1:] != t[:-1])]))
            first = np.flatnonzero(np.concatenate([[True], hh[1:] != hh[:-1]]))
            yield {"m": int(m[mine[0]]), "docs": len(mine), "n_max": int(n[mine].max()), "ids": [ids[i] for i in mine],
                   "terms": B.signed(terms), "top": t[first], "group_term": group_of[cut].astype(np.int32), "group_tf": t[cut],
                   "group_len": np.diff(np.append(cut, d - c)).astype(np.int32), "places": np.searchsorted(mine, r).astype("<u2").tobytes()}

    def run(batches):
        held, ids, size, count = [], [], [], 0
        for rb in batches:
            for a, n, row, h, tf in term_counts(rb.column("text")):
                names = rb.column("id").slice(a, len(n)).to_pylist()
                for lo in range(0, len(n), FLUSH_DOCS):            # a slice may hold more (empty) texts than a block
                    part = slice(*np.searchsorted(row, [lo, lo + FLUSH_DOCS]))
                    keep = _wanted(h[part], shared.value)
                    if len(ids) + FLUSH_DOCS > 1 << 16 or count > FLUSH_POSTINGS:
                        yield from _block_rows(flush(ids, np.concatenate(size), *map(np.concatenate, zip(*held))))
                        held, ids, size, count = [], [], [], 0
                    full = np.flatnonzero(n[lo:lo + FLUSH_DOCS])   # term-free rows are not documents
                    place = np.cumsum(n[lo:lo + FLUSH_DOCS] > 0) - 1 + len(ids)
                    held.append((place[row[part][keep] - lo], h[part][keep], tf[part][keep].astype(np.int64)))
                    ids += [names[lo + i] for i in full]
                    size.append(n[lo:lo + FLUSH_DOCS][full])
                    count += int(keep.sum())
        if ids:
            yield from _block_rows(flush(ids, np.concatenate(size), *map(np.concatenate, zip(*held))))
    return run


def _equal_runs(of_docs: np.ndarray, of_postings: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of documents and of postings with the same m; both are sorted."""
    for m in np.unique(of_postings):
        yield (*np.searchsorted(of_docs, [m, m + 1]), *np.searchsorted(of_postings, [m, m + 1]))


def _block_rows(blocks) -> Iterator[pa.RecordBatch]:
    kinds = {"m": pa.int64(), "docs": pa.int64(), "n_max": pa.int64(), "ids": pa.list_(pa.int64()), "terms": pa.list_(pa.int64()),
             "top": pa.list_(pa.int64()), "group_term": pa.list_(pa.int32()), "group_tf": pa.list_(pa.int64()),
             "group_len": pa.list_(pa.int32()), "places": pa.binary()}
    for b in blocks:
        yield pa.RecordBatch.from_arrays([pa.array([b[c]], k) for c, k in kinds.items()], list(kinds))


def impact(tf, m):
    """What one unit of a term's weight adds at tf in stratum m."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _score_pass(shared, k: int):
    """The k best documents of a task for each item that visits their strata."""
    def run(batches):
        terms, weight, visits, least = shared.value
        exact = weight.sum(axis=0).max(initial=0) * 1e6 < 2 ** 53
        weight = weight if exact else weight.astype(np.int64)
        best = {}                                          # item -> lists of scores and ids

        def cut(q):
            score, ids, null = (np.concatenate(x) for x in zip(*best[q]))
            order = np.lexsort((ids, null, -score))[:k]
            best[q] = [(score[order], ids[order], null[order])]

        for rb in batches:
            for i, m in enumerate(rb.column("m").to_pylist()):
                items = visits.get(m)
                if items is None:
                    continue
                b = {c: rb.column(c)[i].values for c in ("ids", "terms", "group_term", "group_tf", "group_len")}
                mine = b["terms"].to_numpy()
                at = np.searchsorted(terms, mine)
                at[at == len(terms)] = 0
                known = terms[at] == mine
                group, length = b["group_term"].to_numpy(), b["group_len"].to_numpy()
                add = impact(b["group_tf"].to_numpy(), m)                       # once per (stratum, tf)
                term = np.repeat(at[group], length)
                ok = np.repeat(known[group], length)
                place = np.frombuffer(rb.column("places")[i].as_buffer(), "<u2").astype(np.int64)[ok]
                term, add = term[ok], np.repeat(add, length)[ok]
                ids, null = b["ids"].fill_null(0).to_numpy(), b["ids"].is_null().to_numpy(zero_copy_only=False)
                used, term = np.unique(term, return_inverse=True)
                w = weight[np.ix_(used, items)]
                order = np.argsort(place, kind="stable")
                place, term, add = place[order], term[order], add[order]
                step = max(1, CELLS // max(1, len(used)))
                for lo in range(0, len(ids), step):
                    part = slice(*np.searchsorted(place, [lo, lo + step]))
                    grid = np.zeros((min(step, len(ids) - lo), len(used)), w.dtype)
                    grid[place[part] - lo, term[part]] = add[part]
                    score = (grid @ w).astype(np.int64)
                    doc, col = np.nonzero(score >= np.maximum(least[items], 1)[None, :])
                    value = score[doc, col]
                    by = np.argsort(col, kind="stable")
                    bounds = np.searchsorted(col[by], np.arange(len(items) + 1))
                    for c in np.flatnonzero(np.diff(bounds)):
                        sel = by[bounds[c]:bounds[c + 1]]
                        held = best.setdefault(int(items[c]), [])
                        held.append((value[sel], ids[lo + doc[sel]], null[lo + doc[sel]]))
                        if sum(len(x[0]) for x in held) > 8 * k + 512:
                            cut(int(items[c]))
        for q in best:
            cut(q)
            score, ids, null = best[q][0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), q, np.int32)), pa.array(ids, pa.int64(), mask=null), pa.array(score)],
                                             ["q", "doc_id", "score"])
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item; first within parts of its rows."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    some = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("q", "part").orderBy(*order)))
    some = some.filter(F.col("rank") <= k).select("q", "doc_id", "score")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= k)


class LexicalIndex:
    """Stratified postings of the terms of ``terms`` (a table of hashes, or all
    terms where it is None) in ``docs(id, text)``."""

    def __init__(self, docs: DataFrame, terms: DataFrame | None = None) -> None:
        self.spark = docs.sparkSession
        marks = np.ones(WANTED, bool)
        if terms is not None:
            word = F.col("term").bitwiseAND(WANTED - 1)
            bits = (terms.select(word.alias("b")).groupBy(F.expr("b div 32").alias("word"))
                    .agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 32 as int))")).alias("bits")).toArrow())   # WANTED / 32 rows at most
            marks = np.zeros(WANTED, bool)
            at, bits = bits.column("word").to_numpy(), bits.column("bits").to_numpy()
            for i in range(32):
                marks[at[(bits >> i) & 1 == 1] * 32 + i] = True
        shared = self.spark.sparkContext.broadcast(marks)
        counts = map_batches(docs.select("text"), _count_pass(shared), "term long, df long, words long")
        counts = stage(counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words")), "terms")
        total = counts.filter("term is null").first()
        self.docs, self.words = (int(total["df"]), int(total["words"])) if total else (0, 0)
        self.df = counts.filter("term is not null").select("term", "df")
        self.blocks = stage(map_batches(docs.select("id", "text"), _index_pass(shared, self.docs, self.words), INDEX), "index")
        top = self.blocks.select("m", F.explode_outer(F.arrays_zip("terms", "top")).alias("x"))
        self.top = stage(top.select("m", "x.terms", "x.top").groupBy("m", F.col("terms").alias("term")).agg(F.max("top").alias("top")), "top")
        self.strata = stage(self.blocks.groupBy("m").agg(F.sum("docs").alias("docs"), F.max("n_max").alias("n_max")), "strata")

    def weights(self, item_terms: DataFrame) -> DataFrame:
        """``item_terms(item_id, term)`` with the terms' weights."""
        w = F.floor(1000 * F.log((2.0 * self.docs + 2) / (2 * F.col("df") + 1))).cast("long")
        return item_terms.join(self.df.withColumn("w", w).select("term", "w"), "term")

    def search(self, item_terms: DataFrame, k: int = TOP) -> DataFrame:
        """(item_id, rank, doc_id, score): the k best documents of each item."""
        spark = self.spark
        weighted = stage(self.weights(item_terms), "weights")
        items, terms = weighted.select(F.count_distinct(F.struct("item_id")), F.count("*")).first()
        strata = self.strata.count()
        blocks = max(1, -(-items // ITEM_BLOCK), -(-terms // TERM_BLOCK), -(-items * strata // VISIT_CELLS))
        weighted = weighted.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
        out = None
        for block in range(blocks):
            found = self._search_block(weighted.filter(F.col("block") == block), k)
            out = found if out is None else out.unionByName(found)
        return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    def _search_block(self, weighted: DataFrame, k: int) -> DataFrame:
        spark = self.spark
        got = weighted.select("item_id", "term", "w").toArrow().to_pydict()      # about TERM_BLOCK rows
        names = list(dict.fromkeys(got["item_id"]))
        q_of = {x: i for i, x in enumerate(names)}
        q = np.array([q_of[x] for x in got["item_id"]], np.int64)
        terms, at = np.unique(np.array(got["term"], np.int64), return_inverse=True)
        weight = np.zeros((len(terms), len(names)))
        weight[at, q] = got["w"]
        rows = spark.createDataFrame(list(zip(q.tolist(), got["term"], got["w"])), "q int, term long, w long")
        # an item's best score in a stratum: its best impacts, no more of them than a document there has terms
        added = self.top.join(rows, "term").withColumn("add", F.expr("w * ((1000000000 * top) div (1000 * top + 20 * m))"))
        bounds = (added.groupBy("q", "m").agg(F.sort_array(F.collect_list("add"), asc=False).alias("adds")).join(self.strata, "m")
                  .withColumn("bound", F.expr("aggregate(slice(adds, 1, cast(least(n_max, 1000000000) as int)), 0L, (a, x) -> a + x)"))
                  .filter("bound > 0"))
        before = F.sum("docs").over(Window.partitionBy("q").orderBy(F.col("bound").desc(), "m")) - F.col("docs")
        bounds = stage(bounds.withColumn("before", before).select("q", "m", "bound", "before"), "bounds")
        least, top, low = np.zeros(len(names), np.int64), None, 0
        for high in (*(self.docs // s + 1 for s in SHARES), self.docs + 1):
            floor = spark.createDataFrame([(i, int(x)) for i, x in enumerate(least)], "q int, least long")   # ITEM_BLOCK rows or so
            visits = (bounds.filter((F.col("before") >= low) & (F.col("before") < high)).join(F.broadcast(floor), "q")
                      .filter("bound >= least").groupBy("m").agg(F.collect_list("q").alias("items")).toArrow().to_pydict())   # VISIT_CELLS at most
            low = high
            if not visits["m"]:
                continue
            who = {m: np.array(sorted(x)) for m, x in zip(visits["m"], visits["items"])}
            shared = spark.sparkContext.broadcast((terms, weight, who, least))
            wanted = spark.createDataFrame([(int(m),) for m in who], "m long")    # one row per stratum
            found = map_batches(self.blocks.join(F.broadcast(wanted), "m", "left_semi"), _score_pass(shared, k), "q int, doc_id long, score long")
            found = found if top is None else found.unionByName(top.select("q", "doc_id", "score"))
            top = stage(_ranked(found, k), "best")
            for r in top.filter(F.col("rank") == k).select("q", "score").collect():
                least[r["q"]] = r["score"]
        name = spark.createDataFrame(list(enumerate(names)), "q int, item_id long")
        if top is None:
            top = spark.createDataFrame([], "q int, doc_id long, score long, rank int")
        return top.join(F.broadcast(name), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", item_col: str = "item_id",
                  text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of ``items`` over ``docs``."""
    items = items.select(column_or_null(items, item_col, "long").alias("item_id"), column_or_null(items, text_col, "string").alias("text"))
    docs = docs.select(column_or_null(docs, id_col, "long").alias("id"), column_or_null(docs, text_col, "string").alias("text"))
    item_terms = stage(map_batches(items, _item_pass, "item_id long, term long").distinct(), "items")
    return LexicalIndex(docs, item_terms.select("term")).search(item_terms, k)


def q_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ORACLE = """
with words as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
  from documents),
docs as (select r, doc_id, w, len(w)::bigint as n from words where len(w) > 0),
corpus as (select count(*)::bigint as big_n, sum(n)::bigint as big_l from docs),
tfs as (select r, term, count(*)::bigint as tf from (select r, unnest(w) as term from docs) group by all),
item_terms as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from benchmark),
weights as (
  select term, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::bigint as w from tfs, corpus group by term, big_n),
scored as (
  select i.item_id, d.r, d.doc_id, sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * (50 + (50 * d.n * big_n) // big_l))))::bigint as score
  from item_terms i join weights w using (term) join tfs t using (term) join docs d using (r), corpus
  group by all),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""

QUERIES = {"op12_lexical_search": q_lexical_search}
ORACLES = {"op12_lexical_search": _ORACLE}
