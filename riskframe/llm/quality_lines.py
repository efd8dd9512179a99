"""Quality rules with cross-document line frequency.

One pass over the whole texts gives the base figures and, for each document,
the hashes of its normalised lines (lower case, digits as 0, white space
between words ignored).  A line's frequency on a host is the number of distinct
documents of that host that hold it; exact copies of a text are one document.
Lines above their limit are boilerplate; a document that loses more than
``max_lost`` percent of its words with them is depleted and rejected.

The limit is max(MIN_DOCS, RATE * D^POWER * sqrt(LINE_WORDS / w)) documents for a
line of w words (the fewest that it takes in a document) on a host of D distinct
documents: it rises more slowly than the host, and a long line, which chance does
not repeat, needs fewer documents.  Its figures come from the measured tails: the
repeated lines of the test tables stand in 1 to 5 % of a host's documents, the
one boilerplate line in 10 to 13 % at every size; the limit for eight words is
7 % of 50 documents, 4.6 % of 500, 2.6 % of 8 400 and 1 % of a million.  Counts are
partial aggregates on (host, line), so a host or a line that holds a third of all
rows costs one row per task.

Defined cases: null text has no words and fails the base rule; a null host is a
host of its own; repeated rows each get their row; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytetext as B
from .common import apart, column_or_null, discard, map_batches, row_key, safe_name, stage, table

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_DOCS = 3           # a line in no more documents of a host is never boilerplate
RATE, POWER, LINE_WORDS = 0.16, 0.8, 8
MAX_LOST = 50          # percent of a document's words
BROADCAST_LINES = 100_000      # (host, line) pairs; more are joined

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
FOLD = B.LOWER.copy()
FOLD[48:58] = 48
U64 = np.uint64


def _repeats(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which items occur twice or more within their row."""
    with np.errstate(over="ignore"):
        key = B.mix(hashes ^ B.mix(row.astype(U64) + U64(11)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice


def _lines(buf: np.ndarray, off: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, end, first word, word behind) of the lines with a word."""
    line_start, line_end, line_first = B.runs(buf != 10, off)
    line_word = np.searchsorted(start, line_start)
    line_stop = np.searchsorted(start, line_end)
    full = line_stop > line_word
    return (B.row_of(line_first)[full], *(x[full] for x in (line_start, line_end, line_word, line_stop)))


def _line_keys(buf: np.ndarray, start: np.ndarray, end: np.ndarray, word: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of the normalised lines."""
    return B.signed(B.Spans(B.Spans(FOLD[buf]).hashes(start, end)).hashes(word, stop))


def _figures(buf: np.ndarray, off: np.ndarray) -> dict:
    rows = len(off) - 1
    start, end, first = B.runs(~B.SPACE[buf], off)
    words = np.diff(first)
    raw = B.Spans(buf)
    out = {"n_words": words,
           "word_chars": B.per_row((~B.SPACE[buf] & ((buf & 0xC0) != 0x80)).astype(np.int64), off),
           "n_symbols": B.per_row(SYMBOL[buf].astype(np.int64), off),
           "fp": B.signed(raw.hashes(off[:-1], off[1:]))}

    # words inside repeated 5-word windows
    h, at = B.windows(raw.hashes(start, end), first, 5)
    row = B.row_of(at)
    twice = np.flatnonzero(_repeats(h, row))
    word = first[row[twice]] + twice - at[row[twice]]
    edge = np.zeros(len(start) + 6, np.int64)
    np.add.at(edge, word, 1)
    np.add.at(edge, word + 5, -1)
    out["n_repeat_words"] = B.per_row((np.cumsum(edge)[:len(start)] > 0).astype(np.int64), first)

    # lines with a word
    line_row, line_start, line_end, line_word, line_stop = _lines(buf, off, start, end)
    exact = raw.hashes(line_start, line_end)
    order = np.lexsort((exact, line_row))
    again = (exact[order][1:] == exact[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    out["n_dup_lines"] = np.bincount(line_row[order][1:][again], minlength=rows)

    key = _line_keys(buf, start, end, line_word, line_stop)
    order = np.lexsort((key, line_row))
    key, line_row, size = key[order], line_row[order], (line_stop - line_word)[order]
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (line_row[1:] != line_row[:-1])])) \
        if len(key) else np.zeros(0, np.int64)
    out["line"] = key[new]
    out["line_words"] = np.add.reduceat(size, new) if len(new) else size
    out["lines"] = np.bincount(line_row[new], minlength=rows)
    return out


LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "fp")


def _pass(batches):
    for rb in batches:
        parts = [_figures(buf, off) for _, buf, off in B.slices(rb.column("text"))]
        if not parts:
            continue
        whole = {c: np.concatenate([p[c] for p in parts]).astype(np.int64) for c in (*LONGS, "line", "line_words", "lines")}
        ends = pa.array(np.concatenate([[0], np.cumsum(whole["lines"])]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [rb.column("id"), rb.column("key"), rb.column("source"), *(pa.array(whole[c]) for c in LONGS),
             pa.ListArray.from_arrays(ends, pa.array(whole["line"])),
             pa.ListArray.from_arrays(ends, pa.array(whole["line_words"]))],
            ["id", "key", "source", *LONGS, "line", "line_words"])


SCHEMA = ("id long, key long, source string, " + ", ".join(f"{c} long" for c in LONGS)
          + ", line array<long>, line_words array<long>")


def _measured(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(figures, boilerplate), both written: a row per document row, and the
    (host, line) pairs above the limit."""
    docs = row_key(docs).select("id", "key", "source", "text")
    figures = map_batches(docs, _pass, SCHEMA)
    figures = stage(figures.withColumns({"host": F.xxhash64("source"), "_row": F.monotonically_increasing_id()})
                    .drop("source"), "quality")
    lines = figures.select("host", "fp", F.explode(F.arrays_zip("line", "line_words")).alias("x"))
    held = (lines.groupBy("host", F.col("x.line").alias("line"), "fp").agg(F.min("x.line_words").alias("words"))
            .groupBy("host", "line").agg(F.count("*").alias("docs"), F.min("words").alias("words")).filter(F.col("docs") > min_docs))
    hosts = figures.select("host", "fp").distinct().groupBy("host").agg(F.count("*").alias("size"))
    limit = RATE * F.pow("size", F.lit(POWER)) * F.sqrt(LINE_WORDS / F.col("words"))
    return figures, stage(held.join(hosts, "host").filter(F.col("docs") > limit).select("host", "line"), "boilerplate")


def _judged(figures: DataFrame, boilerplate: DataFrame, max_lost: int) -> DataFrame:
    lines = figures.select("_row", "host", F.explode(F.arrays_zip("line", "line_words")).alias("x")) \
        .select("_row", "host", F.col("x.line").alias("line"), F.col("x.line_words").alias("words"))
    lost = (lines.join(boilerplate, ["host", "line"]).groupBy("_row")
            .agg(F.sum("words").alias("lost_words"), F.collect_list("line").alias("removed")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (figures.drop("line", "line_words", "fp").join(lost, "_row", "left").drop("_row")
            .withColumns({"lost_words": F.coalesce("lost_words", F.lit(0)), "base_failed": failed})
            .withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_words") <= max_lost * F.col("n_words"))))


def quality_figures(docs: DataFrame, min_docs: int = MIN_DOCS, max_lost: int = MAX_LOST) -> DataFrame:
    """One row per document row: (id, key, base figures, base_failed, lost_words,
    kept)."""
    return _judged(*_measured(docs, min_docs), max_lost).drop("host", "removed")


def _without_lines(raw: np.ndarray, drop: set) -> bytes:
    """The text without the lines whose normalised hash is in ``drop``."""
    off = np.array([0, len(raw)])
    start, end, _ = B.runs(~B.SPACE[raw], off)
    _, line_start, _, word, stop = _lines(raw, off, start, end)
    keys = dict(zip(line_start.tolist(), _line_keys(raw, start, end, word, stop).tolist()))
    left, here = [], 0
    for line in raw.tobytes().split(b"\n"):
        if not line or keys.get(here) not in drop:
            left.append(line)
        here += len(line) + 1
    return b"\n".join(left)


def _replaced(rb: pa.RecordBatch, text: str, rows: np.ndarray, cleaned: list[bytes], left_out: set[str]) -> pa.RecordBatch:
    """The batch with new texts in some rows and without the columns ``left_out``."""
    column = rb.column(text)
    mask = np.zeros(rb.num_rows, bool)
    mask[rows] = True
    column = pc.replace_with_mask(column, pa.array(mask), pa.array(cleaned, pa.binary()).view(pa.string()).cast(column.type))
    names = [n for n in rb.schema.names if n not in left_out]
    return pa.RecordBatch.from_arrays([column if n == text else rb.column(n) for n in names], names)


def _clean_pass(text: str, removed: str):
    def run(batches):
        for rb in batches:
            marks = rb.column(removed)
            rows = np.flatnonzero(marks.is_valid().to_numpy(zero_copy_only=False))
            texts = [np.frombuffer(x.encode(), np.uint8) for x in rb.column(text).take(pa.array(rows)).to_pylist()]
            cleaned = [_without_lines(x, set(marks[int(i)].as_py())) for i, x in zip(rows, texts)]
            yield _replaced(rb, text, rows, cleaned, {removed})
    return run


def _scan_pass(text: str, host: str, shared, max_lost: int):
    """Judges and cleans a row from its own text and the broadcast boilerplate."""
    def run(batches):
        for rb in batches:
            hosts, keep, rows, cleaned = rb.column(host).to_numpy(), np.zeros(rb.num_rows, bool), [], []
            for at, buf, off in B.slices(rb.column(text)):
                f, mine = _figures(buf, off), hosts[at:at + len(off) - 1]
                row = np.repeat(np.arange(len(mine)), f["lines"])
                marked = np.zeros(len(row), bool)
                for h in np.unique(mine):
                    if int(h) in shared.value:
                        of_host = mine[row] == h
                        marked[of_host] = np.isin(f["line"][of_host], shared.value[int(h)])
                lost = np.bincount(row[marked], f["line_words"][marked], len(mine))
                failed = (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])
                ok = ~failed & (100 * lost <= max_lost * f["n_words"])
                keep[at:at + len(mine)] = ok
                for i in np.flatnonzero(ok & (lost > 0)):
                    rows.append(at + int(i))
                    cleaned.append(_without_lines(buf[off[i]:off[i + 1]], set(f["line"][marked & (row == i)].tolist())))
            yield _replaced(rb, text, np.array(rows, np.int64), cleaned, {host}).filter(pa.array(keep))
    return run


def clean(docs: DataFrame, min_docs: int = MIN_DOCS, max_lost: int = MAX_LOST, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the boilerplate lines taken
    out of ``text``; the other lines stay as they are and in order, as do the
    other columns (``n_chars`` is that of the source text).  Up to
    ``broadcast_lines`` (host, line) pairs, counted first, the rows are judged
    and cleaned where they are read; with more, the rows to change get their
    lines by a join, the others are not shuffled."""
    figures, boilerplate = _measured(docs, min_docs)
    i, k, h, kept, removed = (safe_name(docs.columns, x) for x in ("_id", "_key", "_host", "_kept", "_removed"))
    host = F.xxhash64(column_or_null(docs, "source", "string"))
    if boilerplate.count() <= broadcast_lines and dict(docs.dtypes).get("text") == "string":
        discard(figures)
        lines: dict[int, list] = {}
        for r in boilerplate.collect():                    # at most broadcast_lines rows
            lines.setdefault(r["host"], []).append(r["line"])
        shared = docs.sparkSession.sparkContext.broadcast({x: np.array(sorted(y)) for x, y in lines.items()})
        return map_batches(docs.withColumn(h, host), _scan_pass("text", h, shared, max_lost), docs.schema)
    marks = _judged(figures, boilerplate, max_lost).filter(~F.col("kept") | (F.col("lost_words") > 0))
    marks = stage(marks.dropDuplicates(["id", "key", "host"]).select(
        F.col("id").alias(i), F.col("key").alias(k), F.col("host").alias(h), F.col("kept").alias(kept),
        F.col("removed").alias(removed)), "marks")
    discard(figures)
    text = F.xxhash64(column_or_null(docs, "text", "string"))
    clear, others = apart(docs, text, marks.select(k))
    same = column_or_null(docs, "doc_id", "long").eqNullSafe(F.col(i)) & (text == F.col(k)) & (host == F.col(h))
    others = others.join(marks, same, "left").filter(F.coalesce(F.col(kept), F.lit(True))).select(*docs.columns, removed)
    return clear.unionByName(map_batches(others, _clean_pass("text", removed), docs.schema))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows that the quality rules keep, without their
    boilerplate lines."""
    return clean(docs)


def q_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_figures(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lost_words")


QUERIES = {"op4_quality_lines": q_quality_lines}
ORACLES: dict = {}
