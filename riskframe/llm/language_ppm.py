"""Language identification by prediction by partial matching (PPM).

Per language a byte context tree of orders 0 to 2 is counted over all training
texts.  Bytes are first folded into classes (ASCII letters without case, one
class each for white space and controls, digits, and other ASCII marks; every
byte above 127 is its own class).  The statistics are then frozen: a symbol that
a context has seen costs -log2(count / (total + distinct)); otherwise the escape
costs -log2(distinct / (total + distinct)) and the next shorter context pays, down
to a uniform order -1.  Code lengths are whole multiples of 2^-16 bit, so the sum
over a text is exact and does not depend on how the rows are cut into batches.
The language with the shortest code wins; ties go to the first in name order.

The score is the winner's posterior, which tells languages apart but not whether
the text is of any of them.  So the bits a byte of the winner's code are held
against those of the learned texts that it wins rightly: a text over
median + ``SPREADS`` x (``TAIL`` quantile - median) of its language is none of the
learned ones, and its score is 0.  The quantiles are exact over counts of whole
64ths of a bit.  A language with fewer than ``MIN_TEXTS`` such texts has no limit.

Training counts are a Spark aggregate: each batch sends one row per (language,
trigram) it holds.  The model has at most languages x 157^3 counts, whatever the
corpus size; it is gathered once and broadcast.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text when no row is labelled.  Rows with a null language or, with the
default split, of the held-out fold are not learned from; a null id is not held
out.  Repeated rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytetext as B
from .common import map_batches, row_key, stage, table, without

FOLDS = 5
MIN_SCORE = 0.5
TAIL = 0.9
SPREADS = 20                   # sf0.01: limits of 4.8-5.3 bits; every third text of sf0.1: up to 4.2, random letters from 11.6
MIN_TEXTS = 30
BIN = 64                       # counted parts of a bit

CLASS = np.zeros(256, np.int64)
CLASS[33:127] = 28
CLASS[48:58] = 27
CLASS[65:91] = CLASS[97:123] = np.arange(1, 27)
CLASS[128:] = np.arange(29, 157)
A = 157                        # classes
BIT = 1 << 16                  # units of a code length per bit
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def _contexts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Trigram code (two context classes, symbol) of every byte; a row begins
    in the context of white space."""
    c = CLASS[buf]
    one = np.concatenate([[0], c[:-1]])
    one[off[:-1][off[:-1] < len(c)]] = 0
    two = np.concatenate([[0], one[:-1]])
    two[off[:-1][off[:-1] < len(c)]] = 0
    return (two * A + one) * A + c


def _count_pass(batches):
    for rb in batches:
        langs = np.array(rb.column("lang").to_pylist(), object)
        total: dict[str, dict] = {}
        for at, buf, off in B.slices(rb.column("text")):
            code = _contexts(buf, off)
            lang = langs[at:at + len(off) - 1]
            for name in set(lang):
                mine = code[np.repeat(lang == name, np.diff(off))]
                key, n = np.unique(mine, return_counts=True)
                total.setdefault(name, []).append((key, n))
        for name, parts in total.items():
            key, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(back, np.concatenate([p[1] for p in parts]), len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(key), pa.string()), pa.array(key), pa.array(n)],
                                             ["lang", "code", "n"])


def _cost(num, den):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.rint(-np.log2(num / den) * BIT)


class Model:
    """Frozen code lengths: ``seen`` trigrams have a row of ``full`` (one
    column per language); for others the escape of the order-2 context and the
    order-1 cost add up."""

    def __init__(self, langs: list[str], lang: np.ndarray, code: np.ndarray, n: np.ndarray) -> None:
        self.langs = langs
        self.seen = np.unique(code)
        self.full = np.zeros((len(self.seen) + 1, len(langs)), np.int32)
        self.escape = np.zeros((A * A, len(langs)), np.int32)
        self.short = np.zeros((A * A, len(langs)), np.int32)
        for j in range(len(langs)):
            mine = lang == j
            key, cnt = code[mine], n[mine].astype(np.float64)
            # orders 0 and 1
            sym = np.bincount(key % A, cnt, A)
            kinds, total = (sym > 0).sum(), sym.sum()
            zero = np.where(sym > 0, _cost(np.maximum(sym, 1), total + kinds), _cost(max(kinds, 1), total + kinds) + _cost(1, A))
            pair = np.bincount(key % (A * A), cnt, A * A).reshape(A, A)
            kinds, total = (pair > 0).sum(1)[:, None], pair.sum(1)[:, None]
            leave = np.where(kinds > 0, _cost(np.maximum(kinds, 1), np.maximum(total + kinds, 1)), 0)
            one = np.where(pair > 0, _cost(np.maximum(pair, 1), np.maximum(total + kinds, 1)), leave + zero[None, :])
            # order 2
            ctx = key // A
            kinds2, total2 = np.bincount(ctx, minlength=A * A), np.bincount(ctx, cnt, A * A)
            leave2 = np.where(kinds2 > 0, _cost(np.maximum(kinds2, 1), np.maximum(total2 + kinds2, 1)), 0)
            self.escape[:, j], self.short[:, j] = leave2, one.reshape(-1)
            cost = leave2[self.seen // A] + one.reshape(-1)[self.seen % (A * A)]
            at = np.searchsorted(self.seen, key)
            cost[at] = _cost(cnt, (total2 + kinds2)[ctx])
            self.full[1:, j] = cost

    def lookup(self) -> np.ndarray:
        index = np.zeros(A ** 3, np.int32)
        index[self.seen] = np.arange(1, len(self.seen) + 1)
        return index


def fit(training: DataFrame) -> Model | None:
    """Count (lang, text) rows with a language; None when there are none."""
    counts = (map_batches(training.filter("lang is not null").select("lang", "text"), _count_pass, "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")).orderBy("lang", "code").toArrow())
    if not counts.num_rows:
        return None
    lang = counts.column("lang").combine_chunks().dictionary_encode()
    names = lang.dictionary.to_pylist()
    return Model(names, lang.indices.to_numpy(), counts.column("code").to_numpy(), counts.column("n").to_numpy())


def has_letters(column) -> np.ndarray:
    out = np.zeros(len(column), bool)
    for at, buf, off in B.slices(column):
        out[at:at + len(off) - 1] = B.per_row(LETTER[buf].astype(np.int64), off) > 0
        for i in np.flatnonzero(~out[at:at + len(off) - 1] & (B.per_row((buf > 127).astype(np.int64), off) > 0)):
            out[at + i] = any(ch.isalpha() for ch in buf[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def _predict_pass(shared):
    def run(batches):
        model = shared.value
        index = model.lookup() if model else None
        for rb in batches:
            letters = has_letters(rb.column("text"))
            pred, score, bits = np.full(rb.num_rows, "und", object), np.zeros(rb.num_rows), np.zeros(rb.num_rows, np.int64)
            for at, buf, off in B.slices(rb.column("text")) if model else ():
                if not len(buf):
                    continue
                code = _contexts(buf, off)
                j = index[code]
                cost = model.full[j]
                new = np.flatnonzero(j == 0)
                if len(new):
                    cost[new] = model.escape[code[new] // A] + model.short[code[new] % (A * A)]
                full = np.flatnonzero(np.diff(off) > 0)
                length = np.add.reduceat(cost, off[:-1][full], axis=0, dtype=np.int64)
                best = length.argmin(axis=1)
                over = (length - length.min(axis=1, keepdims=True)) / BIT
                share = 1.0 / np.exp2(-np.minimum(over, 1000.0)).sum(axis=1)
                pred[at + full] = np.array(model.langs, object)[best]
                score[at + full] = share
                bits[at + full] = np.rint(length.min(axis=1) * (BIN / BIT) / np.diff(off)[full])
            pred[~letters], score[~letters] = "und", 0.0
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), rb.column("key"), rb.column("lang"), pa.array(letters), pa.array(pred, pa.string()),
                 pa.array(score), pa.array(bits)], ["id", "key", "lang", "has_letter", "lang_pred", "score", "bits"])
    return run


def held_out(doc_id: str = "id", folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit_limits(found: DataFrame) -> DataFrame:
    """(learned, limit): the most bits a byte, in parts of ``BIN``, of a text of
    each language."""
    counts = found.filter("has_letter and lang = lang_pred").groupBy("lang", "bits").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("lang")                     # one row per 64th of a bit
    ranked = counts.withColumns({"total": F.sum("n").over(whole), "upto": F.sum("n").over(whole.orderBy("bits"))})

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("total") * F.lit(q), F.col("bits")))
    return (ranked.filter(F.col("total") >= MIN_TEXTS).groupBy(F.col("lang").alias("learned"))
            .agg(quantile(0.5).alias("middle"), quantile(TAIL).alias("high"))
            .select("learned", (F.col("middle") + SPREADS * F.greatest(F.col("high") - F.col("middle"), F.lit(BIN // 8)))
                    .alias("limit")))


def identify(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(id, key, held_out, has_letter, lang_pred, score) of every row, by a model
    learned from the labelled rows outside the held-out fold."""
    rows = row_key(docs).select("id", "key", "lang", "text")
    model = fit(rows.filter(~held_out(folds=folds)))
    spark = docs.sparkSession
    out = stage(map_batches(rows, _predict_pass(spark.sparkContext.broadcast(model)),
                            "id long, key long, lang string, has_letter boolean, lang_pred string, score double, bits long"),
                "language")
    limits = F.broadcast(fit_limits(out.filter(~held_out(folds=folds))))      # one row per language, from learned rows
    strange = F.coalesce(F.col("bits") > F.col("limit"), F.lit(False))
    return (out.join(limits, F.col("lang_pred") == F.col("learned"), "left")
            .select("id", "key", "has_letter", "lang_pred", F.when(strange, 0.0).otherwise(F.col("score")).alias("score"))
            .withColumn("held_out", held_out(folds=folds)))


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without a letter go, and those whose language is
    less likely than ``MIN_SCORE`` or none of the learned ones (score 0)."""
    found = identify(docs)
    return without(docs, found.filter(~F.col("has_letter") | ((F.col("lang_pred") != "und") & (F.col("score") < MIN_SCORE))))


def q_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")


QUERIES = {"op9_language_ppm": q_language_ppm}
ORACLES: dict = {}
