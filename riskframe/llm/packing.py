"""Mixture-controlled packing by deficit round-robin over source queues.

Every document is tokenized and closed with an end id.  The documents of a
source form a queue.  The stream is a series of mixing windows of ``capacity``
tokens: in each one a source earns a credit of its share of the tokens (its
target proportion) and sends whole quanta of ``quantum`` tokens while its
credit lasts; what is left, the deficit, is carried into the next window.  The
stream is cut into sequences of ``capacity`` tokens, so only the last one has
padding.

The credits have a closed form: after w windows source s has sent
min(T_s, quantum * floor(w * capacity * p_s / quantum)) tokens.  So where a token goes
follows from its place in its queue and the queues' totals, and the deficits that
a partition's windows inherit need no hand-over.  With up to ``max_queues`` queues
their totals are broadcast and each document is cut on its own, in any partition.
With more, the quanta of all queues are a table: each knows its window, running
sums over buckets of windows give its position, and documents meet their quanta
in a join; the positions are the same.  Places in the queues are running sums over
spans of parts, parts of a span, and documents of a part.

Proportions default to the sources' shares of all tokens, so the queues run dry
together.  Weights that are not positive and finite, or name no source, are an
error.  With other targets a queue that is dry sends nothing, and the others
go on in their proportions.

Defined cases: null text is empty and gives the end id alone; a null source is a
queue of its own; repeated rows are packed as often as they occur; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, row_key, stage, table

CAPACITY = 4096
QUANTUM = 128                  # 32 of them a window
END_ID = 2
MAX_QUEUES = 10_000            # queues of a broadcast; more meet their quanta in a join
WINDOW_BUCKET = 1 << 16        # windows of one running sum over quanta
QUANTA_ROWS = 1 << 16          # quanta of a queue that one row gives
PART_ROWS = 1024               # documents of one part of a queue's running sum
SPAN_PARTS = 4096              # parts of one span of it
CACHE = 300_000                # chunks of one generation that a worker remembers
LETTERS_MARKS = re.compile("([A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u012f\\u0131-\\u024f]*)([!-/:-@\\[-`{-~]*)")
SEPARATORS = re.compile("[\x1c-\x1f]")    # white space to Python, but not to the tokenizer


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: Byte-level BPE writes bytes that have no printable Latin-1 character as U+0100 and up, in order.
BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}


class Encoder(dict):
    """Ids (as 16-bit numbers) of the chunks that white space separates: the tokenizer
    drops white space, ignores case and never joins across it.  Chunks met lately
    are remembered in two generations of ``CACHE`` entries.  A new chunk of Latin
    letters goes to the BPE model directly, one followed by ASCII marks in two
    parts (as the tokenizer's own split has it), any other to the whole
    tokenizer."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are held in 16 bits; this vocabulary is larger")
        self.model = self.tokenizer.model
        self.old: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            if chunk.isascii() and chunk.isalpha():
                ids = array("H", [t.id for t in self.model.tokenize(chunk.lower())]).tobytes()
            elif (m := LETTERS_MARKS.fullmatch(chunk)) is None or "<|" in chunk:
                ids = array("H", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
            elif m[1] and m[2]:
                ids = self[m[1]] + self[m[2]]
            else:
                written = chunk.lower().encode().decode("latin-1").translate(BYTE_LEVEL)
                ids = array("H", [t.id for t in self.model.tokenize(written)]).tobytes()
        self[chunk] = ids
        return ids

    @staticmethod
    def chunks(text: str) -> list[str]:
        if SEPARATORS.search(text):
            return text.replace("\n", " ").split(" ")
        if "<|" not in text:                               # else case tells special tokens
            text = text.encode().lower().decode()
        return text.split()

    def whole(self, text: str) -> bytes:
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, self.chunks(text)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder, kept between tasks with what it remembers."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _token_pass(path: str, end_id: int):
    end = np.array([end_id], "<u2").tobytes()

    def run(batches):
        for rb in batches:
            for a in range(0, rb.num_rows, 256):
                part = rb.slice(a, 256)
                ids = [encoder(path).whole(t or "") + end for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("source"), pa.array(ids, pa.binary()),
                     pa.array([len(x) // 2 for x in ids], pa.int64())], ["id", "source", "ids", "n"])
    return run


def tokenize(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(id, source, ids, n): ids as little-endian unsigned 16-bit numbers."""
    return map_batches(row_key(docs).select("id", "source", "text"), _token_pass(path or tokenizer_path(), end_id),
                       "id long, source string, ids binary, n long")


class Stream:
    """Closed form of the round-robin: totals and shares of the queues."""

    def __init__(self, totals: np.ndarray, shares: np.ndarray, capacity: int, quantum: int) -> None:
        self.totals, self.capacity, self.quantum = totals, capacity, quantum
        self.rate = shares * (capacity / quantum)          # quanta a window

    def sent(self, queue, window) -> np.ndarray:
        """Tokens that the queues have sent before the windows."""
        quanta = np.floor(np.asarray(window, np.float64) * self.rate[queue]).astype(np.int64)
        return np.minimum(quanta * self.quantum, self.totals[queue])

    def window_of(self, queue: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The window in which the queue sends the token at the place."""
        w = np.maximum(np.floor((place // self.quantum + 1) / self.rate[queue]).astype(np.int64) - 2, 0)
        for _ in range(5):                                 # floor and division may differ by a step
            w += self.sent(queue, w + 1) <= place
        return w

    def positions(self, queue: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Position in the stream of the token at each place of a queue."""
        w = self.window_of(queue, place)
        windows, at = np.unique(w, return_inverse=True)
        out = place - self.sent(queue, w)
        every = np.arange(len(self.totals))[None, :]
        block = max(1, (1 << 18) // max(1, len(self.totals)))
        order = np.argsort(at, kind="stable")
        first = np.searchsorted(at[order], np.arange(0, len(windows) + block, block))
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            mine = windows[i * block:(i + 1) * block, None]
            now = self.sent(every, mine)
            ahead = np.zeros((len(mine), len(self.totals) + 1), np.int64)
            np.cumsum(self.sent(every, mine + 1) - now, axis=1, out=ahead[:, 1:])
            rows = order[a:b]
            out[rows] += now.sum(axis=1)[at[rows] - i * block] + ahead[at[rows] - i * block, queue[rows]]
        return out

    def pieces(self, queue: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, start, length, position in the stream) of the pieces of
        documents at places of queues, in document order and gapless there."""
        doc, begin, length = by_quantum(place, n, self.quantum)
        return joined(doc, begin - place[doc], length, self.positions(queue[doc], begin), self.capacity)


def by_quantum(place: np.ndarray, n: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, length) of the parts of documents in each quantum."""
    count = (place + n - 1) // q - place // q + 1
    doc = np.repeat(np.arange(len(n)), count)
    j = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.maximum(place[doc], (place[doc] // q + j) * q)
    return doc, begin, np.minimum(place[doc] + n[doc], (place[doc] // q + j + 1) * q) - begin


def joined(doc: np.ndarray, start: np.ndarray, length: np.ndarray, at: np.ndarray, cap: int) -> tuple[np.ndarray, ...]:
    """The parts cut at the ends of sequences, and those that follow each other
    in one sequence as one."""
    while True:
        room = cap - at % cap
        long = length > room
        if not long.any():
            break
        rest = np.flatnonzero(long)
        doc, start, at, length = (np.insert(x, rest + 1, y) for x, y in (
            (doc, doc[rest]), (start, start[rest] + room[rest]), (at, at[rest] + room[rest]), (length, length[rest] - room[rest])))
        length[rest + np.arange(len(rest))] = room[rest]
    follows = (doc[1:] == doc[:-1]) & (at[:-1] + length[:-1] == at[1:]) & (at[1:] % cap != 0)
    new = np.flatnonzero(np.concatenate([[True], ~follows])) if len(doc) else doc
    return doc[new], start[new], np.add.reduceat(length, new) if len(new) else length, at[new]


PIECES = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _cut(rb: pa.RecordBatch, doc, start, length, at, capacity: int) -> pa.RecordBatch:
    """The pieces of a batch of documents, with their ids."""
    n, ids = rb.column("n").to_numpy(), rb.column("ids")
    _, off, data = ids.buffers()
    head = np.frombuffer(off, np.int32, 1, ids.offset * 4)
    ends = np.concatenate([head, head + 2 * np.cumsum(length)]).astype(np.int32)
    cut = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends), data])
    return pa.RecordBatch.from_arrays(
        [rb.column("id").take(pa.array(doc)), pa.array(start), pa.array(length), cut, pa.array(n[doc]),
         pa.array(at // capacity), pa.array(at % capacity)],
        ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def _piece_pass(shared, capacity: int):
    def run(batches):
        for rb in batches:
            if rb.num_rows:
                queue, place, n = (rb.column(c).to_numpy() for c in ("queue", "place", "n"))
                yield _cut(rb, *shared.value.pieces(queue, place, n), capacity)
    return run


def _joined_pass(capacity: int, quantum: int):
    """Documents with the positions of their quanta (array ``at``)."""
    def run(batches):
        for rb in batches:
            if rb.num_rows:
                place, n = rb.column("place").to_numpy(), rb.column("n").to_numpy()
                doc, begin, length = by_quantum(place, n, quantum)
                at = rb.column("at").flatten().to_numpy() + np.where(begin > place[doc], 0, begin % quantum)
                yield _cut(rb, *joined(doc, begin - place[doc], length, at, capacity), capacity)
    return run


def _quanta_pass(capacity: int, quantum: int):
    """Rows (source, n, share, first) -> their quanta from the first on."""
    def run(batches):
        for rb in batches:
            for source, n, share, first in zip(*(rb.column(c).to_pylist() for c in ("source", "n", "share", "first"))):
                j = np.arange(first, min(first + QUANTA_ROWS, -(-n // quantum)))
                stream = Stream(np.array([n]), np.array([share]), capacity, quantum)
                window = stream.window_of(np.zeros(len(j), np.int64), j * quantum)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([source] * len(j), pa.string()), pa.array(j), pa.array(window), pa.array(np.minimum(quantum, n - j * quantum))],
                    ["source", "j", "window", "size"])
    return run


def quantum_positions(queues: DataFrame, capacity: int, quantum: int) -> DataFrame:
    """``queues(source, n, share)`` -> (source, j, at): where each quantum of each
    queue begins in the stream."""
    last = F.expr(f"(n - 1) div {quantum} div {QUANTA_ROWS}")
    rows = queues.select("source", "n", "share", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: i * QUANTA_ROWS)).alias("first"))
    quanta = map_batches(rows.repartition("source", "first"), _quanta_pass(capacity, quantum), "source string, j long, window long, size long")
    quanta = stage(quanta.withColumn("bucket", F.expr(f"window div {WINDOW_BUCKET}")), "quanta")
    sums = quanta.groupBy("bucket").agg(F.sum("size").alias("total"))
    base = sums.select("bucket", (F.sum("total").over(Window.orderBy("bucket")) - F.col("total")).alias("base"))   # a row per bucket
    inner = Window.partitionBy("bucket").orderBy("window", F.col("source").asc_nulls_first(), "j")
    inside = quanta.withColumn("inside", F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    return inside.join(base, "bucket").select("source", "j", (F.col("base") + F.col("inside")).alias("at"))


def _weighed(sources: DataFrame, proportions: dict | None) -> DataFrame:
    """``sources(source, n)`` with their shares of a window."""
    weight = F.col("n").cast("double")
    if proportions:
        if bad := sorted(str(k) for k, v in proportions.items() if not (0 < v < float("inf"))):
            raise ValueError(f"weights must be positive and finite: {bad}")
        given = sources.sparkSession.createDataFrame([(k, float(v)) for k, v in proportions.items()], "name string, given double")
        unknown = given.join(sources, F.col("name").eqNullSafe(F.col("source")), "left_anti")
        if not sources.isEmpty() and (names := [r["name"] for r in unknown.collect()]):
            raise ValueError(f"no such source: {names}")
        sources = sources.join(given, F.col("source").eqNullSafe(F.col("name")), "left").drop("name")
        weight = F.coalesce("given", weight)
    return sources.select("source", "n", weight.alias("weight"))


def pack(docs: DataFrame, capacity: int = CAPACITY, quantum: int = QUANTUM, proportions: dict | None = None,
         path: str | None = None, end_id: int = END_ID, max_queues: int = MAX_QUEUES) -> DataFrame:
    """One row per piece: (id, start, length, ids, doc_tokens, sequence_id,
    offset).  ``proportions`` maps sources to positive target weights (others
    keep their number of tokens as weight)."""
    spark = docs.sparkSession
    tokens = stage(tokenize(docs, path, end_id).withColumn("_row", F.monotonically_increasing_id()), "tokens")
    queues = stage(_weighed(tokens.groupBy("source").agg(F.sum("n").alias("n")), proportions), "queues")
    count, whole = queues.agg(F.count("*"), F.sum("weight")).first()

    # place of each document in its queue: sums over parts, then within them
    sizes = tokens.select("_row", "n", "source").withColumn("part", F.expr(f"_row div {PART_ROWS}"))
    parts = sizes.groupBy("source", "part").agg(F.sum("n").alias("total"))
    parts = parts.withColumn("span", F.expr(f"part div {SPAN_PARTS}"))
    spans = parts.groupBy("source", "span").agg(F.sum("total").alias("whole"))
    spans = spans.select(F.col("source").alias("_s"), F.col("span").alias("_span"),
                         (F.sum("whole").over(Window.partitionBy("source").orderBy("span")) - F.col("whole")).alias("before"))
    in_span = F.sum("total").over(Window.partitionBy("source", "span").orderBy("part")) - F.col("total")
    base = (parts.withColumn("in_span", in_span).join(spans, F.col("source").eqNullSafe(F.col("_s")) & (F.col("span") == F.col("_span")))
            .select(F.col("source").alias("_source"), F.col("part").alias("_part"), (F.col("before") + F.col("in_span")).alias("base")))
    inner = Window.partitionBy("source", "part").orderBy("_row")
    places = (sizes.withColumn("inside", F.sum("n").over(inner) - F.col("n"))
              .join(base, F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part")))
              .select("_row", "source", "n", (F.col("base") + F.col("inside")).alias("place")))
    if count <= max_queues:
        lanes = queues.orderBy(F.col("source").asc_nulls_first()).collect()      # at most max_queues rows
        share = np.array([r["weight"] / whole for r in lanes], np.float64)
        stream = Stream(np.array([r["n"] for r in lanes], np.int64), share, capacity, quantum)
        queue = spark.createDataFrame([(i, r["source"]) for i, r in enumerate(lanes)], "queue int, lane string")
        places = places.join(F.broadcast(queue), F.col("source").eqNullSafe(F.col("lane"))).select("_row", "queue", "place")
        return map_batches(tokens.select("_row", "id", "ids", "n").join(places, "_row").select("id", "queue", "place", "n", "ids"),
                           _piece_pass(spark.sparkContext.broadcast(stream), capacity), PIECES)
    at = quantum_positions(queues.select("source", "n", (F.col("weight") / whole).alias("share")), capacity, quantum)
    j = F.explode(F.sequence(F.expr(f"place div {quantum}"), F.expr(f"(place + n - 1) div {quantum}")))
    parts_of = places.select("_row", "source", "place", j.alias("_j"))
    met = (parts_of.join(at.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_j") == F.col("j")))
           .groupBy("_row", "place").agg(F.sort_array(F.collect_list(F.struct("j", "at"))).alias("q"))
           .select("_row", "place", F.col("q.at").alias("at")))                  # as many as the document has quanta
    return map_batches(tokens.select("_row", "id", "ids", "n").join(met, "_row").select("id", "place", "n", "ids", "at"),
                       _joined_pass(capacity, quantum), PIECES)


def _digest_pass(batches):
    for rb in batches:
        crc = [zlib.crc32(np.frombuffer(x.as_buffer(), "<u2").astype("<u4")) for x in rb.column("ids")]
        yield pa.RecordBatch.from_arrays(
            [rb.column("id"), rb.column("start"), rb.column("length"), pa.array(crc, pa.int64()), rb.column("doc_tokens"),
             rb.column("sequence_id"), rb.column("offset")],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def digests(pieces: DataFrame) -> DataFrame:
    return map_batches(pieces, _digest_pass, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                             "sequence_id long, offset long")


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: one row per piece, the ids as their digest."""
    return digests(pack(docs))


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack(table(spark, sf_dir, "documents")))


QUERIES = {"op6_packing": q_packing}
ORACLES: dict = {}
