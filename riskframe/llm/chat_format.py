"""Chat formatting by a grammar round trip.

The turns of a conversation are rendered by a line grammar:

    text      := turn*
    turn      := "### " role ":" NEWLINE content NEWLINE "</turn>" NEWLINE

``content`` runs to the first unescaped ``</turn>`` marker.  A marker (``### `` or
``</turn>``) that follows a backslash is content.  The rendered text is parsed by
a deterministic parser and compared with the source; a turn that does not come
back identical is escaped (each marker in it gets one more backslash; the parser
takes one off), and rendered and compared again.  Roles are written with percent
escapes for the characters that end a role line.  A piece that parses to its one
turn does so whatever follows it, so a conversation is its pieces in order.

The loss mask is the content spans of the assistant turns in the rendered text;
what training sees is the text under it, unescaped.

A conversation is never one value.  Its rows come sorted through one task, which
renders, checks and counts them one at a time; what it keeps between rows is a
number of code points, or the state of a hash.  The output has a row per turn.

Defined cases: null text is empty, null role is the empty role; a null turn sorts
first; rows that share a turn number are ordered by role, then text, and all are
kept; a null conv_id is one conversation of its own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_or_null, map_batches, table

HEAD, END = "### ", "</turn>"
MARK = re.compile(r"(\\*)(### |</turn>)")
ROLE_OUT = re.compile(r"[%:\r\n]")
ROLE_IN = re.compile(r"%([0-9A-F]{2})")
TRAINED = "assistant"


def escape(content: str) -> str:
    return MARK.sub(lambda m: m[1] + "\\" + m[2], content)


def unescape(content: str) -> str:
    return MARK.sub(lambda m: m[1][1:] + m[2] if m[1] else m[0], content)


def _render(role: str, content: str) -> tuple[str, int]:
    """The piece of a turn, and where its content begins."""
    head = HEAD + ROLE_OUT.sub(lambda m: f"%{ord(m[0]):02X}", role) + ":\n"
    return head + content + "\n" + END + "\n", len(head)


def parse(text: str) -> list[tuple[str, str]] | None:
    """The turns of a rendered text, None where it breaks the grammar."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(HEAD, at):
            return None
        colon = text.find(":\n", at)
        if colon < 0:
            return None
        role = ROLE_IN.sub(lambda m: chr(int(m[1], 16)), text[at + len(HEAD):colon])
        for m in MARK.finditer(text, colon + 2):
            if not m[1]:
                break
        else:
            return None
        if m[2] != END or text[m.start() - 1] != "\n" or m.start() - 1 < colon + 2 or not text.startswith("\n", m.end()):
            return None
        turns.append((role, unescape(text[colon + 2:m.start() - 1])))
        at = m.end() + 1
    return turns


def format_turn(role: str, content: str) -> tuple[str, int, int]:
    """(piece, content span in it): rendered raw first; escaped where the parser
    does not give the turn back."""
    for written in (content, escape(content)):
        piece, at = _render(role, written)
        if parse(piece) == [(role, content)]:
            return piece, at, at + len(written)
    raise ValueError("the grammar cannot carry this turn")


def _format_pass(batches):
    """Rows in conversation order -> their pieces, numbered and placed."""
    conversation, n, start, first = None, 0, 0, True
    for rb in batches:
        out = {c: [] for c in ("n", "start", "piece", "loss_start", "loss_stop")}
        for conv, role, text in zip(*(rb.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if first or conv != conversation:
                conversation, n, start, first = conv, 0, 0, False
            piece, a, b = format_turn(role, text)
            trained = role == TRAINED
            for c, v in zip(out, (n, start, piece, start + a if trained else None, start + b if trained else None)):
                out[c].append(v)
            n, start = n + 1, start + len(piece)
        yield pa.RecordBatch.from_arrays([rb.column("conv_id"), rb.column("role"), *(pa.array(v, pa.string() if c == "piece" else pa.int64()) for c, v in out.items())],
                                         ["conv_id", "role", *out])


PIECES = "conv_id long, role string, n long, start long, piece string, loss_start long, loss_stop long"


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, role, n, start, piece, loss_start, loss_stop): the rendered text of
    a conversation is its pieces by ``n``; ``start`` is a piece's place in it, and
    the span under the loss mask (null: none) is in code points of it."""
    rows = conversations.select(
        column_or_null(conversations, "conv_id", "long").alias("conv_id"), column_or_null(conversations, "turn", "long").alias("turn"),
        F.coalesce(column_or_null(conversations, "role", "string"), F.lit("")).alias("role"),
        F.coalesce(column_or_null(conversations, "text", "string"), F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_batches(ordered.drop("turn"), _format_pass, PIECES)


class _Digest:
    """What is kept of a conversation while its pieces go by."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.whole, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, start: int, piece: str, a: int | None, b: int | None) -> None:
        for role, content in parse(piece):
            self.whole.update(f"{role}\n{content}\n".encode())
            self.n_turns += 1
        if a is not None:
            text = unescape(piece[a - start:b - start])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.formatted_chars += len(piece)


def _read_pass(batches):
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def rows(done):
        values = zip(*((d.conv_id, d.n_turns, d.whole.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.formatted_chars) for d in done))
        return pa.RecordBatch.from_arrays([pa.array(v, pa.string() if "sha" in c else pa.int64()) for c, v in zip(names, values)], list(names))
    now = None
    for rb in batches:
        done = []
        for conv, start, piece, a, b in zip(*(rb.column(c).to_pylist() for c in ("conv_id", "start", "piece", "loss_start", "loss_stop"))):
            if now is None or conv != now.conv_id:
                if now is not None:
                    done.append(now)
                now = _Digest(conv)
            now.add(start, piece, a, b)
        if done:
            yield rows(done)
    if now is not None:
        yield rows([now])


def read_back(formatted: DataFrame, ordered: bool = False) -> DataFrame:
    """Digests of what the parser and the mask recover from the output, a row per
    conversation.  ``ordered``: the rows come as ``format_chats`` gives them; a
    table that was written is put in order first."""
    if not ordered:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "n")
    return map_batches(formatted, _read_pass, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                              "loss_sha256 string, formatted_chars long")


# The extra conversation of the query.
EXTRA_ID, EXTRA_TEXT = -7, "\\### Assistant: </turn> ok"


def q_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(EXTRA_ID, 0, "user", EXTRA_TEXT), (EXTRA_ID, 1, "assistant", EXTRA_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(rows.unionByName(extra)), ordered=True)


QUERIES = {"op3_chat_format": q_chat_format}
ORACLES: dict = {}
