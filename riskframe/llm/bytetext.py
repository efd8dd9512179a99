"""Vectorised work on the UTF-8 bytes of Arrow text batches (numpy only).

A batch is handled in slices of about ``SLICE`` bytes, so that the working
arrays stay small whatever the batch size; one longer text is one slice.
Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 18
U64 = np.uint64

_rng = np.random.RandomState(20240517)
BYTE_CODE = _rng.randint(1, 2**62, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
STEP = U64(0x9E3779B97F4A7C15 | 1)
STEP_INVERSE = U64(pow(int(STEP), -1, 2**64))
WORD_STEP = U64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Powers:
    """Running powers of STEP and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, SLICE + SLICE // 4)
            with np.errstate(over="ignore"):
                up, down = np.full(size, STEP), np.full(size, STEP_INVERSE)
                up[0] = down[0] = 1
                self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


POWERS = Powers()


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + SLICE, "right")) - 1)
        yield a, raw[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def runs(member: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross the row bounds ``off``:
    (starts, ends, first run of each row)."""
    edge = np.zeros(len(member) + 1, bool)
    edge[off] = True
    before = np.empty(len(member), bool)
    before[:1] = False
    before[1:] = member[:-1]
    start = np.flatnonzero(member & (~before | edge[:-1]))
    after = np.empty(len(member), bool)
    after[-1:] = False
    after[:-1] = member[1:]
    end = np.flatnonzero(member & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, off)


class Spans:
    """64-bit hashes of spans of one slice, from one running sum over it."""

    def __init__(self, items: np.ndarray) -> None:
        up, self.down = POWERS.get(len(items))
        self.total = np.zeros(len(items) + 1, U64)
        with np.errstate(over="ignore"):
            code = BYTE_CODE[items] if items.dtype == np.uint8 else items | U64(1)
            np.cumsum(code * up[:len(items)], out=self.total[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(U64))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Spans(buf).hashes(start, end)


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row, rows given by their first index."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def row_of(first: np.ndarray) -> np.ndarray:
    """Row of each item, from the items' first index per row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of k consecutive items inside one row; a row with
    fewer items, but not none, has one window over all of them.  Returns
    (hashes, first window of each row); windows keep the items' order."""
    n = np.diff(first)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    starts = np.zeros(len(first), np.int64)
    np.cumsum(counts, out=starts[1:])
    row = row_of(starts)
    at = first[row] + np.arange(starts[-1]) - starts[row]
    length = np.minimum(n[row], k)
    padded = np.concatenate([hashes, np.zeros(k, U64)])
    with np.errstate(over="ignore"):
        out = length.astype(U64)
        for j in range(k):
            item = padded[at + j] if j < 1 else np.where(length > j, padded[at + j], U64(0))
            out = out * WORD_STEP + item
            out ^= out >> U64(29)
        return mix(out), starts


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == U64 else x.astype(np.int64)
