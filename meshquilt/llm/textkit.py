"""Vectorised text kernels over Arrow string columns (NumPy, no per-word Python).

The hash of a word, line or other span of a batch's UTF-8 buffer is taken over its 8-byte blocks: every
block is mixed with its place, the mixed blocks are added up, and the sum is mixed with the span's length.
No step is linear in the text, so strings with a regular structure collide no more often than others.
Null and empty texts have no words. Rows are worked on in slices of about ``SLICE`` bytes, so memory
does not follow the batch; one text longer than that is a slice of its own and is never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
STEP = 0x9E3779B97F4A7C15
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_STATE: dict = {}


def _tables() -> dict:
    if "odd" not in _STATE:
        rng = np.random.Generator(np.random.PCG64(20240229))
        _STATE["odd"] = rng.integers(1, 2**64, 16, dtype=np.uint64, endpoint=False) | np.uint64(1)
        space = np.zeros(256, bool)
        space[list(SPACES)] = True
        _STATE["space"] = space
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        _STATE["lower"] = lower
        _STATE["part"] = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    return _STATE


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs give equal outputs, all bits depend on all bits."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def slices(column: pa.Array | pa.ChunkedArray):
    """(first row, bytes, offsets) of successive slices of a string column; nulls are empty."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    row = 0
    for chunk in chunks:
        chunk = chunk.cast(pa.large_string()).fill_null("")
        n = len(chunk)
        if not n:
            continue
        _, offs, data = chunk.buffers()
        offs = np.frombuffer(offs, np.int64)[chunk.offset : chunk.offset + n + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + SLICE, "right")) - 1)
            to = min(to, n)
            yield row + at, data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
            at = to
        row += n


class Spans:
    """``hash(start, end)`` of any byte spans of one slice; an empty span has a hash too."""

    def __init__(self, data: np.ndarray):
        self.padded = np.concatenate((data, np.zeros(8, np.uint8)))
        self.wide = np.ndarray(len(data) + 1, "<u8", self.padded, strides=(1,))  # the 8 bytes from each place on

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        start, size = np.asarray(start, np.int64), np.asarray(end - start, np.int64)
        if not len(start):
            return np.empty(0, np.uint64)
        part, salt = _tables()["part"], np.uint64(STEP)
        with np.errstate(over="ignore"):
            total = mix((self.wide[start] & part[np.minimum(size, 8)]) + salt)
            long = np.flatnonzero(size > 8)
            if len(long):
                blocks = (size[long] - 1) >> 3  # after the first
                first = np.cumsum(blocks) - blocks
                place = np.arange(int(blocks.sum())) - np.repeat(first, blocks) + 1
                left = np.repeat(size[long], blocks) - 8 * place
                value = self.wide[np.repeat(start[long], blocks) + 8 * place] & part[np.minimum(left, 8)]
                total[long] += np.add.reduceat(mix(value ^ mix(salt * (place + 1).astype(np.uint64))), first)
            return mix(total + salt * (size.astype(np.uint64) + np.uint64(1)))


def same(data: np.ndarray, a: tuple, b: tuple) -> np.ndarray:
    """Whether the spans (starts, ends) of ``a`` hold the same bytes as those of ``b``, one by one."""
    size = a[1] - a[0]
    ok = size == b[1] - b[0]
    some = np.flatnonzero(ok & (size > 0))
    if len(some):
        n = size[some]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        ok[some] = np.logical_and.reduceat(data[np.repeat(a[0][some], n) + place] == data[np.repeat(b[0][some], n) + place], first)
    return ok


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of ``inside`` bytes; no run crosses a row's end."""
    n = len(inside)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none
    first, last = np.empty(n, bool), np.empty(n, bool)
    first[0], first[1:] = True, ~inside[:-1]
    last[-1], last[:-1] = True, ~inside[1:]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] = True
    last[cut - 1] = True
    start, end = np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def words(data: np.ndarray, offs: np.ndarray):
    """(start, end, row) of the words ``[^\\x20\\x09-\\x0D]+``."""
    return runs(~_tables()["space"][data], offs)


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased, nothing else changed."""
    return _tables()["lower"][data]


def windows(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of the k-word windows that stay in one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(rows[:n] == rows[k - 1 :])
    odd = _tables()["odd"]
    with np.errstate(over="ignore"):
        total = hashes[at] * odd[0]
        for j in range(1, k):
            total = total + hashes[at + j] * odd[j]
    return mix(total), at
