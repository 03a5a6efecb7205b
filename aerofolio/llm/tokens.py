"""Words and their hashes over whole Arrow batches, as numpy arrays.

A batch of texts is one byte buffer with row bounds. Words are found by a table lookup per byte, never per
row, and hashed by differences of running polynomial sums, so a word costs the same in any row. Pieces are
bounded in bytes; a longer text is a piece of its own, and all steps but the lookup go through it in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
BLOCK = 1 << 18
MASK = (1 << 64) - 1

# Odd multipliers of the running sums (bytes of a word; words of a window) and of the bit mixer.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
OTHER_BASE = 0xC2B2AE3D27D4EB4F
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def _table(separators: list[int], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    form, inside = np.arange(256, dtype=np.uint8), np.ones(256, bool)
    if lower:
        form[65:91] += 32
    inside[separators] = False
    return form, inside


#: Bytes to their form in a word, and which belong to one. Every byte of a multi-byte character does.
PLAIN = _table([0x20, *range(0x09, 0x0E)], lower=False)
PLAIN_LOWER = _table([0x20, *range(0x09, 0x0E)], lower=True)
ALNUM_LOWER = _table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], lower=True)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse modulo 2**64, for i below ``n``."""
    had = _powers.get(base)
    if had is not None and len(had[0]) >= n:
        return had
    size = max(n, 2 * BLOCK)

    def run(b: int) -> np.ndarray:
        out = np.full(size, b, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    found = run(base), run(pow(base, -1, 1 << 64))
    if size == 2 * BLOCK:  # what a block needs is kept; the powers for a single word of more bytes are not
        _powers[base] = found
    return found


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


def _differences(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of ``values[lo:hi]`` for each pair, equal for equal runs wherever they stand."""
    power, inverse = _power(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return (total[hi] - total[lo]) * inverse[lo]


class Words:
    """The words of some rows: byte bounds in ``data`` (case folded already), and each row's first word."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: tuple[np.ndarray, np.ndarray]):
        self.data = table[0][data]
        inside = table[1][data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True  # a word never goes over the end of a row
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, bounds)  # of row i: words first[i] to first[i + 1]

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        out = np.empty(len(self), np.uint64)
        at = 0
        while at < len(self):
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + BLOCK, side="right")))
            base = self.start[at]
            values = self.data[base : self.end[to - 1]].astype(np.uint64) + np.uint64(1)  # no byte counts for nothing
            lo, hi = self.start[at:to] - base, self.end[at:to] - base
            out[at:to] = mixed(_differences(values, lo, hi, BYTE_BASE))
            at = to
        return out

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``size`` words within a row, in order, and how many each row has."""
        n = np.maximum(self.counts - size + 1, 0)
        return runs(self.first[:-1], n), n

    def text(self, i: int, j: int) -> bytes:
        """Words ``i`` to ``j`` (excluded) joined by a space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[i:j].tolist(), self.end[i:j].tolist()))

    def joined(self, keep: np.ndarray | None = None) -> tuple[bytes, np.ndarray]:
        """All (kept) words, each followed by a space; and where each row's part ends, its last space included."""
        start, end, first = self.start, self.end, self.first
        if keep is not None:
            start, end = start[keep], end[keep]
            first = np.concatenate([[0], np.cumsum(keep)])[first]
        size = end - start + 1
        to = np.cumsum(size)
        out = np.empty(int(to[-1]) if len(to) else 0, np.uint8)
        at = 0
        while at < len(start):  # by blocks: the index takes eight times the bytes
            upto = max(at + 1, int(np.searchsorted(to, (to[at - 1] if at else 0) + BLOCK, side="right")))
            lo = to[at - 1] if at else 0
            shift = np.repeat(start[at:upto] - (to[at:upto] - size[at:upto]), size[at:upto])
            index = shift + np.arange(lo, to[upto - 1])
            out[lo : to[upto - 1]] = self.data[np.minimum(index, len(self.data) - 1)]
            at = upto
        out[to - 1] = 32
        return out.tobytes(), np.concatenate([[0], to])[first]


def runs(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...``: ``n[i]`` numbers for each i, one after another."""
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(n) - n
    return np.repeat(first - before, n) + np.arange(total)


def window_hashes(words: np.ndarray, at: np.ndarray, size: int, base_of: int = WORD_BASE) -> np.ndarray:
    """Rabin-Karp hash of ``size`` word hashes from each of ``at`` on: running sums, so no window is hashed anew."""
    out = np.empty(len(at), np.uint64)
    for i in range(0, len(at), BLOCK):
        part = at[i : i + BLOCK]
        if len(part):
            base = part[0]
            out[i : i + BLOCK] = mixed(_differences(words[base : part[-1] + size], part - base, part - base + size, base_of))
    return out


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into ``(first row, end row, bytes, bounds)`` of about ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
        to = min(to, len(column))
        yield at, to, raw[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to
