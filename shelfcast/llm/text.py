"""Words, lines and their hashes over Arrow text columns, with numpy and without a loop over words.

A word is a run of bytes outside space and ``\\t\\n\\v\\f\\r``; these bytes never occur inside a
longer UTF-8 sequence, so everything works on the column's bytes. Hashes are 64-bit
polynomials over bytes (words, lines) and over word hashes (n-grams), rolled by prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task; a longer text is handled by itself.
BLOCK_BYTES = (1 << 20) - 1

_BASE = 0x5851F42D4C957F2B
_WORD_BASE = 0x2545F4914F6CDD1B
_INVERSE = {b: pow(b, -1, 1 << 64) for b in (_BASE, _WORD_BASE)}
_LETTERS = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _grown(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(b: int) -> np.ndarray:
        out = np.full(size, b, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return powers(base), powers(_INVERSE[base])


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    return _grown(base, max(1 << 16, 1 << (size - 1).bit_length()))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in order, cut so that ``column`` holds at most ``limit`` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = total[at] - size[at]
            end = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


class Texts:
    """The texts of one slice: their bytes and where each begins (null counts as empty)."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.bytes = raw[offsets[0] : offsets[-1]]
        self.offsets = (offsets - offsets[0]).astype(np.int64)
        self.rows = len(column)
        self._prefix: np.ndarray | None = None

    def prefix(self) -> np.ndarray:
        if self._prefix is None:
            up, _ = _powers(_BASE, len(self.bytes) + 1)
            self._prefix = np.zeros(len(self.bytes) + 1, np.uint64)
            np.cumsum(_LETTERS[self.bytes] * up[: len(self.bytes)], out=self._prefix[1:])
        return self._prefix

    def spans_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the bytes of each span; equal spans have equal hashes wherever they stand."""
        p = self.prefix()
        _, down = _powers(_BASE, len(self.bytes) + 1)
        return mix((p[ends] - p[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def count(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        total = np.zeros(len(self.bytes) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


class Words:
    """Word spans of all texts of a slice, in order."""

    def __init__(self, texts: Texts):
        self.texts = texts
        b = texts.bytes
        inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
        edge = np.zeros(len(b) + 1, bool)
        edge[texts.offsets] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:-1]
        ends = inside
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, texts.offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(texts.rows), self.counts)
        self._hash: np.ndarray | None = None
        self._rolled: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self.texts.spans_hash(self.starts, self.ends)
        return self._hash

    def chars(self) -> np.ndarray:
        """Code points of each word."""
        total = np.zeros(len(self.texts.bytes) + 1, np.int64)
        np.cumsum((self.texts.bytes & 0xC0) != 0x80, out=total[1:])
        return total[self.ends] - total[self.starts]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every window of ``n`` words inside one text."""
        size = len(self)
        if self._rolled is None:
            up, _ = _powers(_WORD_BASE, size + 1)
            self._rolled = np.zeros(size + 1, np.uint64)
            np.cumsum(self.hash() * up[:size], out=self._rolled[1:])
        at = np.arange(max(0, size - n + 1))
        at = at[at + n <= self.first[self.doc[at] + 1]]
        _, down = _powers(_WORD_BASE, size + 1)
        return at, mix((self._rolled[at + n] - self._rolled[at]) * down[at])


def lines(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of every ``\\n``-split line."""
    breaks = np.flatnonzero(texts.bytes == 10)
    begins = np.concatenate([texts.offsets[:-1], breaks + 1])
    doc = np.concatenate([np.arange(texts.rows), np.searchsorted(texts.offsets, breaks, side="right") - 1])
    order = np.lexsort((begins, doc))
    begins, doc = begins[order], doc[order]
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, bool)
    ends = np.where(last, texts.offsets[doc + 1], np.append(begins[1:], 0) - 1)
    return begins, ends, doc


def repeats(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags by element: the key occurs twice or more in its text; it occurred before in its text."""
    n = len(keys)
    again, later = np.zeros(n, bool), np.zeros(n, bool)
    if not n:
        return again, later
    keys = mix(keys ^ mix(doc.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(keys)
    ordered = keys[order]
    head = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    times = np.diff(np.append(head, n))
    again[order] = np.repeat(times > 1, times)
    later[:] = again
    later[np.minimum.reduceat(order, head)] = False
    return again, later


def by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the bounds of each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def covered(size: int, at: np.ndarray, n: int) -> np.ndarray:
    """Flags of the words inside any of the windows that begin at ``at``."""
    step = np.bincount(at, minlength=size + 1) - np.bincount(at + n, minlength=size + 1)
    return np.cumsum(step)[:size] > 0
