"""Vectorised text work inside tasks: words, spans and 64-bit hashes straight from Arrow buffers.

Everything here sees one Arrow batch at a time. Batches are cut into slices of about a
mebibyte of text (a longer document is a slice of its own), so the numpy arrays of a slice,
eight bytes per byte of text, stay small.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
#: The bytes that separate words (space, tab, line feed, vertical tab, form feed, carriage return).
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_MULTIPLIER = 0x9E3779B97F4A7C15 | 5


def byte_table(seed: int) -> np.ndarray:
    """256 random 64-bit numbers, one for each byte."""
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)


def space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SPACE_BYTES)] = True
    return table


def lower_table() -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits (splitmix finaliser)."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row starts; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(places, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about ``limit`` bytes each; a longer row is alone in its range."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_spans(
    data: np.ndarray, bounds: np.ndarray, separators: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``data``; no word crosses one of ``bounds``.

    ``separators`` says of each byte whether it separates words; white space by default.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~(space_table() if separators is None else separators)[data]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    before[inner] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends


class SpanHasher:
    """64-bit hashes of byte spans, from prefix sums of a polynomial."""

    def __init__(self, seed: int, fold_case: bool = False):
        self.table = byte_table(seed)
        if fold_case:
            self.table = self.table[lower_table()]
        self.factor = np.uint64((_MULTIPLIER + 2 * seed) | 1)
        self._grow(SLICE_BYTES + 1)

    def _grow(self, n: int) -> None:
        inverse = np.uint64(pow(int(self.factor), -1, 1 << 64))
        self.powers, self.inverses = np.full(n, self.factor), np.full(n, inverse)
        self.powers[0] = self.inverses[0] = 1
        self.powers, self.inverses = np.multiply.accumulate(self.powers), np.multiply.accumulate(self.inverses)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(data) + 1 > len(self.powers):
            self._grow(len(data) + 1)
        total = np.empty(len(data) + 1, np.uint64)
        total[0] = 0
        np.cumsum(self.table[data] * self.powers[: len(data)], out=total[1:])
        return total

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        return mix((prefix[ends] - prefix[starts]) * self.inverses[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of spans in ascending order, over text of any length in bounded steps."""
        if len(data) <= SLICE_BYTES:
            return self.spans(self.prefix(data), starts, ends)
        out, first = np.empty(len(starts), np.uint64), 0
        while first < len(starts):
            base = starts[first]
            last = max(int(np.searchsorted(ends, base + SLICE_BYTES, side="right")), first + 1)
            part = data[base : ends[last - 1]]
            out[first:last] = self.spans(self.prefix(part), starts[first:last] - base, ends[first:last] - base)
            first = last
        return out


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every span, one span after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total, dtype=np.int64)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, which at its end gives the memory it had back to the system.

    Python workers live on between tasks, and what they keep is missing in the next stage.
    """

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has it
        if trim:
            trim(0)

    return whole
