"""Texts of Arrow batches as numpy arrays: bytes, words, hashes of words and of word windows.

All functions work on a slice of a batch at once, without Python objects per word. Slices
are cut between documents at about ``PIECE`` bytes; a longer document is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 4 << 20
_U = np.uint64
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=_U)

#: Bytes that belong to words, by kind of word.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Digits, A-Z, a-z and every byte of a character beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; a bijection."""
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    x = left * _U(0x9E3779B97F4A7C15)
    x += right
    x ^= x >> _U(29)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(32)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their bounds (one more than texts); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    if not len(bounds):
        bounds = np.zeros(1, np.int64)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(batches, limit: int = PIECE, piece_column: int = 1) -> Iterator[pa.RecordBatch]:
    """The batches, cut between rows so that the texts of a piece have about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(piece_column)), 0)
        yield from cut(batch, sizes.to_numpy(zero_copy_only=False), limit)


def cut(batch: pa.RecordBatch, sizes: np.ndarray, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batch, cut between rows so that the sizes of a piece come to about ``limit``."""
    if not batch.num_rows:
        return
    group = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for low, high in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(low, high - low)


@dataclass
class Words:
    """Words of some documents. ``first[d]`` is the index of the first word of document d."""

    data: np.ndarray  # bytes after ``change``, eight zeros behind them
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    bounds: np.ndarray  # byte range of each document

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """Index of the document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def positions(self) -> np.ndarray:
        """Place of each word in its document."""
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end, seed)

    def text(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]].tobytes()


def split_words(column: pa.Array, inside: np.ndarray, change: np.ndarray = SAME) -> Words:
    """Words of each text: the longest runs of bytes marked in ``inside``."""
    raw, bounds = text_bytes(column)
    n = len(raw)
    data = np.zeros(n + 8, dtype=np.uint8)
    np.take(change, raw, out=data[:n])
    mine = inside[raw]
    begins, closes = mine.copy(), mine.copy()
    begins[1:] &= ~mine[:-1]
    closes[:-1] &= ~mine[1:]
    low, high = bounds[:-1], bounds[1:] - 1
    low, high = low[low < n], high[high >= 0]
    begins[low] = mine[low]
    closes[high] = mine[high]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(closes) + 1, np.searchsorted(start, bounds), bounds)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans; ``data`` has eight more bytes than the spans reach."""
    lanes = np.ndarray((max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))
    length = end - start
    h = mix(length.astype(_U) + _U(seed * 0x51_7C_C1B7 + 1))
    if not len(h):
        return h
    h = join_hashes(h, lanes[start] & _MASK[np.minimum(length, 8)])
    rows, done = np.flatnonzero(length > 8), 8
    while len(rows):
        left = length[rows] - done
        lane = lanes[start[rows] + done] & _MASK[np.minimum(left, 8)]
        h[rows] = join_hashes(h[rows], lane)
        rows, done = rows[left > 8], done + 8
    return h


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` values: entry i covers i..i+k-1. Runs also cross documents."""
    if len(h) < k:
        return np.empty(0, dtype=_U)
    out, span, power, size = None, 0, h, 1
    while k:
        if k & 1:
            if out is None:
                out, span = power, size
            else:
                right = power[span:]
                out, span = join_hashes(out[: len(right)], right), span + size
        k >>= 1
        if k:
            right = power[size:]
            power, size = join_hashes(power[: len(right)], right), size * 2
    return out


def window_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the words at which a window of ``k`` words of one document starts."""
    counts = np.maximum(np.diff(first) - (k - 1), 0)
    base = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return base + np.arange(counts.sum())


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)
