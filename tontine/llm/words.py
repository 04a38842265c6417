"""Words and word hashes of UTF-8 texts, vectorised over Arrow buffers.

A word is a longest run of bytes other than space and ``\\t\\n\\v\\f\\r``
(``[^\\x20\\x09-\\x0D]+``; the separators are ASCII, so bytes and characters
agree).  Hashes are 64-bit, fixed by seeds, and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=_U)
_BYTE[SEPARATOR] = 0                                  # separators add nothing to a word's sum
_BASE = _U(int(_rng.integers(2**62, 2**63)) * 2 + 1)
_COEF = _rng.integers(2**62, 2**63, (2, 4096), dtype=_U) * _U(2) + _U(1)
_powers = np.ones(1, _U)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 256)
        _powers = np.concatenate([np.ones(1, _U), np.cumprod(np.full(size - 1, _BASE))])
    return _powers


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (rows + 1) of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` together (a longer row alone), so that the
    arrays made per byte stay small whatever the Arrow batch holds."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def _scan(data: np.ndarray, offsets: np.ndarray, lower: bool, hashes: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Start, end and hash of every word."""
    inside = ~SEPARATOR[data]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]  # words never reach over a row's end
    begin[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    if not hashes or not len(start):
        return start, end, np.empty(0, _U)
    at = int(start[0])
    reach = np.diff(np.append(start, len(data)))
    place = np.arange(at, len(data)) - np.repeat(start, reach)
    value = _BYTE[(_LOWER[data] if lower else data)[at:]] * _powers_to(int(reach.max()))[place]
    return start, end, mix(np.add.reduceat(value, start - at) + (end - start).astype(_U))


class Words:
    """Word spans of some rows: byte ``start``/``end`` per word, and ``first[r]`` to
    ``first[r + 1]`` are the words of row r.  ``hash`` has one 64-bit value a word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashes: bool = True):
        self.data = data[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        starts, ends, values = [], [], []
        for lo, hi in row_slices(offsets, 1 << 18):        # arrays made per byte stay in the CPU's cache
            at = offsets[lo]
            start, end, value = _scan(self.data[at:offsets[hi]], offsets[lo:hi + 1] - at, lower, hashes)
            starts.append(start + at)
            ends.append(end + at)
            values.append(value)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        self.start, self.end = join(starts, np.int64), join(ends, np.int64)
        self.hash = join(values, _U) if hashes else None
        self.first = np.searchsorted(self.start, offsets)

    def row_of(self, word: np.ndarray) -> np.ndarray:
        """Rows of words given by number."""
        return np.searchsorted(self.first, word, side="right") - 1

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def position(self) -> np.ndarray:
        """Place of each word in its row, from 0."""
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], np.diff(self.first))

    def fits(self, width: int) -> np.ndarray:
        """Words at which ``width`` words of the same row begin."""
        counts = np.diff(self.first)
        return self.position() + width <= np.repeat(counts, counts)

    def windows(self, width: int, lane: int = 0) -> np.ndarray:
        """Hash of the ``width`` words from each word on; valid where ``fits(width)``.
        The two lanes are independent."""
        n = len(self.hash)
        out = np.zeros(n, _U)
        for k in range(min(width, n)):
            out[:n - k] += self.hash[k:] * _COEF[lane, k]
        return mix(out + _U(width))

    def shingles(self, width: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the word shingles, row by row, and the row offsets into them.  A row of
        fewer words has its whole sequence as one shingle; a row without words has none."""
        counts = np.diff(self.first)
        keep = self.fits(width)
        out = self.windows(width, lane)
        for n in range(1, width):
            short = self.first[:-1][counts == n]
            if len(short):
                total = np.zeros(len(short), _U)
                for k in range(n):
                    total += self.hash[short + k] * _COEF[lane, k]
                out[short] = mix(total + _U(n))
                keep[short] = True
        sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        return out[keep], np.concatenate([[0], np.cumsum(sizes)])
