"""Words of many texts at once: byte classes, positions and 64-bit hashes over Arrow columns.

Texts are handled as the bytes of one buffer. Both word classes used here are unions of whole UTF-8
characters (every byte from 0x80 is a word byte), so byte positions give the words of the code points.
Batches are cut into chunks of about ``CHUNK_BYTES``; a longer text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Anything but the six white-space characters of ASCII.
BETWEEN_SPACES = ~np.isin(_BYTES, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: Digits, lower-case ASCII letters and every character beyond ASCII.
ALPHANUMERIC = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.default_rng(20240207).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * CHUNK_BYTES)
        _powers = np.full(size, _BASE, np.uint64)
        _inverses = np.full(size, _BASE_INVERSE, np.uint64)
        _powers[0] = _inverses[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
        np.multiply.accumulate(_inverses, out=_inverses)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit keys over the whole key."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its n + 1 offsets; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


@dataclass
class Words:
    """Words of the texts ``first_row`` up to ``first_row + rows`` of a batch."""

    first_row: int
    raw: np.ndarray  # bytes as given
    offsets: np.ndarray  # of texts in the bytes, rows + 1
    starts: np.ndarray  # of words in the bytes
    ends: np.ndarray
    first: np.ndarray  # of texts in the words, rows + 1
    hashes: np.ndarray
    sums: np.ndarray  # running hash sums over the bytes, to hash other spans
    cased: np.ndarray  # bytes after lowering, if any

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte spans."""
        _, inverses = _tables(len(self.raw) + 1)
        return mix((self.sums[ends] - self.sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each place, and which places have n words left in their text."""
        total = len(self.hashes)
        out = np.zeros(total, np.uint64)
        for k in range(n):
            out[: max(0, total - k)] += self.hashes[k:] * np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64))
        left = np.repeat(self.first[1:], self.counts) - np.arange(total)
        return mix(out), left >= n

    def word(self, i: int) -> bytes:
        return self.cased[self.starts[i] : self.ends[i]].tobytes()


def per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of an array within consecutive ranges, empty ones included."""
    total = np.zeros(len(marks) + 1, np.float64 if marks.dtype.kind == "f" else np.int64)
    np.cumsum(marks, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def words_of(column: pa.Array, kind: np.ndarray, lower: bool) -> Iterator[Words]:
    """Chunks of a string column, in order; together they hold every row."""
    raw, offsets = text_buffer(column)
    row, rows = 0, len(column)
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        stop = min(rows, max(stop, row + 1))
        yield _chunk(row, raw[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], kind, lower)
        row = stop


def _chunk(first_row: int, raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool) -> Words:
    n = len(raw)
    powers, _ = _tables(n + 1)
    cased = LOWER[raw] if lower else raw
    inside = np.zeros(n + 1, bool)
    inside[:n] = kind[cased]
    before, after = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets] = False
    if n:
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODES[cased] * powers[:n], out=sums[1:])
    words = Words(first_row, raw, offsets, starts, ends, np.searchsorted(starts, offsets), starts, sums, cased)
    words.hashes = words.spans(starts, ends)
    return words
