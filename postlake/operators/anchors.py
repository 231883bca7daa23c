"""Words of many texts at once, and which of them are anchors of some phrase.

Texts come in Arrow batches, lower-cased where that matters, and are handled as the bytes of one buffer. What is a word is
asked of Java's patterns once, for every character, so words are those of :func:`postlake.functions.text.token_string`. Words and pairs
of neighbouring words are told by hashes of eight bytes: anything that is no anchor is left out before a string is made
of it. Strings that share a hash are let through, so what is returned is still to be joined by the anchor itself.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from postlake.functions.text import WHITESPACE, not_word

CHUNK_BYTES = 1 << 20
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

# Tasks get this module with the function, so that they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def word_edges(spark: SparkSession, cashtags: bool) -> np.ndarray:
    """Code points at which characters of words begin and end, in turn."""
    return _edges(spark.sparkContext._jvm, not_word(cashtags))


def squeezed(spark: SparkSession, text: Column) -> Column:
    """:func:`postlake.functions.text.normalize_text` of long texts, in Arrow batches."""
    edges = _edges(spark.sparkContext._jvm, f"[{WHITESPACE}]")

    @arrow_udf("string")
    def made(column: pa.Array) -> pa.Array:
        out, row = [], 0
        for t in tokens_of(column, edges):
            rows = len(t.offsets) - 1
            null = column.slice(row, rows).is_null().to_numpy(zero_copy_only=False)
            row += rows
            out.append(pc.if_else(pa.array(null), pa.scalar(None, pa.string()), t.unpadded(null)))
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    return made(text)


@lru_cache(maxsize=4)
def _edges(jvm, pattern: str) -> np.ndarray:
    codes = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], np.uint32)
    every = codes.tobytes().decode("utf-32-le")
    spaced = jvm.java.util.regex.Pattern.compile(pattern).matcher(every).replaceAll(" ")
    inside = np.zeros(0x110001, np.int8)
    inside[codes] = np.frombuffer(spaced.encode("utf-32-le"), np.uint32) == codes
    inside[0x20] = 0  # a space parts words in every pattern used here
    return np.flatnonzero(np.diff(inside, prepend=np.int8(0))).astype(np.uint32)


@dataclass
class Tokens:
    """Texts as words with a space before, between and after them."""

    raw: np.ndarray  # with 16 bytes more than the texts have
    offsets: np.ndarray  # of texts in the bytes, rows + 1
    starts: np.ndarray  # of words in the bytes
    ends: np.ndarray
    first: np.ndarray  # of texts in the words, rows + 1

    def unpadded(self, null: np.ndarray) -> pa.Array:
        """The texts without the spaces at both ends."""
        inner = np.ones(self.offsets[-1], bool)
        inner[self.offsets[:-1][~null]] = False
        inner[self.offsets[1:][~null] - 1] = False
        sizes = np.diff(self.offsets) - np.where(null, 0, 2)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(self.raw[:-16][inner]))

    def hashes(self) -> np.ndarray:
        """Of each word: its first 16 bytes and its length."""
        sizes = self.ends - self.starts
        eight = np.ndarray((len(self.raw) - 7,), "<u8", self.raw, strides=(1,))
        head = eight[self.starts] & _MASKS[np.minimum(sizes, 8)]
        tail = eight[self.starts + 8 * (sizes > 8)] & _MASKS[np.clip(sizes - 8, 0, 8)]
        return _mixed(head * _FACTORS[0] + tail * _FACTORS[1] + sizes.astype(np.uint64))

    def pairs(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words that have a next one in their text, and hashes of both."""
        follows = np.ones(len(hashes), bool)
        ends = self.first[1:]
        follows[ends[ends > 0] - 1] = False
        at = np.flatnonzero(follows)
        return at, _mixed(hashes[at] * _FACTORS[2] + hashes[at + 1])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= _FACTORS[3]
    x ^= x >> np.uint64(32)
    x *= _FACTORS[0]
    return x ^ (x >> np.uint64(29))


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its n + 1 offsets; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def _inside(raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Which bytes belong to words."""
    ascii_class = np.searchsorted(edges, np.arange(256), side="right") % 2 == 1
    ascii_class[128:] = True
    inside = ascii_class[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    first = raw[lead]
    size = 2 + (first >= 0xE0) + (first >= 0xF0)
    code = first.astype(np.uint32) & (0xFF >> (size + 1)).astype(np.uint32)
    for k in (1, 2, 3):
        has = size > k
        code[has] = (code[has] << np.uint32(6)) | (raw[lead[has] + k] & 0x3F)
    gap = np.searchsorted(edges, code, side="right") % 2 == 0
    for k in range(4):
        inside[lead[gap & (size > k)] + k] = False
    return inside


def tokens_of(column: pa.Array, edges: np.ndarray) -> Iterator[Tokens]:
    """Chunks of a column of lower-cased texts, in order; together they hold every row. A longer text is a chunk of its own."""
    raw, offsets = _buffer(column)
    null = column.is_null().to_numpy(zero_copy_only=False)
    row, rows = 0, len(column)
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        stop = min(rows, max(stop, row + 1))
        at = offsets[row : stop + 1]
        yield _chunk(raw[at[0] : at[-1]], at - at[0], null[row:stop], edges)
        row = stop


def _chunk(raw: np.ndarray, offsets: np.ndarray, null: np.ndarray, edges: np.ndarray) -> Tokens:
    n = len(raw)
    inside = np.zeros(n + 1, bool)
    inside[:n] = _inside(raw, edges)
    before, after = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    sizes = np.flatnonzero(inside & ~after) + 1 - starts
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)
    more = np.where(null, 0, np.where(counts > 0, 1, 2))  # spaces besides the one before each word
    skipped = np.repeat(np.concatenate([[0], np.cumsum(more)[:-1]]), counts)
    starts = np.cumsum(sizes) - sizes + np.arange(1, len(sizes) + 1) + skipped
    ends = starts + sizes
    length = np.concatenate([[0], np.cumsum(sizes)])
    padded = np.concatenate([[0], np.cumsum(length[first[1:]] - length[first[:-1]] + counts + more)])
    filled = np.ones(padded[-1], bool)
    filled[starts - 1] = False
    filled[padded[1:][more > 0] - 1] = False
    filled[padded[1:][more > 1] - 2] = False
    out = np.full(padded[-1] + 16, 0x20, np.uint8)
    out[:-16][filled] = raw[inside[:n]]
    return Tokens(out, padded, starts, ends, first)


def _strings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = raw[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


class Wanted:
    """A set of hashes. Most of what is not in it is told by one look into a table."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        bits = min(24, max(12, 4 + len(self.hashes).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self.hashes >> self.shift] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.table[hashes >> self.shift])
        found = np.searchsorted(self.hashes, hashes[at])
        return at[self.hashes[np.minimum(found, len(self.hashes) - 1)] == hashes[at]] if len(self.hashes) else at[:0]


def anchors_in(tokens: Tokens, wanted: Wanted, pairs: bool) -> pa.Array:
    """For each text those of its words, and pairs of neighbouring words, whose hash is wanted; an anchor may come twice."""
    hashes = tokens.hashes()
    at = wanted.places(hashes)
    word, starts, ends = at, tokens.starts[at], tokens.ends[at]
    if pairs:
        places, both = tokens.pairs(hashes)
        at = places[wanted.places(both)]
        word = np.concatenate([word, at])
        order = np.argsort(word, kind="stable")
        starts = np.concatenate([starts, tokens.starts[at]])[order]
        ends = np.concatenate([ends, tokens.ends[at + 1]])[order]
        word = word[order]
    return pa.ListArray.from_arrays(np.searchsorted(word, tokens.first).astype(np.int32), _strings(tokens.raw, starts, ends))


def anchor_hashes(column: pa.Array) -> np.ndarray:
    """Hashes of anchors, which are one word or two words with a space between."""
    edges = np.array([0x21], np.uint32)  # an anchor's words are what stands between spaces
    out = [np.zeros(0, np.uint64)]
    for tokens in tokens_of(column, edges):
        hashes = tokens.hashes()
        made = np.zeros(len(tokens.first) - 1, np.uint64)
        counts = np.diff(tokens.first)
        made[counts == 1] = hashes[tokens.first[:-1][counts == 1]]
        at, both = tokens.pairs(hashes)
        made[np.searchsorted(tokens.first, at, side="right") - 1] = both
        out.append(made)
    return np.concatenate(out)


def wanted_hashes(anchors: DataFrame) -> np.ndarray:
    """Hashes of a column of anchors: eight bytes each, of a table that was measured to be small enough to broadcast."""

    @arrow_udf("long")
    def hashed(column: pa.Array) -> pa.Array:
        return pa.array(anchor_hashes(column).view(np.int64))

    name = anchors.columns[0]
    made = anchors.where(F.col(name).isNotNull()).select(hashed(name).alias("h")).distinct().toArrow()
    return made.column("h").to_numpy().view(np.uint64)


def found_words(spark: SparkSession, text: Column, cashtags: bool, hashes: np.ndarray) -> Column:
    """Wanted words of a text, as often as they occur."""
    edges, wanted = word_edges(spark, cashtags), Wanted(hashes)

    @arrow_udf("array<string>")
    def found(column: pa.Array) -> pa.Array:
        made = [anchors_in(t, wanted, False) for t in tokens_of(column, edges)]
        return pa.concat_arrays(made) if made else pa.array([], pa.list_(pa.string()))

    return found(F.lower(text))


def found_anchors(spark: SparkSession, text: Column, cashtags: bool, hashes: np.ndarray) -> Column:
    """(padded, anchors): :func:`postlake.functions.text.padded_tokens` and the wanted words and pairs in it, as often as they occur."""
    edges, wanted = word_edges(spark, cashtags), Wanted(hashes)
    kind = pa.struct([("padded", pa.string()), ("anchors", pa.list_(pa.string()))])

    @arrow_udf("padded string, anchors array<string>")
    def found(column: pa.Array) -> pa.Array:
        made, null, row = [], column.is_null(), 0
        for t in tokens_of(column, edges):
            rows = len(t.offsets) - 1
            is_null = pa.array(null.slice(row, rows).to_numpy(zero_copy_only=False), pa.bool_())
            row += rows
            padded = pa.StringArray.from_buffers(rows, pa.py_buffer(t.offsets.astype(np.int32)), pa.py_buffer(t.raw))
            padded = pc.if_else(is_null, pa.scalar(None, pa.string()), padded)
            made.append(pa.StructArray.from_arrays([padded, anchors_in(t, wanted, True)], fields=list(kind)))
        return pa.concat_arrays(made) if made else pa.array([], kind)

    return found(F.lower(text))
