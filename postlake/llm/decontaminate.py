"""Benchmark passages in documents by Wu-Manber search over words.

A pattern is a window of ``WINDOW`` consecutive words of an item, or a shorter item as a whole. Patterns of one length
share tables: the block shift table (two words to a block) says how far a block lies at least from a pattern's end, so
reading one block in every ``length - 1`` proves stretches without a match and skips them; where a stretch may hold a
match, a zero shift marks possible ends, the suffix-hash bucket names the patterns that end so, and the words
themselves are compared.

Items are loaded in parts of at most ``PART_BYTES`` of text. Every part is one pass over the documents in the same
stage, carrying the hits along, so a large benchmark needs neither a shuffle nor one large table in memory.

Defined results: a null or empty text, or one without words, has no words and is clean. Items that are null, empty or
without words match nothing; an item without an id counts under the id "null"; repeated items count once. An empty
benchmark leaves every document clean. Repeated documents and null ids keep their rows; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlake.llm.tables import table
from postlake.llm.words import ALPHANUMERIC, Words, mix, words_of

WINDOW = 13
PART_BYTES = 4 << 20
MIN_HIT_SHARE = 20  # one word in so many
_TABLE_BITS = (16, 22)  # the least and the most; a table in use has some eight slots to a block

FIELDS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class LengthTables:
    """Shift table and suffix buckets of all patterns of ``length`` words."""

    def __init__(self, length: int, words: Words, at: np.ndarray, item: np.ndarray) -> None:
        self.length = length
        self.block = min(2, length)
        self.stride = length - self.block + 1
        wanted = (8 * len(at) * min(self.stride, 2)).bit_length()
        self.bits = np.uint64(64 - min(max(wanted, _TABLE_BITS[0]), _TABLE_BITS[1]))
        self.shift = np.full(1 << (64 - int(self.bits)), self.stride, np.uint8)
        for j in range(self.stride):
            slot = self._slots(self.blocks(words.hashes, at + j))
            np.minimum.at(self.shift, slot, self.stride - 1 - j)
        suffix = self.blocks(words.hashes, at + self.stride - 1)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.at, self.item = suffix[order], at[order], item[order]

    def blocks(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        if self.block == 1:
            return hashes[at]
        return mix(hashes[at] * np.uint64(0xD6E8FEB86659FD93) + hashes[at + 1] * np.uint64(0xA0761D6478BD642F))

    def _slots(self, blocks: np.ndarray) -> np.ndarray:
        return blocks >> self.bits

    def possible(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places whose last block ends some pattern: start word, and the range of patterns in that bucket."""
        last = len(words.hashes) - self.block  # last block start
        if last < 0 or not len(self.suffix):
            return (np.zeros(0, np.int64),) * 3
        read = np.arange(0, last + 1, self.stride)
        near = read[self.shift[self._slots(self.blocks(words.hashes, read))] < self.stride]
        ends = (near[:, None] + np.arange(self.stride)[None, :]).ravel()
        ends = ends[ends <= last]
        blocks = self.blocks(words.hashes, ends)
        zero = self.shift[self._slots(blocks)] == 0
        ends, blocks = ends[zero], blocks[zero]
        low, high = np.searchsorted(self.suffix, blocks), np.searchsorted(self.suffix, blocks, side="right")
        start = ends - self.stride + 1
        row = np.searchsorted(words.first, ends, side="right") - 1
        fits = (low < high) & (start >= words.first[row]) & (start + self.length <= words.first[row + 1])
        return start[fits], low[fits], high[fits]


class Patterns:
    """All patterns of one part of the items."""

    def __init__(self, ids: list[str], texts: list[str | None]) -> None:
        self.ids = ids
        self.tables: list[LengthTables] = []
        self.spelled: list[bytes] = []
        self.chunks: list[int] = []
        for words in words_of(pa.array(texts, pa.string()), ALPHANUMERIC, lower=True):
            self._add(words)

    def _add(self, words: Words) -> None:
        spelled = [words.word(i) for i in range(len(words.hashes))]
        base = len(self.spelled)
        self.spelled += spelled
        lengths = np.minimum(words.counts, WINDOW)
        for length in np.unique(lengths[lengths > 0]):
            rows = np.flatnonzero(lengths == length)
            counts = words.counts[rows] - length + 1
            item = np.repeat(rows, counts)
            at = np.concatenate([words.first[r] + np.arange(c) for r, c in zip(rows, counts)])
            self.tables.append(LengthTables(int(length), words, at, item + words.first_row))
            self.chunks.append(base)

    def search(self, words: Words, mark: np.ndarray, items: list[set]) -> None:
        """Add hit words to ``mark`` (differences at the ends of stretches) and item ids to ``items``."""
        for tables, base in zip(self.tables, self.chunks):
            starts, low, high = tables.possible(words)
            rows = np.searchsorted(words.first, starts, side="right") - 1
            for start, row, a, b in zip(starts.tolist(), rows.tolist(), low.tolist(), high.tolist()):
                found = [words.word(i) for i in range(start, start + tables.length)]
                hit = False
                for p in range(a, b):
                    at = base + int(tables.at[p])
                    if self.spelled[at : at + tables.length] == found:
                        items[row].add(self.ids[tables.item[p]])
                        hit = True
                if hit:
                    mark[start] += 1
                    mark[start + tables.length] -= 1


def item_parts(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> list[Patterns]:
    """Patterns of all items, one entry for each part of about ``part_bytes``."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.col("text")
    ).filter(F.length("text") > 0)
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    out = []
    for k in range(parts):
        part = items if parts == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        rows = part.distinct().collect()  # at most about part_bytes
        rows.sort(key=lambda r: (r.item_id, r.text))
        out.append(Patterns([r.item_id for r in rows], [r.text for r in rows]))
    return out


_CARRIED = "_hits array<int>, _items array<string>, _n_words long"


def _pass(df: DataFrame, text: str, patterns: Patterns, first: bool) -> DataFrame:
    """One part over the documents; hits (pairs of first word and end) and items join those carried along."""
    names = df.columns if first else df.columns[:-3]
    schema = StructType([*df.schema.fields[: len(names)], *StructType.fromDDL(_CARRIED).fields])
    at = names.index(text)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            old_hits = None if first else batch.column(len(names)).to_pylist()
            old_items = None if first else batch.column(len(names) + 1).to_pylist()
            hits, items, n_words = [], [], []
            for words in words_of(batch.column(at), ALPHANUMERIC, lower=True):
                mark = np.zeros(len(words.hashes) + 1, np.int32)
                found = [set() for _ in range(words.rows)]
                patterns.search(words, mark, found)
                for i in range(words.rows):
                    low = int(words.first[i])
                    if not first:
                        row = words.first_row + i
                        found[i].update(old_items[row])
                        for a, b in zip(old_hits[row][::2], old_hits[row][1::2]):
                            mark[low + a] += 1
                            mark[low + b] -= 1
                    hits.append([])
                    items.append(sorted(found[i]))
                covered = np.concatenate([[0], (np.cumsum(mark[:-1]) > 0).astype(np.int8), [0]])
                edge = np.diff(covered)
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                # stretches of neighbouring texts can touch, so cut them at the first words of texts
                row = np.searchsorted(words.first, begin, side="right") - 1
                for a, b, r in zip(begin.tolist(), end.tolist(), row.tolist()):
                    while a < b:
                        stop = min(b, int(words.first[r + 1]))
                        if stop > a:
                            low = int(words.first[r])
                            hits[words.first_row + r] += [a - low, stop - low]
                        a, r = max(a, stop), r + 1
                n_words += words.counts.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(names)],
                    pa.array(hits, pa.list_(pa.int32())),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(n_words, pa.int64()),
                ],
                [*names, "_hits", "_items", "_n_words"],
            )

    return df.mapInArrow(run, schema)


def searched(docs: DataFrame, text: str, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with hit stretches of words, item ids and the count of words of each text."""
    out = docs
    for k, patterns in enumerate(item_parts(benchmark, part_bytes)):
        out = _pass(out, text, patterns, first=k == 0)
    return out


def n_hit() -> F.Column:
    odd = F.aggregate("_hits", F.lit(0).cast("long"), lambda a, x: x - a)  # alternating sum: ends less starts
    return odd.alias("n_hit")


def contaminated() -> F.Column:
    return (n_hit() > 0) & (MIN_HIT_SHARE * n_hit() >= F.col("_n_words"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: words, hit words, items, their digest, verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = searched(docs, "text", table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        n_hit(),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("_items")), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, with the columns they came with."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    found = searched(docs.toDF(*names), names[docs.columns.index("text")], table(spark, sf_dir, "benchmark"))
    return found.filter(~contaminated()).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
