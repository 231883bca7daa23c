"""Importance resampling towards a target distribution over hashed word runs, with a head and a tail vocabulary.

A feature is a run of 1 to ``runs`` consecutive words joined by one space; its bucket is the CRC-32 of its bytes modulo
``BUCKETS``. Totals of the buckets over the corpus and over the target give each bucket a gain; a document's weight is the
sum over its features, and documents are drawn by weight and Gumbel noise.

Head: words are counted over all documents, and of the most frequent ones, up to ``HEAD`` of at most ``WORD_BYTES``
bytes, the finished CRC state is broadcast, for longer runs also the buckets of up to ``HEAD`` most frequent pairs of head
words. A word or pair found there, by its hash and then by its bytes, needs no CRC; a longer run goes on from the
state of its first words. Tail: all others take their CRC directly, byte by byte over many words at once. Both ways give
the same bucket, so totals are exact whatever the head holds. The head is at most some ``HEAD * (WORD_BYTES + 48)`` bytes,
the totals ``BUCKETS`` numbers.

Ranks come from a written, range-sorted copy of the scores with the row counts of its ranges before each, so no task
sorts all documents.

Defined results: null, empty and word-less texts have no features and the weight 0. A row without doc_id counts in the
totals, but has no noise: score and rank null, and it is not among the documents to draw from. Repeated rows are rows of
their own. An empty target or corpus has the totals 0; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm.tables import staged, table, with_columns
from postlake.llm.words import ALPHANUMERIC, Words, per_row, words_of

BUCKETS = 10_000
RUNS = 1
SEED = 2024
MIN_WORDS = 20
DRAWN_PERCENT = 10
HEAD = 1 << 15
WORD_BYTES = 64

_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(_POLYNOMIAL), out >> 1)
    return out.astype(np.uint32)


_TABLE = _crc_table()
_START = np.uint32(0xFFFFFFFF)


def carry_on(states: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 states after the bytes of one span each, all spans a byte at a time."""
    states = states.copy()
    order = np.argsort(starts - ends, kind="stable")  # longest first
    length = (ends - starts)[order]
    alive = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), side="right")
    at, now = starts[order], states[order]
    for k, n in enumerate(alive.tolist()):
        now[:n] = _TABLE[(now[:n] ^ raw[at[:n] + k]) & np.uint32(0xFF)] ^ (now[:n] >> np.uint32(8))
    states[order] = now
    return states


def _spaced(states: np.ndarray) -> np.ndarray:
    return _TABLE[(states ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (states >> np.uint32(8))


def _bucket(states: np.ndarray) -> np.ndarray:
    return ((states ^ _START) % np.uint32(BUCKETS)).astype(np.int64)


class Head:
    """Frequent words with their CRC states, and frequent pairs of them with their buckets."""

    def __init__(self, words: list[str]) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.states = np.zeros(0, np.uint32)
        self.raw, self.starts, self.sizes = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.buckets = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if words:
            found = next(words_of(pa.array([" ".join(words)]), ALPHANUMERIC, lower=False))
            order = np.argsort(found.hashes, kind="stable")
            self.hashes, self.raw = found.hashes[order], found.cased
            self.starts, self.sizes = found.starts[order], (found.ends - found.starts)[order]
            started = np.full(len(order), _START)
            self.states = carry_on(started, found.cased, self.starts, self.starts + self.sizes)

    def find(self, words: Words) -> np.ndarray:
        """The head word that each word is, or -1."""
        if not len(self.hashes):
            return np.full(len(words.hashes), -1)
        at = np.searchsorted(self.hashes, words.hashes)
        at = np.where(at < len(self.hashes), at, 0)
        length = words.ends - words.starts
        same = (self.hashes[at] == words.hashes) & (self.sizes[at] == length)
        out = np.where(same, at, -1)
        rows = np.flatnonzero(same)
        # hashes can agree by chance: compare the bytes as well
        n = length[rows]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        equal = words.cased[np.repeat(words.starts[rows], n) + step] == self.raw[np.repeat(self.starts[at[rows]], n) + step]
        wrong = rows[np.add.reduceat(~equal, np.cumsum(n) - n) > 0] if len(rows) else rows
        out[wrong] = -1
        return out

    def with_pairs(self, pairs: list[int]) -> Head:
        """Also keep the buckets of these pairs, first * words + second."""
        self.pairs = np.sort(np.array(pairs, np.int64))
        first, second = np.divmod(self.pairs, max(1, len(self.hashes)))
        ends = self.starts[second] + self.sizes[second]
        self.buckets = _bucket(carry_on(_spaced(self.states[first]), self.raw, self.starts[second], ends))
        return self

    def pair_keys(self, at: np.ndarray) -> np.ndarray:
        """Key of each word and the next where both are head words, else -1; the last place has none."""
        both = (at[:-1] >= 0) & (at[1:] >= 0)
        return np.where(both, at[:-1] * max(1, len(self.hashes)) + at[1:], -1)


def features(words: Words, head: Head, runs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Start words and buckets of all features, by length of run."""
    at = head.find(words)
    tail = np.flatnonzero(at < 0)
    states = np.zeros(len(at), np.uint32)
    states[at >= 0] = head.states[at[at >= 0]]
    states[tail] = carry_on(np.full(len(tail), _START), words.cased, words.starts[tail], words.ends[tail])
    places = np.arange(len(at))
    yield places, _bucket(states)
    left = np.repeat(words.first[1:], words.counts) - places
    for n in range(2, runs + 1):
        places = places[left[places] >= n]
        last = places + n - 1
        if n == 2 and len(head.pairs) and len(places):
            key = head.pair_keys(at)[places]
            slot = np.searchsorted(head.pairs, key)
            slot = np.where(slot < len(head.pairs), slot, 0)
            known = head.pairs[slot] == key
            out = np.zeros(len(places), np.int64)
            out[known] = head.buckets[slot[known]]
            rest, ends = places[~known], last[~known]
            direct = carry_on(_spaced(states[rest]), words.cased, words.starts[ends], words.ends[ends])
            out[~known] = _bucket(direct)
            if runs > 2:
                states[places] = carry_on(_spaced(states[places]), words.cased, words.starts[last], words.ends[last])
            yield places, out
        else:
            states[places] = carry_on(_spaced(states[places]), words.cased, words.starts[last], words.ends[last])
            yield places, _bucket(states[places])


def _counted(texts: DataFrame, keys_of, schema: str) -> DataFrame:
    """How often the keys of all texts occur (key, n): counted in each batch, then over all of them."""
    feed = texts.select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column(0), ALPHANUMERIC, lower=True):
                key, n = keys_of(words)
                yield pa.RecordBatch.from_arrays([key, pa.array(n, pa.int64())], ["key", "n"])

    return feed.mapInArrow(run, f"key {schema}, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _word_counts(words: Words) -> tuple[pa.Array, np.ndarray]:
    length = words.ends - words.starts
    short = np.flatnonzero(length <= WORD_BYTES)
    _, where, n = np.unique(words.hashes[short], return_index=True, return_counts=True)
    # words of equal hash are counted as one here: that moves the head at most, which needs no exact order
    return pa.array([words.word(i).decode() for i in short[where].tolist()], pa.string()), n


def _most(counts: DataFrame, size: int) -> list:
    """Keys of the most frequent classes, an eighth of a doubling each, that have ``size`` keys at most together. Only
    the class sizes and these keys reach the driver, not the best of every task."""
    counts = staged(counts.withColumn("kind", F.floor(8 * F.log2("n")).cast("int")), "counts")
    lowest, held = None, 0
    for kind, n in sorted(counts.groupBy("kind").agg(F.count("*")).collect(), reverse=True):  # at most 8 x 63
        held += n
        if held > size:
            break
        lowest = kind
    if lowest is None:
        return []
    return [r.key for r in counts.filter(F.col("kind") >= lowest).select("key").collect()]


def frequent(docs: DataFrame, runs: int = RUNS, size: int | None = None) -> Head:
    """The head of ``docs`` (text): bounded in words and bytes, the counts behind it cover all texts."""
    size = HEAD if size is None else size
    head = Head(_most(_counted(docs, _word_counts, "string"), size))
    if runs < 2 or not len(head.hashes):
        return head

    def pairs(words: Words) -> tuple[pa.Array, np.ndarray]:
        inside = words.row_of_word()
        keys = head.pair_keys(head.find(words))[inside[:-1] == inside[1:]]
        key, n = np.unique(keys[keys >= 0], return_counts=True)
        return pa.array(key, pa.int64()), n

    return head.with_pairs(_most(_counted(docs, pairs, "long"), size))


def bucket_totals(texts: DataFrame, head: Head, runs: int = RUNS) -> DataFrame:
    """(bucket, n) over all features of all texts; buckets without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for words in words_of(batch.column(0), ALPHANUMERIC, lower=True):
                for _, buckets in features(words, head, runs):
                    total += np.bincount(buckets, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(spark: SparkSession, corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share of the target over that of the corpus; ``BUCKETS`` whole numbers."""
    corpus = staged(corpus.withColumnRenamed("n", "s"), "totals")
    target = staged(target.withColumnRenamed("n", "t"), "totals")
    all_s, all_t = (df.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for df, c in ((corpus, "s"), (target, "t")))
    every = spark.range(BUCKETS).withColumnRenamed("id", "bucket").join(corpus, "bucket", "left").join(target, "bucket", "left")
    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("s", "t"))
    share = ((t + 1) * F.lit(float(all_s + BUCKETS))) / ((s + 1) * F.lit(float(all_t + BUCKETS)))
    rows = every.select("bucket", F.floor(F.lit(1000.0) * F.ln(share)).alias("gain")).collect()
    out = np.zeros(BUCKETS, np.int64)
    out[[r.bucket for r in rows]] = [r.gain for r in rows]
    return out


def weighted(docs: DataFrame, head: Head, gain: np.ndarray, runs: int = RUNS) -> DataFrame:
    """doc_id, n_features, weight and n_words of every row."""

    def compute(column: pa.Array) -> list[pa.Array]:
        n_features, weight, n_words = [], [], []
        for words in words_of(column, ALPHANUMERIC, lower=True):
            many, sums = np.zeros(words.rows, np.int64), np.zeros(words.rows, np.int64)
            owner = words.row_of_word()
            for places, buckets in features(words, head, runs):
                marks, found = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
                marks[places], found[places] = gain[buckets], 1
                sums += per_row(marks, words.first)
                many += per_row(found, words.first)
            n_features.append(many)
            weight.append(sums)
            n_words.append(words.counts)
        return [pa.array(np.concatenate(c) if c else np.zeros(0), pa.int64()) for c in (n_features, weight, n_words)]

    return with_columns(docs.select("doc_id", "text"), "text", compute, "n_features long, weight long, n_words long", ["doc_id"])


def noise(seed: int = SEED) -> Column:
    """floor(1000 x Gumbel noise) from the hash of seed and doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string"))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    inner = -F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))
    return F.floor(F.lit(-1000.0) * F.ln(inner))


def ranked(scored: DataFrame, percent: int = DRAWN_PERCENT) -> DataFrame:
    """``scored`` (doc_id, n_features, weight, score, eligible) with ``rank``: 1, 2, 3 ... over the best ``percent`` of the
    eligible rows, by score and then smaller doc_id; null for the others."""
    rows = staged(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    eligible = rows.filter("eligible")
    # the row number splits repeated rows, which would be one range else
    split = eligible.repartitionByRange(F.col("score").desc(), F.col("doc_id"), F.col("row"))
    ranges = staged(split.withColumn("range", F.spark_partition_id()).select("range", "score", "doc_id", "row"), "ranges")
    counts = sorted(ranges.groupBy("range").agg(F.count("*")).collect())  # a row for each partition
    n = sum(c for _, c in counts) * percent // 100
    before, starts = 0, []
    for number, c in counts:
        if before < n:
            starts.append((number, before))
        before += c
    offsets = rows.sparkSession.createDataFrame(starts, "range int, before long")
    place = F.row_number().over(Window.partitionBy("range").orderBy(F.col("score").desc(), "doc_id", "row"))
    drawn = ranges.join(F.broadcast(offsets), "range").select("row", (F.col("before") + place).alias("rank"))
    return rows.join(drawn.filter(F.col("rank") <= n), "row", "left").drop("row", "eligible")


def resample(
    docs: DataFrame, target: DataFrame, runs: int = RUNS, seed: int = SEED, percent: int = DRAWN_PERCENT
) -> DataFrame:
    """doc_id, n_features, weight, score and rank for every row of ``docs`` (doc_id, text) towards ``target`` (text)."""
    head = frequent(docs, runs)
    gain = gains(docs.sparkSession, bucket_totals(docs, head, runs), bucket_totals(target, head, runs))
    rows = weighted(docs, head, gain, runs)
    scored = rows.withColumn("score", F.col("weight") + noise(seed)).withColumn(
        "eligible", F.col("doc_id").isNotNull() & (F.col("n_words") >= MIN_WORDS)
    )
    return ranked(scored.drop("n_words"), percent)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawing one in ten towards the benchmark's words."""
    out = resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
