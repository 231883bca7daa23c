"""Quality rules: stated counts and a logistic regression over hashed word and character n-grams.

The model is trained on a bounded sample of labelled rows (``train_rows``), calibrated by Platt's method on rows kept
aside, and scored in Arrow batches. A text is kept if no stated rule fails and its probability reaches a fixed
threshold. Scoring a text needs the mean weight of each family of n-grams, so no counts are kept per text.

Defined results: a null or empty text has no words, fails the word rule and is not kept. Repeated rows and equal
doc_ids each get their own row; a null doc_id is carried along. Without labelled rows of both classes the model gives
0.5 to every text, which meets the threshold, so only the stated rules decide. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.tables import table, with_columns
from postlake.llm.words import BETWEEN_SPACES, Words, mix, per_row, words_of

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
KEEP_PROBABILITY = 0.5
TRAIN_ROWS = 1500
FIT_ROWS = 256  # rows of a block while fitting
BUCKETS = 1 << 14
FAMILIES = 5  # words, word pairs, 3 and 4 characters, which of three words in a row are equal

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "probability double, kept boolean"
)


def stated_counts(words: Words) -> dict[str, np.ndarray]:
    """The counts of the stated rules for each text of a chunk."""
    raw, n = words.raw, words.counts
    inside = BETWEEN_SPACES[raw]
    out = {
        "n_words": n,
        "word_chars": per_row(inside & ((raw & 0xC0) != 0x80), words.offsets),
        "n_symbols": per_row(_SYMBOL[raw], words.offsets),
    }
    out["n_dup_lines"] = _repeated_lines(words)
    out["n_repeat_words"] = _words_in_repeats(words)
    return out


def _repeated_lines(words: Words) -> np.ndarray:
    breaks = np.flatnonzero(words.raw == 0x0A)
    ends = np.concatenate([breaks, words.offsets[1:]])
    row = np.concatenate([row_of(words, breaks), np.arange(words.rows)])
    order = np.lexsort((ends, row))
    ends, row = ends[order], row[order]
    starts = words.offsets[row]
    follows = np.flatnonzero(row[1:] == row[:-1]) + 1
    starts[follows] = ends[follows - 1] + 1
    filled = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    row, starts, ends = row[filled], starts[filled], ends[filled]
    key = mix(words.spans(starts, ends) + mix(row.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return np.bincount(row[again], minlength=words.rows)


def row_of(words: Words, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(words.offsets, at, side="right") - 1


def _words_in_repeats(words: Words) -> np.ndarray:
    keys, whole = words.runs(REPEAT_WINDOW)
    at = np.flatnonzero(whole)
    row = words.row_of_word()
    key = mix(keys[at] + mix(row[at].astype(np.uint64) + np.uint64(1)))
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    found = at[count[back] > 1]
    edge = np.zeros(len(row) + 1, np.int64)
    np.add.at(edge, found, 1)
    np.subtract.at(edge, found + REPEAT_WINDOW, 1)
    return per_row(np.cumsum(edge[:-1]) > 0, words.first)


def ngrams(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family the buckets of its n-grams in text order and how many each text has."""
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    pairs, paired = words.runs(2)
    h = words.hashes
    row = words.row_of_word()
    same = np.zeros(len(h), np.int64)
    for back in (1, 2):
        same[back:] += back * ((h[back:] == h[:-back]) & (row[back:] == row[:-back]))
    out = [
        (h >> shift, words.counts),
        (pairs[paired] >> shift, np.maximum(words.counts - 1, 0)),
    ]
    chars, first = _characters(words)
    lengths = np.diff(first)
    left = np.repeat(first[1:], lengths) - np.arange(len(chars))
    for n, factor in ((3, 0x9E3779B1), (4, 0x85EBCA77)):
        key = np.zeros(len(chars), np.uint32)
        for k in range(n):
            key[: max(0, len(chars) - k)] += chars[k:] * np.uint32(pow(factor, k + 1, 1 << 32))
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x2C1B3C6D)
        key = key[left >= n] >> np.uint32(33 - BUCKETS.bit_length())
        out.append((key, np.maximum(lengths - n + 1, 0)))
    out.append((same, words.counts))
    return out


def _characters(words: Words) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])[words.offsets]
    return np.frombuffer(words.raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), first


@dataclass
class Model:
    weights: np.ndarray  # families x buckets
    bias: float
    slope: float = 1.0  # Platt's calibration of the margin
    shift: float = 0.0

    def probabilities(self, words: Words) -> np.ndarray:
        margin = np.full(words.rows, self.bias)
        for family, (bucket, count) in enumerate(ngrams(words)):
            first = np.concatenate([[0], np.cumsum(count)])
            margin += per_row(self.weights[family][bucket], first) / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def sparse_row(column: pa.Array) -> list[pa.Array]:
    """Buckets (family * BUCKETS + bucket) and their shares for each text."""
    ids, shares = [], []
    for words in words_of(column, BETWEEN_SPACES, lower=False):
        found = [[] for _ in range(words.rows)]
        for family, (bucket, count) in enumerate(ngrams(words)):
            first = np.concatenate([[0], np.cumsum(count)])
            for i in np.flatnonzero(count):
                b, c = np.unique(bucket[first[i] : first[i + 1]], return_counts=True)
                found[i].append((b.astype(np.int32) + family * BUCKETS, (c / count[i]).astype(np.float32)))
        for parts in found:
            ids.append(np.concatenate([p[0] for p in parts]).tobytes() if parts else b"")
            shares.append(np.concatenate([p[1] for p in parts]).tobytes() if parts else b"")
    return [pa.array(ids, pa.binary()), pa.array(shares, pa.binary())]


def labelled_sample(labels: DataFrame, docs: DataFrame, train_rows: int) -> DataFrame:
    """At most ``train_rows`` labelled texts outside the held-out fold, chosen by a hash of their ids."""
    chosen = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND crc32(CAST(doc_id AS STRING)) % 4 <> 2")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by train_rows


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, rounds: int = 60) -> Model | None:
    sample = with_columns(
        labelled_sample(labels, docs, train_rows), "text", sparse_row, "ids binary, shares binary", ["doc_id", "quality"]
    )
    rows = sample.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("ids", "shares")).limit(train_rows).collect()
    label = np.array([r.quality for r in rows], float)
    if len(set(label)) < 2:
        return None
    ids = [np.frombuffer(r.ids, np.int32) for r in rows]
    shares = [np.frombuffer(r.shares, np.float32) for r in rows]
    aside = np.arange(len(rows)) % 5 == 4
    if len(set(label[aside])) < 2 or len(set(label[~aside])) < 2:
        aside[:] = False
    model = _fit([i for i, a in zip(ids, aside) if not a], [s for s, a in zip(shares, aside) if not a], label[~aside], rounds)
    if aside.any():
        flat = model.weights.ravel()
        margin = np.array([model.bias + flat[i] @ s for i, s, a in zip(ids, shares, aside) if a])
        model.slope, model.shift = platt(margin, label[aside])
    return model


def _blocks(ids: list, shares: list) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """The rows in blocks: which rows, where each begins, columns and shares. A block's arrays are all that is copied."""
    for at in range(0, len(ids), FIT_ROWS):
        some = slice(at, at + FIT_ROWS)
        first = np.concatenate([[0], np.cumsum([len(i) for i in ids[some]])])
        yield some, first, np.concatenate(ids[some]), np.concatenate(shares[some])


def _fit(ids: list, shares: list, label: np.ndarray, rounds: int, decay: float = 1e-3, rate: float = 0.05) -> Model:
    """Logistic loss by Adam over all rows; a column is scaled by its root mean square, rare columns are damped."""
    size, n = FAMILIES * BUCKETS, len(label)
    squares = np.zeros(size)
    for _, _, column, share in _blocks(ids, shares):
        squares += np.bincount(column, share.astype(np.float64) ** 2, size)
    rms = np.sqrt(squares / n)
    scale = 1 / (rms + 0.05 * rms.max() + 1e-9)
    w, b = np.zeros(size), float(np.log(label.mean() / (1 - label.mean())))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, rounds + 1):
        g, gb = decay * w / n, 0.0
        for some, first, column, share in _blocks(ids, shares):
            value = share * scale[column]
            p = 1 / (1 + np.exp(-np.clip(b + per_row(value * w[column], first), -500, 500)))
            error = (p - label[some]) / n
            g += np.bincount(column, value * np.repeat(error, np.diff(first)), size)
            gb += error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix, fix2 = 1 - 0.9**t, 1 - 0.999**t
        w -= rate * (m / fix) / (np.sqrt(v / fix2) + 1e-8)
        b -= rate * (mb / fix) / (np.sqrt(vb / fix2) + 1e-8)
    return Model((w * scale).astype(np.float32).reshape(FAMILIES, BUCKETS), float(b))


def platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins, with Platt's smoothed targets."""
    good, bad = label.sum(), len(label) - label.sum()
    target = np.where(label == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))
        g = np.array([np.sum((p - target) * margin) + 1e-3 * (a - 1), np.sum(p - target)])
        s = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[np.sum(s * margin**2) + 1e-3, np.sum(s * margin)], [np.sum(s * margin), np.sum(s) + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 0.05), float(b)


def judge(column: pa.Array, model: Model | None, threshold: float = KEEP_PROBABILITY) -> list[pa.Array]:
    """``FIELDS`` for each text."""
    parts: list[list[np.ndarray]] = []
    for words in words_of(column, BETWEEN_SPACES, lower=False):
        counts = stated_counts(words)
        n, repeats = counts["n_words"], counts["n_repeat_words"]
        failed = (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)
        p = model.probabilities(words) if model else np.full(words.rows, 0.5)
        parts.append([*counts.values(), failed, p, ~failed & (p >= threshold)])
    return [pa.array(np.concatenate(x)) for x in zip(*parts)]


def judged(docs: DataFrame, model: Model | None, keep: list[str], threshold: float = KEEP_PROBABILITY) -> DataFrame:
    return with_columns(docs, "text", lambda column: judge(column, model, threshold), FIELDS, keep)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, the stated counts, base_failed, probability, kept."""
    docs = table(spark, sf_dir, "documents")
    return judged(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with the columns they came with."""
    model = train(docs, table(spark, sf_dir, "labels"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    plain = docs.toDF(*names)  # clash-free
    out = with_columns(plain, text, lambda column: judge(column, model), FIELDS).filter("kept")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
