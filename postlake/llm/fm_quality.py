"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Inputs of a text: its hashed lower-cased words, each weighing its share of the text; statistics of its structure; and
metadata of the document, its length in bytes and in lines. With ``rank`` factors v per input the score is the logistic
of  bias + sum w x + 1/2 sum_f ((sum v x)^2 - sum v^2 x^2),  linear in the number of inputs. Labels, language, source
and ids are no inputs; rows of the held-out fold (crc32(doc_id as text) mod 4 = 2) are never learned from.

The model is fitted on the driver on at most ``TRAIN_ROWS`` labelled rows, chosen by a hash of their ids; scoring runs
in Arrow batches.

Defined results: null and empty texts have no words and are scored by bias and statistics. Repeated rows keep their
rows; a null doc_id is scored, its held_out being null. Without labelled rows of both classes every score is the share
of label 1, or 0.5 without labels. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.quality_rules import labelled_sample
from postlake.llm.tables import table, with_columns
from postlake.llm.words import BETWEEN_SPACES, Words, mix, per_row, words_of

TRAIN_ROWS = 3000
BUCKETS = 1 << 14
RANK = 6
THRESHOLD = 0.7
#: Offset of the structure and metadata inputs behind the words.
DENSE = 10


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # buckets + DENSE
    factors: np.ndarray  # buckets + DENSE x rank
    mean: np.ndarray  # of the dense inputs
    spread: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        rows, count, bucket, share = word_inputs(words)
        first = np.concatenate([[0], np.cumsum(count)])
        dense = (statistics(words) - self.mean) / self.spread
        dense = np.clip(dense, -5, 5)
        total = self.bias + per_row(self.linear[bucket] * share, first) + dense @ self.linear[BUCKETS:]
        for f in range(self.factors.shape[1]):
            v = self.factors[bucket, f] * share
            dv = dense * self.factors[BUCKETS:, f]
            total += 0.5 * ((per_row(v, first) + dv.sum(axis=1)) ** 2 - per_row(v * v, first) - (dv * dv).sum(axis=1))
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def word_inputs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, bucket) in order: text, how many each text has, bucket, share of the text's words."""
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    key = (words.row_of_word().astype(np.uint64) << np.uint64(20)) | (words.hashes >> shift)
    key, n = np.unique(key, return_counts=True)
    row = (key >> np.uint64(20)).astype(np.int64)
    bucket = (key & np.uint64((1 << 20) - 1)).astype(np.int64)
    return row, np.bincount(row, minlength=words.rows), bucket, np.sqrt(n / np.maximum(words.counts, 1)[row])


def statistics(words: Words) -> np.ndarray:
    """Structure (shares of kinds of characters and words) and metadata (sizes), a row for each text."""
    raw, offsets, n = words.raw, words.offsets, words.counts
    size = np.maximum(np.diff(offsets), 1)
    some = np.maximum(n, 1)
    row = words.row_of_word()
    again = np.zeros(len(row), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
    _, first = np.unique(mix(words.hashes + mix(row.astype(np.uint64) + np.uint64(1))), return_index=True)
    new = np.zeros(len(row), bool)
    new[first] = True

    def share(mask: np.ndarray) -> np.ndarray:
        return per_row(mask, offsets) / size

    lines = per_row(raw == 0x0A, offsets) + 1
    return np.stack(
        [
            share((raw >= 65) & (raw <= 90)),
            share((raw >= 48) & (raw <= 57)),
            np.sqrt(share(np.isin(raw, np.frombuffer(b"#*$%&|<>", np.uint8)))),
            np.sqrt(share(np.isin(raw, np.frombuffer(b"!?", np.uint8)))),
            share((raw == 0x2E) | (raw == 0x2C)),
            per_row(again, words.first) / some,
            per_row(new, words.first) / some,
            per_row((words.ends - words.starts), words.first) / some / 10,
            np.log1p(size),
            np.log1p(lines),
        ],
        axis=1,
    )


def inputs(column: pa.Array) -> list[pa.Array]:
    ids, shares, dense = [], [], []
    for words in words_of(column, BETWEEN_SPACES, lower=True):
        _, count, bucket, share = word_inputs(words)
        cut = np.cumsum(count)[:-1]
        ids += [x.astype(np.int32).tobytes() for x in np.split(bucket, cut)]
        shares += [x.astype(np.float32).tobytes() for x in np.split(share, cut)]
        dense += list(statistics(words))
    return [pa.array(ids, pa.binary()), pa.array(shares, pa.binary()), pa.array(dense, pa.list_(pa.float64()))]


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, epochs: int = 12) -> Model | float:
    """The fitted model, or the share of label 1 where one class is missing."""
    sample = with_columns(
        labelled_sample(labels, docs, train_rows),
        "text",
        inputs,
        "ids binary, shares binary, dense array<double>",
        ["doc_id", "quality"],
    )
    rows = sample.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("ids", "shares")).limit(train_rows).collect()
    label = np.array([r.quality for r in rows], float)
    if len(set(label)) < 2:
        return float(label.mean()) if len(label) else 0.5
    dense = np.array([r.dense for r in rows])
    mean, spread = dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-6)
    dense = np.clip((dense - mean) / spread, -5, 5)
    sparse = [(np.frombuffer(r.ids, np.int32), np.frombuffer(r.shares, np.float32)) for r in rows]
    linear, factors, bias = _fit(sparse, dense, label, epochs)
    return Model(bias, linear, factors, mean, spread)


def _fit(sparse: list, dense: np.ndarray, label: np.ndarray, epochs: int, batch: int = 100, rate: float = 0.02):
    """Adam on the logistic loss with batches in a fixed random order; weights shrink a little at every step."""
    random = np.random.default_rng(5)
    size = BUCKETS + DENSE
    bias = float(np.log(label.mean() / (1 - label.mean())))
    theta = np.concatenate([np.zeros((size, 1)), random.normal(0, 0.05, (size, RANK))], axis=1)
    m, v, mb, vb, t = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0, 0
    extra = np.arange(BUCKETS, size, dtype=np.int32)
    sparse = [(np.concatenate([i, extra]), np.concatenate([x, d])) for (i, x), d in zip(sparse, dense)]
    for _ in range(epochs):
        order = random.permutation(len(label))
        for low in range(0, len(order), batch):
            rows = order[low : low + batch]
            ids = np.concatenate([sparse[r][0] for r in rows])
            x = np.concatenate([sparse[r][1] for r in rows])[:, None]
            first = np.concatenate([[0], np.cumsum([len(sparse[r][0]) for r in rows])])[:-1]
            own = np.repeat(np.arange(len(rows)), [len(sparse[r][0]) for r in rows])
            w, f = theta[ids, :1], theta[ids, 1:]
            fx = f * x
            sums = np.add.reduceat(fx, first)
            total = bias + np.add.reduceat(w * x, first)[:, 0]
            total += 0.5 * (sums**2 - np.add.reduceat(fx**2, first)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(total, -500, 500))) - label[rows]) / len(rows)
            e = error[own][:, None]
            grad_rows = np.concatenate([e * x, e * x * (sums[own] - fx)], axis=1)
            used, back = np.unique(ids, return_inverse=True)
            g = np.stack([np.bincount(back, grad_rows[:, k], len(used)) for k in range(1 + RANK)], axis=1)
            g += 1e-4 * theta[used]
            t += 1
            m[used] = 0.9 * m[used] + 0.1 * g
            v[used] = 0.99 * v[used] + 0.01 * g * g
            fix, fix2 = 1 - 0.9**t, 1 - 0.99**t
            theta[used] -= rate * (m[used] / fix) / (np.sqrt(v[used] / fix2) + 1e-6)
            gb = error.sum()
            mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            bias -= rate * (mb / fix) / (np.sqrt(vb / fix2) + 1e-6)
    return theta[:, 0].copy(), theta[:, 1:].copy(), float(bias)


def scored(docs: DataFrame, model: Model | float, keep: list[str]) -> DataFrame:
    """``score`` for each text."""

    def score(column: pa.Array) -> list[pa.Array]:
        if isinstance(model, float):
            return [pa.array(np.full(len(column), model))]
        parts = [model.scores(words) for words in words_of(column, BETWEEN_SPACES, lower=True)]
        return [pa.array(np.concatenate(parts))]

    return with_columns(docs, "text", score, "score double", keep)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return out.select(
        "doc_id",
        F.expr("crc32(CAST(doc_id AS STRING)) % 4 = 2").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
