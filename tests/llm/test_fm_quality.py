import zlib

import numpy as np
import pyarrow as pa

from postlake.llm import fm_quality as q
from postlake.llm.words import BETWEEN_SPACES, words_of


def test_linear_time_score_equals_the_pairwise_sum():
    rng = np.random.default_rng(1)
    size = q.BUCKETS + q.DENSE
    model = q.Model(0.1, rng.normal(0, 0.3, size), rng.normal(0, 0.3, (size, q.RANK)), np.zeros(q.DENSE), np.ones(q.DENSE))
    texts = ["a b c a", "", "Zwei Wörter\nund mehr!", None]
    for words in words_of(pa.array(texts, pa.string()), BETWEEN_SPACES, lower=True):
        got = model.scores(words)
        row, _, bucket, share = q.word_inputs(words)
        dense = np.clip(q.statistics(words), -5, 5)
        for i in range(words.rows):
            ids = np.concatenate([bucket[row == i], np.arange(q.BUCKETS, size)])
            x = np.concatenate([share[row == i], dense[i]])
            total = model.bias + model.linear[ids] @ x
            for a in range(len(ids)):
                for b in range(a + 1, len(ids)):
                    total += model.factors[ids[a]] @ model.factors[ids[b]] * x[a] * x[b]
            assert abs(got[i] - 1 / (1 + np.exp(-total))) < 1e-6


def test_query_and_accuracy(spark, small_dir, empty_dir, awkward_rows):
    out = q.op2_quality_classifier(spark, small_dir).collect()
    assert len(out) == len(awkward_rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert q.op2_quality_classifier(spark, empty_dir).count() == 0
    folder = "/root/testdata/sf0.01"
    scores = {r.doc_id: r.predicted for r in q.op2_quality_classifier(spark, folder).filter("held_out").collect()}
    held = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.doc_id in scores]
    assert sum(scores[r.doc_id] == r.quality for r in held) / len(held) > 0.95
