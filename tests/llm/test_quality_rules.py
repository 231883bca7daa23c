import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from postlake.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stated(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit)


@pytest.mark.parametrize("text", [
    None, "", "\n", "a\n\nb\n\n a\na\n", "a b c d e f g h " * 3, "é é\né é\n#|", "x\n" * 5, "\na\n", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8",
])
def test_counts_equal_a_plain_count(text):
    made = q.judge(pa.array(["pad pad", text, "pad\npad"], pa.string()), None)
    assert tuple(column[1].as_py() for column in made[:5]) == stated(text)


def test_query_over_awkward_rows(spark, small_dir, awkward_rows):
    out = q.op5_quality_rules(spark, small_dir).collect()
    assert len(out) == len(awkward_rows)
    want = Counter((i, *stated(t)) for i, t in awkward_rows)
    assert want == Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out)
    for r in out:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.probability <= 1


def test_stage_keeps_columns_and_empty_tables(spark, awkward, small_dir, empty_dir):
    kept = q.stage(spark, awkward, small_dir)
    assert kept.schema == awkward.schema
    assert 0 < kept.count() < awkward.count()
    assert q.op5_quality_rules(spark, empty_dir).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in q.op5_quality_rules(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(out[r.doc_id].kept == (r.quality == 1) for r in held) / len(held) > 0.9


def test_fitting_copies_a_block_of_rows_at_a_time(monkeypatch):
    """Before, the driver held several whole copies of the sample's columns and shares."""
    rng = np.random.default_rng(5)
    ids = [np.unique(rng.integers(0, q.FAMILIES * q.BUCKETS, 1000)).astype(np.int32) for _ in range(1500)]
    shares = [rng.random(len(i)).astype(np.float32) for i in ids]
    label = (np.arange(1500) % 3 == 0).astype(float)
    tracemalloc.start()
    model = q._fit(ids, shares, label, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20
    monkeypatch.setattr(q, "FIT_ROWS", 1500)
    whole = q._fit(ids, shares, label, 2)
    assert np.allclose(model.weights, whole.weights, rtol=1e-5) and np.isclose(model.bias, whole.bias)
