import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from postlake.llm import importance as q
from postlake.llm.words import ALPHANUMERIC, words_of
from tests.llm.conftest import sentence

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def buckets(text, runs):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in range(1, runs + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, runs=1):
    """Rows (doc_id, n_features, weight, score, rank) by plain counting."""
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text, runs))
    for text in target:
        t.update(buckets(text, runs))
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log(((t[b] + 1) * (all_s + 10_000)) / ((s[b] + 1) * (all_t + 10_000))))

    out = []
    for i, text in rows:
        found = buckets(text, runs)
        weight, score = sum(map(gain, found)), None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(found), weight, score, len(words(text)) >= 20 and i is not None))
    ready = sorted((-r[3], r[0]) for r in out if r[4])
    drawn = ready[: 10 * len(ready) // 100]
    return out, drawn


def check(spark, rows, target, runs=1):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = q.resample(docs, spark.createDataFrame([(x,) for x in target], "text string"), runs).collect()
    want, drawn = brute(rows, target, runs)
    plain = Counter(tuple(r)[:4] for r in got)
    assert plain == Counter(r[:4] for r in want)
    assert [(-r.score, r.doc_id) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))


@pytest.mark.parametrize("runs,head", [(1, 1 << 15), (1, 3), (1, 0), (2, 20), (2, 1 << 15), (3, 12)])
def test_equals_plain_counting(spark, monkeypatch, awkward_rows, runs, head):
    monkeypatch.setattr(q, "HEAD", head)
    rng = random.Random(head + runs)
    rows = awkward_rows + [(100 + i, sentence(rng, rng.randrange(60)) + " ÅÉ z" * (i % 3)) for i in range(80)]
    check(spark, rows, [sentence(rng, 30), None, "", "Three SHORT words", "z" * 200], runs)


def test_ties_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(25))
    check(spark, [(7, text)] * 40 + [(i, text) for i in range(30)] + [(None, text)] * 20, ["w1 w2"])


def test_query_and_empty_tables(spark, small_dir, empty_dir, awkward_rows):
    assert q.op11_importance_resampling(spark, small_dir).count() == len(awkward_rows)
    assert q.op11_importance_resampling(spark, empty_dir).count() == 0
    check(spark, [(1, "a b")], [])


def test_crc_of_spans_and_hash_collisions():
    chunk = next(words_of(pa.array(["alpha beta", None, "gamma beta alpha x"]), ALPHANUMERIC, lower=True))
    got = q.carry_on(np.full(6, q._START), chunk.cased, chunk.starts, chunk.ends) ^ q._START
    assert got.tolist() == [zlib.crc32(chunk.word(i)) for i in range(6)]
    head = q.Head(["alpha", "beta"])
    head.raw = head.raw.copy()
    head.raw[head.starts[head.find(chunk)[0]]] ^= 1  # as if another word had the hash of "alpha"
    assert [i >= 0 for i in head.find(chunk)] == [False, True, False, True, False, False]
