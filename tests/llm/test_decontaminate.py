import hashlib
import random
import re

import pytest

from postlake.llm import decontaminate as q

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w, hit, ids = words(text), set(), set()
    for item, content in items:
        p = words(content)
        n = min(13, len(p))
        windows = {tuple(p[i : i + n]) for i in range(len(p) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add("null" if item is None else str(item))
    digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(w), len(hit), len(ids), digest, len(hit) > 0 and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("part_bytes", [60, 1 << 20])
def test_equals_brute_force(spark, part_bytes):
    rng = random.Random(part_bytes)
    alphabet = ["a", "B", "é", "x1", "日本"]
    items = [(i, " ".join(rng.choice(alphabet) for _ in range(n))) for i, n in enumerate([0, 1, 2, 3, 5, 12, 13, 14, 30])]
    items += [(None, "x1 x1 B"), (3, items[3][1]), (50, None)]
    docs = [(i, " ".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))) for i in range(60)]
    docs += [(i + 100, f"q q {items[8][1]} q, {items[7][1].upper()}") for i in range(3)] + [(200, None), (None, items[8][1]), (1, "a")]
    found = q.searched(
        spark.createDataFrame(docs, "doc_id long, text string"), "text", spark.createDataFrame(items, "item_id long, text string"), part_bytes
    ).select("doc_id", "text", "_n_words", q.n_hit(), "_items", q.contaminated().alias("bad"))
    rows = found.collect()
    assert len(rows) == len(docs)
    for r in rows:
        digest = hashlib.sha256(",".join(sorted(r._items)).encode()).hexdigest()
        assert (r._n_words, r.n_hit, len(r._items), digest, r.bad) == brute(r.text, items)


def test_tables_grow_with_their_blocks():
    """Most slots of a table stay free of patterns, so most blocks of a text without passages are skipped."""
    rng = random.Random(1)
    item = " ".join(f"w{rng.randrange(50_000)}" for _ in range(40_000))
    (tables,) = q.Patterns(["1"], [item]).tables
    assert (tables.shift < tables.stride).mean() < 0.2


def test_query_stage_and_empty_tables(spark, small_dir, empty_dir, awkward, awkward_rows):
    items = [tuple(r) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    text = dict(awkward_rows)
    for r in q.op1_decontaminate(spark, small_dir).collect():
        if r.doc_id is not None:
            assert tuple(r)[1:] == brute(text[r.doc_id], items)
    assert q.op1_decontaminate(spark, empty_dir).count() == 0
    kept = q.stage(spark, awkward, small_dir)
    assert kept.schema == awkward.schema and kept.count() == awkward.count()
    assert q.stage(spark, awkward, empty_dir).count() == awkward.count()
