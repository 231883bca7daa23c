import math
import random

import pytest

from postlake.llm import hard_negatives as h
from postlake.llm import topk_search as t
from postlake.llm import vectors

SCHEMA = "vec_id long, embedding array<double>, label int"


def whole(v):
    return [math.floor(256 * x) for x in v]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top(rows, every, k):
    items = {i: whole(v) for i, v, _ in rows if i is not None and usable(v)}
    out = set()
    for q in items:
        if q % every == 0:
            best = sorted((-dot(items[q], items[c]), c) for c in items if c != q)[:k]
            out |= {(q, n, c, -s) for n, (s, c) in enumerate(best, 1)}
    return out


def brute_negatives(rows, every, p, k):
    items = {i: (whole(v), l) for i, v, l in rows if i is not None and l is not None and usable(v)}
    out = set()
    for a, (x, label) in items.items():
        if a % every:
            continue
        scored = sorted((-dot(x, y), i, l) for i, (y, l) in items.items() if i != a)
        for ps, i, _ in [r for r in scored if r[2] == label][:p]:
            inside = [(s, j) for s, j, l in scored if l != label and 80 * -ps <= 100 * -s <= 100 * -ps][:k]
            out |= {(a, i, n, j, -ps, -s) for n, (s, j) in enumerate(inside, 1)}
    return out


def rows_of(rng, n, dims=6, wide=1.0):
    """Ordinary vectors, a third of them copies or near copies of one, ties, odd values and lengths."""
    base = [rng.uniform(-wide, wide) for _ in range(dims)]
    rows = []
    for i in range(n):
        v = [rng.choice([-0.5, 0.25, rng.uniform(-wide, wide)]) for _ in range(dims)]
        if i % 3 == 0:
            v = list(base)
            if i % 2:
                v[rng.randrange(dims)] += 0.01
        rows.append((i, v, rng.randrange(3)))
    return rows


ODD = [
    (1000, None, 1),
    (1005, [None] * 6, 1),
    (1010, [float("nan")] + [0.0] * 5, 0),
    (1015, [float("inf")] + [0.0] * 5, 0),
    (1020, [], 2),
    (1025, [0.5, 0.5], 0),
    (1030, [0.1] * 9, 1),
    (1035, [0.1] * 6, None),
    (None, [0.9] * 6, 1),
]


def searched(spark, rows, every, k):
    got = t.search(spark.createDataFrame(rows, SCHEMA), t.F.col("vec_id") % every == 0, k).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


@pytest.mark.parametrize("dense,block_rows,k,wide", [(64, 1 << 19, 5, 1.0), (2, 7, 3, 1.0), (0, 40, 1, 1.0), (3, 11, 2, 300.0), (3, 50, 2, 1e6)])
def test_search_equals_brute_force(spark, monkeypatch, dense, block_rows, k, wide):
    monkeypatch.setattr(t, "DENSE", dense)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(vectors, "SCORES", 500)
    rows = rows_of(random.Random(k + dense), 90, wide=wide) + ODD
    assert searched(spark, rows, 5, k) == brute_top(rows, 5, k)


def test_one_slice_or_more_slices_than_components(spark):
    rows = rows_of(random.Random(3), 40, dims=3)
    items = vectors.packed(spark.createDataFrame(rows, SCHEMA), ["vec_id"])
    for slices in (1, 4):
        got = t.top_k(items, items.filter("vec_id % 5 = 0"), 2, slices).collect()
        assert {tuple(r) for r in got} == brute_top(rows, 5, 2)


def test_few_rows_repeated_ids_and_empty_tables(spark):
    rows = [(0, [0.5], 1), (5, [0.25], 1), (7, [1.0], 0)]
    assert searched(spark, rows, 5, 5) == brute_top(rows, 5, 5)
    assert searched(spark, rows + rows, 5, 5) == brute_top(rows, 5, 5)
    assert searched(spark, rows[:1], 5, 5) == set()
    assert searched(spark, [], 5, 5) == set()
    assert h.mine(vectors.packed(spark.createDataFrame([], SCHEMA), ["vec_id", "label"]), t.F.lit(True)).count() == 0


@pytest.mark.parametrize("block_rows,p,k", [(1 << 19, 5, 5), (9, 2, 3), (30, 4, 1)])
def test_negatives_equal_brute_force(spark, monkeypatch, block_rows, p, k):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(vectors, "SCORES", 500)
    rows = rows_of(random.Random(p), 100) + ODD
    rows += [(2000 + i, [-x for x in rows[4][1]], 1) for i in range(6)]  # negative scores alone
    items = vectors.packed(spark.createDataFrame(rows, SCHEMA).filter("label IS NOT NULL"), ["vec_id", "label"])
    got = h.mine(items, t.F.col("vec_id") % 5 == 0, p, k).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == brute_negatives(rows, 5, p, k)


def test_ties_go_to_smaller_ids(spark):
    rows = [(0, [1.0], 0), (1, [0.5], 0), (9, [0.45], 1), (4, [0.45], 1), (6, [0.5], 1), (2, [0.5], 1), (3, [0.1], 1)]
    items = vectors.packed(spark.createDataFrame(rows, SCHEMA), ["vec_id", "label"])
    got = h.mine(items, t.F.col("vec_id") == 0, 1, 3).orderBy("rank").collect()
    assert [(r.rank, r.negative_id) for r in got] == [(1, 2), (2, 6), (3, 4)]
    assert searched(spark, rows, 10, 3) == {(0, 1, 1, 32768), (0, 2, 2, 32768), (0, 3, 6, 32768)}


def test_queries_and_empty_tables(spark, small_dir, empty_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    assert {tuple(r) for r in t.op13_topk_search(spark, small_dir).collect()} == brute_top(rows, 50, 5)
    moved = [(i, v, (x + 1) % 10 if i is not None and i % 7 == 0 else x) for i, v, x in rows]
    assert {tuple(r) for r in h.op12_hard_negatives(spark, small_dir).collect()} == brute_negatives(moved, 100, 5, 5)
    assert t.op13_topk_search(spark, empty_dir).count() == h.op12_hard_negatives(spark, empty_dir).count() == 0
