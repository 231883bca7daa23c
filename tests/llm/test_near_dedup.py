import random
import re

import pytest

from postlake.llm import near_dedup as q
from postlake.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size=4):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, size=4):
    """Component of each id by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    lead = {i: i for i in sets}

    def find(i):
        while lead[i] != i:
            i = lead[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and find(i) != find(j):
                a, b = find(i), find(j)
                lead[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(spark, rows):
    out = q.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    want = brute(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def edits(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10_000)}"
    return " ".join(words)


def test_equals_all_pairs_with_large_groups(spark, monkeypatch):
    """Small limits send one group of near copies and one shared passage through every way of a large group."""
    monkeypatch.setattr(q, "LEAF", 6)
    monkeypatch.setattr(q, "BLOCK", 6)
    monkeypatch.setattr(q, "PART", 8)
    monkeypatch.setattr(q, "PIVOTS", 2)
    monkeypatch.setattr(q, "TEXT_PIVOTS", 2)
    rng = random.Random(11)
    base = [f"b{i}" for i in range(90)]
    passage = [f"p{i}" for i in range(40)]
    texts = [edits(rng, base, rng.randrange(8)) for _ in range(70)]
    texts += [" ".join([f"u{k}_{i}" for i in range(25)] + passage) for k in range(40)]
    texts += [edits(rng, [f"c{k}_{i}" for i in range(50)], e) for k in range(6) for e in (0, 0, 1, 2, 3)]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)))


@pytest.mark.parametrize("edits_of", [14])
def test_rows_of_a_large_group_grow_with_its_members(spark, monkeypatch, edits_of):
    """Links with pivots in nodes and in the confirmation, at n, 2n and 4n near copies of one text."""
    for name in ("PART", "LEAF", "BLOCK"):
        monkeypatch.setattr(q, name, 64)
    rng = random.Random(edits_of)
    base = [f"b{i}" for i in range(120)]
    counted = {}
    real = q.staged

    def count(df, purpose):
        out = real(df, purpose)
        counted[purpose] = counted.get(purpose, 0) + out.count()
        return out

    monkeypatch.setattr(q, "staged", count)
    for n in (150, 300, 600):
        counted.clear()
        texts = [edits(rng, base, rng.randrange(edits_of)) for _ in range(n)]
        rows = list(enumerate(texts))
        if n == 150:
            check(spark, rows)
        else:
            q.components(spark.createDataFrame(rows, "doc_id long, text string")).count()
        roots = q.TREES * q.BRANCHES
        assert counted["met"] + counted["links"] <= 2 * n * (roots + 1), counted


def test_two_large_groups_in_one_cluster(spark, monkeypatch):
    """Two families, linked only through a chain of texts between them, and one apart that shares a long passage."""
    for name, value in (("BLOCK", 20), ("LEAF", 20), ("PART", 30), ("TEXT_PIVOTS", 3)):
        monkeypatch.setattr(q, name, value)
    rng = random.Random(5)
    first = [f"a{i}" for i in range(100)]
    second = first[:60] + [f"c{i}" for i in range(40)]
    third = first[:70] + [f"d{i}" for i in range(30)]
    texts = [edits(rng, words, rng.randrange(4)) for words in (first, second, third) for _ in range(60)]
    texts += [" ".join(first[:k] + second[k:]) for k in range(60, 100, 5)]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_awkward_rows(spark, awkward_rows):
    check(spark, awkward_rows)


def test_query_stage_and_empty_tables(spark, small_dir, empty_dir, awkward, awkward_rows):
    assert q.op4_near_dedup(spark, small_dir).count() == len(awkward_rows)
    assert q.op4_near_dedup(spark, empty_dir).count() == 0
    kept = q.stage(spark, awkward, small_dir)
    assert kept.columns == awkward.columns
    want = brute(awkward_rows, 5)
    ids = sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None)
    assert ids == sorted(i for i, _ in awkward_rows if i is not None and want[i][1] == i)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (7, 8)], [(9, i) for i in range(9)]])
def test_components(spark, edges):
    out = connected_components(spark.createDataFrame(edges, "a long, b long"))
    lead = {n: n for e in edges for n in e}
    for _ in lead:
        for a, b in edges:
            lead[a] = lead[b] = min(lead[a], lead[b])
    assert sorted(map(tuple, out.collect())) == sorted((n, r) for n, r in lead.items() if n != r)
