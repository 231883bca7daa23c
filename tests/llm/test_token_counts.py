import random

from pyspark.sql import functions as F

from postlake.llm import token_counts as q


def test_counts_follow_random_edits(monkeypatch):
    rng = random.Random(4)
    parts = ["the", " ", "\n", "  ", "'s", "éa", "123", "!!", "\t", "word", "日本", "🙂", " x", "\x1c"]

    def some(n):
        return "".join(rng.choice(parts) for _ in range(rng.randrange(n)))

    for _ in range(300):
        monkeypatch.setattr(q, "LEAF_CHARS", rng.choice([1, 5, 40]))
        text = some(300)
        cut = q.leaves(text)
        assert "".join(cut) == text
        tree = q.SegmentTree.of([len(p) for p in cut], [q.count_tokens(p, q.RANKS) for p in cut])
        assert tree.tokens[1] == q.count_tokens(text, q.RANKS)
        for _ in range(5):
            text, _ = tree.edit(text, rng.randrange(400), rng.randrange(50), some(6), q.RANKS)
            assert (tree.tokens[1], tree.chars[1]) == (q.count_tokens(text, q.RANKS), len(text))


def test_an_edit_encodes_little():
    text = "some words here " * 20_000
    cut = q.leaves(text)
    tree = q.SegmentTree.of([len(p) for p in cut], [q.count_tokens(p, q.RANKS) for p in cut])
    _, encoded = tree.edit(text, 100_000, 5, "other", q.RANKS)
    assert encoded < 3 * q.LEAF_CHARS


def test_query_edits_and_empty_tables(spark, small_dir, empty_dir, awkward, awkward_rows):
    rows = q.op8_token_counts(spark, small_dir).collect()
    assert len(rows) == len(awkward_rows)
    text = dict(awkward_rows)
    for r in rows:
        if r.doc_id is not None:
            assert r.n_tokens == q.count_tokens(text[r.doc_id] or "", q.RANKS)
    trees = q.with_trees(awkward.select("doc_id", "text")).withColumn("edits", q.revision("doc_id", "text"))
    for r in q.edited(trees, "edits", ["doc_id"]).collect():
        assert r.n_tokens_edited == q.count_tokens(r.new_text, q.RANKS) and r.n_chars_edited == len(r.new_text)
    none = trees.withColumn("edits", F.lit(None).cast("array<struct<start:int,remove:int,insert:string>>"))
    assert all(r.n_tokens == r.n_tokens_edited for r in q.edited(none, "edits", ["doc_id"]).collect())
    assert q.op8_token_counts(spark, empty_dir).count() == 0
