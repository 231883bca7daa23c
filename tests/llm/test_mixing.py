import math
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from postlake.llm import mixing as q


def rows(spark, sizes):
    data = [(s, i * 1000 + j, 10) for i, (s, n) in enumerate(sizes.items()) for j in range(n)]
    return spark.createDataFrame(data, "key string, order long, tokens long")


def entropy(w):
    return -sum(x * math.log(x) for x in w if x) / math.log(len(w))


def test_entropy_target_and_budget(spark, plan_of):
    out = q.copies(rows(spark, {"a": 600, "b": 100, "c": 60, "d": 40}), max_epochs=10.0)
    made = {r.key: r for r in out.groupBy("key").agg(F.first("weight").alias("weight"), F.sum(F.expr("tokens * copies")).alias("got")).collect()}
    assert entropy([r.weight for r in made.values()]) == pytest.approx(q.TARGET_ENTROPY, abs=1e-4)
    for r in made.values():
        assert 0 <= r.weight * 8000 - r.got < 10 + 1e-6
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)


def test_blocks_take_the_budget_exactly_once(spark, monkeypatch):
    monkeypatch.setattr(q, "BLOCK_TOKENS", 70)
    out = q.copies(rows(spark, {"a": 300, "b": 30}), max_epochs=50.0, target_entropy=1.0)
    got = {r.key: (r.got, r.low, r.high) for r in out.groupBy("key").agg(F.sum(F.expr("tokens * copies")).alias("got"), F.min("copies").alias("low"), F.max("copies").alias("high")).collect()}
    assert got["a"][0] in (1640, 1650) and got["a"][1:] == (0, 1)  # a quota may miss the next document by a hair
    assert got["b"][0] in (1640, 1650) and got["b"][1:] == (5, 6)
    places = sorted(r.position for r in out.filter("key = 'a'").collect())
    assert places == list(range(0, 3000, 10))  # a permutation without gaps


def test_repetition_limit_wins(spark):
    out = q.copies(rows(spark, {"a": 500, "b": 5}), target_entropy=1.0, max_epochs=3.0)
    most = out.agg(F.max("copies")).first()[0]
    weight = {r.key: r.weight for r in out.select("key", "weight").distinct().collect()}
    assert most <= 3 and weight["b"] == pytest.approx(3 * 5 / 505, rel=1e-3)


def test_repetition_limit_wins_above_one(spark):
    totals = spark.createDataFrame([(str(i), 5_000 if i == 0 else 1_000) for i in range(1_000)], "key string, total long")
    free = {r.key: r for r in q.weights(totals, max_epochs=1e9).collect()}
    assert free["0"].quota / 5_000 > 10  # what the entropy target alone asks for
    for budget in (None, 2 * 1_004_000):
        made = {r.key: r for r in q.weights(totals, budget=budget).collect()}
        assert made["0"].quota / 5_000 == pytest.approx(q.MAX_EPOCHS, rel=1e-3) and made["0"].epochs <= q.MAX_EPOCHS
        assert max(r.quota / r.total for r in made.values()) <= q.MAX_EPOCHS
    assert q.exponent(totals, 5 * 1_004_000, q.TARGET_ENTROPY, q.MAX_EPOCHS)[0] == 1.0


def spark_hash(*values):
    """Spark's xxhash64 of longs, ints ("i", value) and strings, as signed."""
    seed = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[1]) if isinstance(v, tuple) else struct.pack("<q", v)
        seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def plain_weights(totals, target, max_epochs):
    """Weights by halving the exponent's interval, one source after the other."""
    everything = sum(totals.values())
    shares = {k: t / everything for k, t in totals.items() if t}

    def at(a):
        z = sum(s**a for s in shares.values())
        return {k: s**a / z for k, s in shares.items()}

    def halve(holds, low, high):
        for _ in range(100):
            mid = (low + high) / 2
            low, high = (mid, high) if holds(at(mid)) else (low, mid)
        return low

    def most(w):
        return max(w[k] / shares[k] for k in shares)

    found = halve(lambda w: -sum(x * math.log(x) for x in w.values()) >= target * math.log(len(shares)), 0.0, q.LARGEST_EXPONENT)
    if most(at(found)) > max_epochs:
        found = halve(lambda w: most(w) > max_epochs, found, 1.0) if found < 1 else halve(lambda w: most(w) <= max_epochs, 1.0, found)
    return at(found)


def plain_copies(data, weight, block_tokens, block_rows, seed=0):
    """(copies, position) of each row (key, order, tokens), laid out one document after the other."""
    everything, out = sum(r[2] for r in data), {}
    for key in {r[0] for r in data}:
        mine = [r for r in data if r[0] == key]
        total = sum(r[2] for r in mine)
        quota = math.floor(weight[key] * everything + 1e-6)
        epochs = quota // total if total else 0
        rest = quota - epochs * total
        n = max(-(-total // block_tokens), -(-len(mine) // block_rows))
        blocks = {}
        for r in mine:
            blocks.setdefault(spark_hash(r[1], ("i", seed)) % n, []).append(r)
        taken = 0
        for b in sorted(blocks, key=lambda b: (spark_hash(key, b, ("i", seed)), b)):
            so_far = 0
            for r in sorted(blocks[b], key=lambda r: (spark_hash(r[1], ("i", seed + 1)), r[1])):
                so_far += r[2]
                room = rest - taken
                out[r[1]] = (epochs + (room > 0 and so_far <= room), taken + so_far - r[2])
            taken += so_far
    return out


@pytest.mark.parametrize("block_tokens,block_rows,max_epochs", [(200, 1_000, 4.0), (1_000_000, 7, 1.5), (300, 11, 2.5)])
def test_equals_brute_force(spark, monkeypatch, block_tokens, block_rows, max_epochs):
    monkeypatch.setattr(q, "BLOCK_TOKENS", block_tokens)
    monkeypatch.setattr(q, "BLOCK_ROWS", block_rows)
    rng = random.Random(block_rows)
    sizes = {"a": 300, "b": 60, "c": 25, "d": 8, "empty": 90}
    keys = [k for k, n in sizes.items() for _ in range(n)]
    data = [(k, i, 0 if k == "empty" or i % 17 == 0 else rng.randrange(1, 40)) for i, k in enumerate(keys)]
    got = q.copies(spark.createDataFrame(data, "key string, order long, tokens long"), max_epochs=max_epochs).collect()
    weight = {r.key: r.weight for r in got}
    totals = {k: sum(r[2] for r in data if r[0] == k) for k in sizes}
    assert weight == pytest.approx({**plain_weights(totals, q.TARGET_ENTROPY, max_epochs), "empty": 0.0}, rel=1e-5)
    assert {r.order: (r.copies, r.position) for r in got} == plain_copies(data, weight, block_tokens, block_rows)


def test_a_source_of_empty_texts_is_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(q, "BLOCK_ROWS", 50)
    data = [("none", i, 0) for i in range(1_000)] + [("some", 1_000 + i, 5) for i in range(10)]
    out = q.copies(spark.createDataFrame(data, "key string, order long, tokens long"))
    made = out.filter("key = 'none'").groupBy("block").count().collect()
    assert len(made) == 20 and max(r["count"] for r in made) < 100
    assert out.filter("key = 'none'").agg(F.max("copies")).first()[0] == 0


@pytest.mark.parametrize("sizes", [{"a": 7}, {"a": 5, "b": 5}])
def test_equal_shares_stay_as_they_are(spark, sizes):
    assert {r.copies for r in q.copies(rows(spark, sizes)).collect()} == {1}


def test_query_stage_and_empty_tables(spark, small_dir, empty_dir, awkward, awkward_rows):
    out = q.op9_mix_sources(spark, small_dir)
    assert out.count() == len(awkward_rows)
    assert q.op9_mix_sources(spark, empty_dir).count() == 0
    mixed = q.stage(spark, awkward, small_dir)
    assert mixed.columns[: len(awkward.columns)] == awkward.columns and mixed.count() == awkward.count()
    odd = awkward.withColumn("source", F.when(F.length("text") > 0, F.when(F.col("doc_id") > 5, F.lit("x"))).otherwise("none"))
    assert q.stage(spark, odd, small_dir).filter("source = 'none'").count() == 0
