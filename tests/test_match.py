"""Post and symbol matching against brute force, its plan, and hot words."""

import random
import re

import pytest
from pyspark.sql import functions as F

from postlake.functions.text import padded_tokens
from postlake.operators.match import (
    PADDED,
    _post_anchors,
    drop_false_positives,
    false_positive_counts,
    is_true_match_in,
    match_symbols,
    prepare_terms,
    term_document_counts,
)

TERMS = [
    ("AAA", 1, "the apple", False),
    ("AAA", 2, "Apple", True),
    ("AAA", 3, "pear", False),
    ("BBB", 1, "the", False),
    ("BBB", 2, "plum tree house", False),
    ("CCC", 1, "AAA", True),
    ("CCC", 2, "$CCC", False),
    ("DDD", 1, "!!!", False),
    ("EEE", 1, "apple", True),
    ("EEE", 2, "apple", False),
]
CONTEXT = ("stocks", "shares")


def terms_of(spark):
    return spark.createDataFrame(TERMS, "symbol string, term_no int, term string, needs_context boolean")


def posts_of(spark, n=500, seed=4):
    rng = random.Random(seed)
    pool = ["the", "The", "apple", "APPLE,", "pear", "plum", "tree", "house", "aaa", "$ccc", "ccc", "stocks", "x", "pineapple"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(0, 7))) for _ in range(n)]
    return texts, spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, body string")


def brute(texts, cashtags):
    gap = r"[^a-z0-9$]+" if cashtags else r"[^a-z0-9]+"

    def flat(text):
        return " " + re.sub(gap, " ", text.lower()).strip() + " "

    found = set()
    for i, text in enumerate(texts):
        padded = flat(text)
        context = any(f" {w} " in padded for w in CONTEXT)
        for symbol, no, term, needs in sorted(TERMS):
            if flat(term).strip() and flat(term) in padded and (context or not needs):
                if (str(i), symbol) not in {(a, b) for a, b, _ in found}:
                    found.add((str(i), symbol, no))
    return found


@pytest.mark.parametrize("cashtags", [False, True])
@pytest.mark.parametrize("by_shuffle", [False, True])
@pytest.mark.parametrize("rare", [False, True])
def test_match_equals_brute_force(spark, cashtags, by_shuffle, rare):
    texts, posts = posts_of(spark)
    terms = terms_of(spark)
    counts = term_document_counts(posts, terms, cashtags=cashtags) if rare else None
    got = match_symbols(
        posts, terms, cashtags=cashtags, document_counts=counts, max_rows=0 if by_shuffle else 1000
    ).collect()
    assert len(got) == len({(r.id, r.symbol) for r in got})
    assert {(r.id, r.symbol, r.term_no) for r in got} == brute(texts, cashtags)


def test_copies_of_one_post_are_all_tagged(spark):
    """A third of the posts share one id; both ways of joining keep every copy."""
    copies = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 2 == 0, F.lit("the apple")).otherwise(F.lit("a pear")).alias("body"),
    )
    rows = [
        match_symbols(copies, terms_of(spark), max_rows=n).groupBy("symbol", "body").count().collect() for n in (1000, 0)
    ]
    assert sorted(rows[0]) == sorted(rows[1])
    assert {(r.symbol, r.body): r["count"] for r in rows[0]}[("AAA", "the apple")] == 1500


def test_posts_without_id_are_no_hot_key_and_terms_run_once(spark):
    _, posts = posts_of(spark)
    unnamed = posts.select(F.lit(None).cast("string").alias("id"), "body")
    found = [
        sorted(map(tuple, match_symbols(unnamed, terms_of(spark), max_rows=n).select("symbol", "body").collect())) for n in (1000, 0)
    ]
    assert found[0] == found[1] and found[0]
    runs = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda x: runs.add(1) or x, "string")
    terms = terms_of(spark)
    n = terms.count()
    match_symbols(posts, terms.withColumn("term", counted.asNondeterministic()("term"))).collect()
    assert runs.value == n


def test_plan_joins_by_word_without_shuffling_posts(spark, plan_of):
    _, posts = posts_of(spark)
    plan = plan_of(match_symbols(posts, terms_of(spark)))
    assert "BroadcastHashJoin" in plan and "regexp_like" not in plan and " RLIKE " not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert not re.search(r"hashpartitioning\((id|anchor|_key)", plan)  # the terms are shuffled, the posts are not
    # explode and join share one generated stage, so texts are not copied per word
    stages = [set(re.findall(r"\*\((\d+)\) " + op, plan)) for op in ("Generate explode", "BroadcastHashJoin")]
    assert stages[0] & stages[1]


def test_false_positives(spark):
    pairs = spark.createDataFrame(
        [
            ("AB", "AB Co", None, "abco", "buy AB now"),
            ("AB", "AB Co", None, "abco", "buy ab now"),
            ("AB", "AB Co", None, "abco", "buy ABCO"),
            ("AB", "", None, "", "nothing"),
            ("CD", None, None, None, "good Shares"),
        ],
        "symbol string, shortName string, longName string, name string, body string",
    )
    kept = sorted(r.body for r in drop_false_positives(pairs).collect())
    assert kept == ["buy AB now", "buy ABCO", "good Shares"]
    texts = F.array("shortName", "longName", "name", F.lit("shares"))
    same = pairs.where(is_true_match_in(F.col("body"), F.col("symbol"), texts))
    assert sorted(r.body for r in same.collect()) == kept
    counts = {r.symbol: (r.n_matched, r.n_removed) for r in false_positive_counts(pairs).collect()}
    assert counts == {"AB": (4, 2), "CD": (1, 0)}


def test_null_keys_are_matched_alike_on_both_paths(spark):
    posts = spark.createDataFrame([(None, "buy zyx now"), (None, "zyx and qua"), ("1", "zyx"), ("2", None)], "id string, body string")
    terms = spark.createDataFrame([("ZYX", 1, "zyx", False), (None, 1, "qua", False)], "symbol string, term_no int, term string, needs_context boolean")
    want = sorted([(None, "buy zyx now", "ZYX"), (None, "zyx and qua", "ZYX"), (None, "zyx and qua", None), ("1", "zyx", "ZYX")], key=repr)
    for rows in (1000, 0):
        got = match_symbols(posts, terms, max_rows=rows).select("id", "body", "symbol").collect()
        assert sorted(map(tuple, got), key=repr) == want


def test_common_words_of_longer_phrases_make_no_candidates(spark, plan_of):
    """A phrase of two words meets only posts that hold both side by side."""
    terms = spark.createDataFrame(
        [("S", 1, "the of", False), ("T", 1, "of the in", False), ("U", 1, "of", False)],
        "symbol string, term_no int, term string, needs_context boolean",
    )
    ready = prepare_terms(terms)
    assert {r.phrase: r.anchor for r in ready.collect()} == {"the of": "the of", "of the in": "of the", "of": "of"}
    texts = ["of in the"] * 200 + ["the of", "x of the in y", "of the", "of the of the in", "", "of"]
    posts = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, body string")
    counts = spark.createDataFrame([("of", 5), ("the", 9), ("in", 1)], "token string, n_posts long")
    by_rare_word = {r.phrase: r.anchor for r in prepare_terms(terms, document_counts=counts).collect()}
    assert by_rare_word == {"the of": "the of", "of the in": "the in", "of": "of"}
    for rows in (1000, 0):
        got = {(r.id, r.symbol) for r in match_symbols(posts, terms, max_rows=rows).where("symbol <> 'U'").collect()}
        assert got == {("200", "S"), ("203", "S"), ("201", "T"), ("203", "T")}
    anchors = _post_anchors(posts.select(padded_tokens(F.col("body")).alias(PADDED)), "anchor")
    assert anchors.join(ready.where("symbol <> 'U'"), "anchor").count() == 5
