"""Words and anchors found in Arrow batches against Spark's own patterns."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlake.functions.text import normalize_text, padded_tokens
from postlake.operators import anchors as a
from postlake.operators.match import match_symbols, term_document_counts

POOL = ["the", "The", "of", "in", "$AB", "ab", "don't", "naïve", "ÀÉ", "日本", "x" * 20, "x" * 21, "🙂", "٣", "é", "İ", "ΣΑΣ", "--", ""]
GAPS = [" ", "  ", "\n", "’", " ", "　", ".", "$"]


def texts(n=400, seed=3):
    rng = random.Random(seed)
    some = ["".join(rng.choice(POOL) + rng.choice(GAPS) for _ in range(rng.randrange(0, 9))) for _ in range(n)]
    return [None, "", " ", "...", "a", "the of the of", "x" * 20 + "y", *some, None, "long " * 300_000, "", None]


@pytest.mark.parametrize("cashtags", [False, True])
def test_padded_texts_and_anchors_equal_those_of_patterns(spark, cashtags):
    want = ["the", "of", "the of", "日本", "naïve", "x" * 20, "x" * 21, "$ab", "ab the", "long long", "a"]
    hashes = a.wanted_hashes(spark.createDataFrame([(w,) for w in [*want, None, "the"]], "anchor string"))
    posts = spark.createDataFrame(list(enumerate(texts())), "id int, body string").repartition(3)
    made = a.found_anchors(spark, F.col("body"), cashtags, hashes)
    rows = posts.select("id", padded_tokens(F.col("body"), cashtags).alias("plain"), made.alias("made")).collect()
    assert len(rows) == len(texts())
    for r in rows:
        assert r.made.padded == r.plain
        words = (r.plain or "").split()
        every = sorted([*words, *map(" ".join, zip(words, words[1:]))])
        found = sorted(r.made.anchors)
        assert [x for x in every if x in want] == [x for x in found if x in want]
        assert len(found) <= len(every)


def test_squeezed_texts_equal_those_of_the_pattern(spark):
    odd = [None, *[f" a{chr(c)}b {chr(c)}{chr(c)} c{chr(c)}" for c in (0, 9, 11, 28, 31, 127, 133, 160, 0x1680, 0x180E, 0x200A, 0x200B, 0x2029, 0x3000, 0x1F600)]]
    posts = spark.createDataFrame(list(enumerate([*texts(), *odd])), "id int, body string").repartition(3)
    rows = posts.select("body", normalize_text(F.col("body")).alias("plain"), a.squeezed(spark, F.col("body")).alias("made")).collect()
    assert [r.made for r in rows] == [r.plain for r in rows] and any(r.body is None for r in rows)


def test_every_character_is_in_the_class_that_the_pattern_gives(spark):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    posts = spark.createDataFrame([(f"a{chr(c)}b",) for c in codes], "body string")
    made = a.found_anchors(spark, F.col("body"), False, np.zeros(0, np.uint64))
    plain = posts.select(padded_tokens(F.col("body")).alias("p"), made["padded"].alias("m"))
    assert plain.where("p <> m OR p IS NULL OR m IS NULL").count() == 0


def test_sliced_and_empty_batches(spark):
    edges = a.word_edges(spark, False)
    column = pa.array(["zz", None, "the. of", "of", ""]).slice(1, 3)
    (made,) = a.tokens_of(column, edges)
    assert bytes(made.raw[: made.offsets[-1]]) == b" the of  of "
    assert list(a.tokens_of(pa.array([], pa.string()), edges)) == []


def test_words_that_are_no_anchor_make_no_rows(spark):
    """Before, each text made a row for each of its words and pairs, and all of them met the terms."""
    terms = spark.createDataFrame([("S", 1, "rare", False)], "symbol string, term_no int, term string, needs_context boolean")
    posts = spark.createDataFrame([(str(i), f"many words in post {i} are " + "not " * i) for i in range(50)] + [("r", "a rare one")], "id string, body string")
    found = match_symbols(posts, terms)
    assert [(r.id, r.symbol) for r in found.collect()] == [("r", "S")]
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in term_document_counts(posts, terms).collect()] == [("rare", 1)]
