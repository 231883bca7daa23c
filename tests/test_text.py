"""Text functions: hand-written cases, and properties on random input."""

import random

from pyspark.sql import functions as F

from postlake.functions.text import normalize_text, padded_tokens, strip_tags, truncate_sentences

SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0      　"


def squeezed(text):
    return " ".join(text.split())


def run(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    return [r[1] for r in sorted(df.select("i", expression(F.col("x"))).collect())]


def test_normalize_matches_python(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(SPACES + "ab.é字") for _ in range(rng.randrange(60))) for _ in range(600)]
    texts += ["", " ", "　x　", "a\x00b", "a​b", "a﻿b"]
    assert run(spark, texts, normalize_text) == [squeezed(t) for t in texts]


CUT_AT_10 = [
    ("0123456789", "0123456789"),  # not beyond the limit
    ("01234567890", "01234567890. [...]"),  # beyond it, without a sentence end
    ("01234567890. b", "01234567890. [...]"),  # the end beyond the limit is kept whole
    ("0123. 5678. 0123. 5678. x", "0123. 5678. [...]"),
    ("a. bcdefghijklm. n. o", "a. bcdefghijklm. [...]"),
    ("abc . defghijkl. m", "abc. defghijkl. [...]"),  # a space before the stop belongs to no sentence
    ("", ""),
]


def test_truncate_cases(spark):
    got = run(spark, [text for text, _ in CUT_AT_10], lambda c: truncate_sentences(c, 10))
    assert got == [short for _, short in CUT_AT_10]


def test_truncate_properties(spark):
    rng = random.Random(2)
    texts = [squeezed("".join(rng.choice("ab. é") for _ in range(rng.randrange(90)))) for _ in range(900)]
    for text, short in zip(texts, run(spark, texts, lambda c: truncate_sentences(c, 40))):
        if len(text) <= 40:
            assert short == text
            continue
        assert short.endswith(". [...]")
        held = short.removesuffix("[...]")
        assert len(held) > 40
        assert text.replace(" ", "").startswith(held.removesuffix(". ").replace(" ", ""))


def test_truncate_edges(spark):
    exact, over = "a" * 2000, "a" * 2001
    late = "b" * 1999 + ". " + "c" * 10 + ". d"
    got = run(spark, [exact, over, late], truncate_sentences)
    assert got == [exact, over + ". [...]", "b" * 1999 + ". [...]"]


def test_tokens_keep_cashtags_only_when_asked(spark):
    assert run(spark, ["Buy $AAPL, now!"], lambda c: padded_tokens(c, cashtags=True)) == [" buy $aapl now "]
    assert run(spark, ["Buy $AAPL, now!"], padded_tokens) == [" buy aapl now "]
    assert run(spark, ['<a href="x">App</a>'], strip_tags) == ["App"]
