"""Company names and search terms: hand-written cases, and properties on random names."""

import random

from pyspark.sql import functions as F

from postlake.operators.enrich import (
    ARTICLES,
    comment_terms,
    company_names,
    in_dictionary,
    match_list,
    render_terms,
    trim_company_names,
    tweet_terms,
)
from postlake.sources.symbols import dictionary_words

WORDS = ["Apple", "bank", "of", "The", "group", "inc", "general", "gap", "zoo fun"]


def words(spark, extra=()):
    return dictionary_words(spark.createDataFrame([(w,) for w in [*WORDS, *extra]], "word string"))


CORES = [
    ("Zyx Inc.", None),  # three letters are too few
    ("Zyxw Inc.", "zyxw"),  # a closing company form goes
    ("Zyxw L.t.d.", "zyxw"),
    ("The Zyxw Qua", "zyxw qua"),  # a leading article goes
    ("A an the Zyxw", "zyxw"),
    ("Apple Zyxw Bank of Qua", "apple zyxw"),  # ends before a known word that follows an unknown one
    ("Zyxw Bank", "zyxw bank"),  # the first word does not count as the unknown one
    ("Apple Bank Group", "apple bank group"),
    ("Zyxw, Bank of Qua", "zyxw"),  # only what stands before the comma
    ("Apple Inc.", "apple inc"),  # a short known core gives way to the full name
    ("Apple", None),  # unless that is a known word too
    ("The Gap", "the gap"),
    ("Inc", None),
    ("", None),
    (",", None),
    (None, None),
]


def test_trim_cases(spark):
    df = spark.createDataFrame(CORES, "name string, want string")
    got = trim_company_names(df, {"name": "core"}, words(spark)).collect()
    assert {r.name: r.core for r in got} == dict(CORES)


def test_trim_properties_on_random_names(spark):
    rng = random.Random(3)
    parts = ["Apple", "Bank", "of", "the", "A", "Zyx", "Qua", "Inc.", "Corp", "Group,", "gap", "ETF", "  ", "xy", "(US)"]
    names = sorted({" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 7))) for _ in range(500)})
    df = spark.createDataFrame([(n,) for n in names], "name string")
    plain = {n: n.lower().replace(".", "").replace(",", "") for n in names}
    for r in trim_company_names(df, {"name": "core"}, words(spark)).collect():
        if r.core is None or r.core == plain[r.name]:
            continue
        core = r.core.split()
        assert len(r.core) > 3 and core[0] not in ARTICLES
        before = " ".join(r.name.split(",")[0].lower().split())
        assert f" {r.core} " in f" {before} "
        known = [w in {x.lower() for x in WORDS} for w in core]
        later = [i for i in range(1, len(core)) if not known[i]]
        assert not later or not any(known[later[0] :])


def test_rows_are_kept_when_names_repeat(spark):
    df = spark.createDataFrame([(1, "Zyx Inc"), (2, "Zyx Inc"), (3, None)], "i int, name string")
    got = trim_company_names(df, {"name": "core"}, words(spark)).collect()
    assert sorted((r.i, r.core) for r in got) == [(1, None), (2, None), (3, None)]


def named(spark, rows):
    symbols = spark.createDataFrame(rows, "symbol string, shortName string, longName string")
    return company_names(symbols, words(spark))


def test_company_name_choice(spark):
    rows = [
        ("L", "Shortish Co", "Longish Zyx"),
        ("S", "Shortish", None),
        ("N", None, "Inc"),
        ("PS", "Shortish (US)", "Longish"),
        ("PL", "Shortish", "Longish (US)"),
        ("PB", "Shortish (A)", "Longish (B)"),
    ]
    got = {r.symbol: r.name for r in named(spark, rows).collect()}
    assert got == {"L": "longish zyx", "S": "shortish", "N": "N", "PS": "longish", "PL": "shortish", "PB": "longish (b)"}


def test_terms(spark):
    rows = [("ABC", "General", "General Inc"), ("ZY", "", "Zyxwv Corp"), ("zyxwv", None, "Zyxwv Corp")]
    df = named(spark, rows)
    got = {(r.symbol, r.term_no): (r.term, r.needs_context) for r in comment_terms(df, words(spark)).collect()}
    assert got == {
        ("ABC", 1): ("General", False),
        ("ABC", 2): ("General Inc", False),
        ("ABC", 3): ("general", True),
        ("ABC", 4): ("ABC", True),
        ("ZY", 2): ("Zyxwv Corp", False),
        ("ZY", 3): ("zyxwv", False),
        ("zyxwv", 2): ("Zyxwv Corp", False),
        ("zyxwv", 4): ("zyxwv", True),
    }
    search = {r.symbol: r.search for r in render_terms(tweet_terms(df), " OR ", "%s").collect()}
    assert search == {"ABC": "general OR $ABC", "ZY": "zyxwv OR $ZY", "zyxwv": "$zyxwv"}
    lists = df.select("symbol", match_list(F.col("shortName"), F.col("longName"), F.col("name")).alias("m"))
    assert {r.symbol: r.m for r in lists.collect()}["ZY"] == ["Zyxwv Corp", "zyxwv", "stocks", "shares"]


def test_in_dictionary(spark):
    df = spark.createDataFrame([("APPLE",), ("nope",), (None,)], "w string")
    got = {r.w: r.is_word for r in in_dictionary(df, "w", words(spark)).collect()}
    assert got == {"APPLE": True, "nope": False, None: False}
