"""Which post speaks of which symbol.

Every post is compared with every symbol's terms through one equality join on an anchor: the word of a one-word phrase,
two neighbouring words of a longer one. No pair of post and symbol is formed unless the post holds an anchor of one of
the symbol's terms, and common words alone make no candidates of longer phrases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.text import any_of, has_phrase, padded_tokens, token_string
from postlake.operators.anchors import found_anchors, found_words, wanted_hashes
from postlake.operators.enrich import CONTEXT_WORDS
from postlake.operators.sizing import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, broadcast_if_small, compute_once, stored

PADDED = "_padded"
FALLBACK_SALTS = 32


def term_document_counts(posts: DataFrame, terms: DataFrame, text: str = "body", cashtags: bool = False) -> DataFrame:
    """In how many posts each word of a term occurs: (token, n_posts), for choosing rare anchors.

    Words no term uses are dropped before counting, and counts are reduced before the shuffle.
    """
    wanted = (
        terms.select(F.explode(F.split(token_string(F.col("term"), cashtags), " ")).alias("token"))
        .where(F.col("token") != "")
        .distinct()
    )
    wanted, small = broadcast_if_small(wanted)
    if small:
        words = found_words(posts.sparkSession, F.col(text), cashtags, wanted_hashes(wanted))
    else:
        words = _words(padded_tokens(F.col(text), cashtags))
    tokens = posts.select(F.explode(F.array_distinct(words)).alias("token"))
    return tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n_posts"))


def prepare_terms(terms: DataFrame, cashtags: bool = False, document_counts: DataFrame | None = None) -> DataFrame:
    """Terms ready for joining: phrase, anchor word, and the symbol's earlier phrases.

    The anchor is the phrase's only word, else a pair of neighbouring words: the one with the rarest word by
    ``document_counts``, else the one that fewest phrases share, the longer one of two. The earlier phrases let a match be reported once per post and
    symbol, at the first of the symbol's terms that holds, with no ``distinct`` over the posts
    afterwards. The terms are computed once, however many steps here read them.
    """
    terms = stored(terms, "terms")
    carried = [c for c in terms.columns if c not in ("symbol", "term_no", "term", "needs_context")]
    phrases = terms.withColumn("phrase", token_string(F.col("term"), cashtags)).where(F.col("phrase") != "")
    anchors = _phrase_anchors(phrases.select("phrase").distinct())
    if document_counts is None:
        weighed = anchors.join(anchors.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token")
    else:
        counts = document_counts.select(F.col("token").alias("_word"), F.col("n_posts").alias("_n"))
        words = anchors.select("phrase", "token", F.explode(F.split("token", " ")).alias("_word"))
        rarest_word = F.min(F.coalesce("_n", F.lit(0)))
        weighed = words.join(counts, "_word", "left").groupBy("phrase", "token").agg(rarest_word.alias("n"))
    order = F.struct("n", -F.length("token"), "token")
    rarest = weighed.groupBy("phrase").agg(F.min_by("token", order).alias("anchor"))
    anchored = phrases.join(rarest, "phrase")

    columns = ["term_no", "phrase", "needs_context", "anchor", *carried]
    per_symbol = anchored.groupBy("symbol").agg(F.collect_set(F.struct(*columns)).alias("siblings"))
    each = per_symbol.select("symbol", "siblings", F.explode("siblings").alias("t"))

    def earlier(context: bool) -> Column:
        mine = F.filter(
            "siblings", lambda s: (s["term_no"] < F.col("t.term_no")) & (s["needs_context"] == F.lit(context))
        )
        return F.transform(mine, lambda s: s["phrase"])

    return each.select(
        "symbol", "t.*", earlier(False).alias("_earlier"), earlier(True).alias("_earlier_in_context")
    )


def _words(padded: Column) -> Column:
    return F.split(F.trim(padded), " ")


def _pairs(padded: Column) -> Column:
    """Neighbouring words, joined by a space, so that no pair equals a word. A look-ahead finds overlapping ones; lambdas
    over the words would leave generated code."""
    return F.regexp_extract_all(padded, F.lit(r"(?<= )(?=(\S+ \S+) )"), F.lit(1))


def _phrase_anchors(phrases: DataFrame) -> DataFrame:
    """(phrase, token): what each phrase may be anchored at."""
    padded = F.concat(F.lit(" "), F.col("phrase"), F.lit(" "))
    anchors = F.when(F.contains(F.col("phrase"), F.lit(" ")), _pairs(padded)).otherwise(F.array("phrase"))
    return phrases.select("phrase", F.explode(F.array_distinct(anchors)).alias("token"))


def _post_anchors(padded: DataFrame, name: str) -> DataFrame:
    """Each row once under each distinct word and pair of neighbouring words of its text."""
    both = F.concat(_words(F.col(PADDED)), _pairs(F.col(PADDED)))
    return padded.select("*", F.explode(F.array_distinct(both)).alias(name))


def _verified(pairs: DataFrame, context_words: tuple[str, ...], has_anchor: bool) -> DataFrame:
    """Pairs whose phrase holds, in context if it needs one, and no earlier term of the symbol holds.

    ``has_anchor``: the anchor is known to be in this very text, which settles phrases of one or two words. Earlier terms are looked
    up only for pairs that hold, and after the join, which stays in generated code so.
    """
    padded = F.col(PADDED)
    in_context = any_of([F.contains(padded, F.lit(f" {w} ")) for w in context_words])
    found = has_phrase(padded, F.col("phrase"))
    if has_anchor:
        found = (F.col("phrase") == F.col("anchor")) | found

    def any_in(phrases: str) -> Column:
        return (F.size(phrases) > 0) & F.exists(phrases, lambda p: has_phrase(padded, p))

    holding = pairs.where(found & (~F.col("needs_context") | in_context))
    is_first = ~(any_in("_earlier") | (any_in("_earlier_in_context") & in_context))
    return compute_once(holding, "_first", is_first).where("_first").drop("_first")


def match_symbols(
    posts: DataFrame,
    terms: DataFrame,
    text: str = "body",
    id_cols: tuple[str, ...] = ("id",),
    context_words: tuple[str, ...] = CONTEXT_WORDS,
    cashtags: bool = False,
    document_counts: DataFrame | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Each post once under each symbol it matches: post columns, symbol, ``term_no``, ``phrase`` and
    the terms' further columns.

    Matching is by whole words, ignoring case. With terms of a measured small size the posts are
    not shuffled at all, and words that are no anchor are left out before they are rows; beyond that
    :func:`_match_by_shuffle` gives the same rows.
    """
    ready, small = broadcast_if_small(prepare_terms(terms, cashtags, document_counts), max_rows, max_bytes)
    out = [*posts.columns, *[c for c in ready.columns if c not in ("needs_context", "anchor") and c[0] != "_"]]
    if not small:
        padded = compute_once(posts, PADDED, padded_tokens(F.col(text), cashtags))
        return _match_by_shuffle(padded, ready, id_cols, context_words).select(*out)
    made = found_anchors(posts.sparkSession, F.col(text), cashtags, wanted_hashes(ready.select("anchor")))
    found = compute_once(posts, "_found", made)
    words = found.select(
        *posts.columns,
        F.col("_found.padded").alias(PADDED),
        F.explode(F.array_distinct("_found.anchors")).alias("anchor"),
    )
    return _verified(words.join(ready, "anchor"), context_words, has_anchor=True).select(*out)


def _match_by_shuffle(
    padded: DataFrame, ready: DataFrame, id_cols: tuple[str, ...], context_words: tuple[str, ...]
) -> DataFrame:
    """Only (post id, anchor) pairs are shuffled, salted since common words are hot; the texts join
    the few candidates afterwards. Copies of one id share their candidates, and each is verified by its
    own text; where such copies are many, adaptive execution splits their side of that join. Posts without
    an id are told apart by their text, so that they are not one key."""
    ids = [*id_cols, "_of_text"]
    unnamed = any_of([F.col(i).isNull() for i in id_cols])
    padded = padded.withColumn("_of_text", F.when(unnamed, F.xxhash64(PADDED)))
    keys = _post_anchors(padded, "anchor").select(*ids, "anchor")
    keys = keys.join(ready.select("anchor").distinct(), "anchor", "left_semi").withColumn(
        "_salt", F.pmod(F.xxhash64(*ids), F.lit(FALLBACK_SALTS)).cast("int")
    )
    salted = ready.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(FALLBACK_SALTS - 1))))
    named = {i: f"_key_{n}" for n, i in enumerate(ids)}
    candidates = keys.join(salted, ["anchor", "_salt"]).drop("_salt").withColumnsRenamed(named).distinct()
    same = [padded[i].eqNullSafe(candidates[k]) for i, k in named.items()]
    return _verified(padded.join(candidates, same), context_words, has_anchor=False)


def is_true_match(body: Column, symbol: Column, matches: list[Column]) -> Column:
    """False-positive test: a match text occurs in the body in any case, or the symbol as written.

    NULL and empty match texts confirm nothing.
    """
    low = F.lower(body)
    hits = [F.coalesce((m != "") & F.contains(low, F.lower(m)), F.lit(False)) for m in matches]
    return any_of(hits) | F.coalesce(F.contains(body, symbol), F.lit(False))


def is_true_match_in(body: Column, symbol: Column, matches: Column) -> Column:
    """:func:`is_true_match` for match texts held in an array."""
    low = F.lower(body)
    hit = F.exists(matches, lambda m: (m != "") & F.contains(low, F.lower(m)))
    return F.coalesce(hit, F.lit(False)) | F.coalesce(F.contains(body, symbol), F.lit(False))


def name_columns(context_words: tuple[str, ...] = CONTEXT_WORDS) -> list[Column]:
    """Match texts of a pair that carries its symbol's names."""
    return [F.col("shortName"), F.col("longName"), F.col("name"), *[F.lit(w) for w in context_words]]


def drop_false_positives(
    pairs: DataFrame, body: str = "body", context_words: tuple[str, ...] = CONTEXT_WORDS
) -> DataFrame:
    return pairs.where(is_true_match(F.col(body), F.col("symbol"), name_columns(context_words)))


def observe_false_positives(
    pairs: DataFrame, metric: str, body: str = "body", context_words: tuple[str, ...] = CONTEXT_WORDS
) -> DataFrame:
    """:func:`drop_false_positives` that reports ``n_matched`` and ``n_removed`` as an observed metric,
    per run or, on a stream, per micro-batch."""
    keep = is_true_match(F.col(body), F.col("symbol"), name_columns(context_words))
    counts = (F.count(F.lit(1)).alias("n_matched"), F.count_if(~keep).alias("n_removed"))
    return pairs.observe(metric, *counts).where(keep)


def false_positive_counts(
    pairs: DataFrame, body: str = "body", context_words: tuple[str, ...] = CONTEXT_WORDS
) -> DataFrame:
    """Per symbol: matched pairs and how many of them the filter removes."""
    keep = is_true_match(F.col(body), F.col("symbol"), name_columns(context_words))
    return pairs.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_matched"), F.count_if(~keep).alias("n_removed")
    )
