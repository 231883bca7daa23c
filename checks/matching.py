"""Symbol enrichment, post matching, false positives, and the whole ingestion jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.columns import ntz
from checks.inputs import (
    ALL_SYMBOLS_SQL,
    ASOF,
    COMMENT_TERMS_SQL,
    COMPANY_SQL,
    CONTEXT,
    DICTIONARY_SQL,
    PAIRS_SQL,
    POST_TERMS_SQL,
    POSTS_SQL,
    START,
    TWEET_TERMS_SQL,
    TWEETS_SQL,
    keep_sql,
    matched_sql,
    squeeze_sql,
    trim_sql,
    truncate_sql,
)
from checks.reading import COMMENTS_RAW_SQL
from checks.registry import check
from postlake.functions.text import normalize_text
from postlake.functions.times import slice_start
from postlake.operators.enrich import (
    comment_terms,
    company_names,
    in_dictionary,
    match_list,
    render_terms,
    trim_company_names,
    tweet_terms,
)
from postlake.operators.match import (
    drop_false_positives,
    false_positive_counts,
    is_true_match_in,
    match_symbols,
    term_document_counts,
)
from postlake.operators.project import truncate_bodies
from postlake.plans.comments import tag_comments
from postlake.plans.tweets import tag_tweets

_NAMED = f"{ALL_SYMBOLS_SQL}, {DICTIONARY_SQL}"


@check(
    "in_dictionary",
    f"""WITH {_NAMED} SELECT DISTINCT w.word, lower(w.word) IN (SELECT word FROM dictionary) AS is_word
        FROM (SELECT unnest(string_split({squeeze_sql('longName')}, ' ')) AS word FROM symbols) w""",
)
def q_in_dictionary(t):
    words = t.symbols.select(F.explode(F.split(normalize_text(F.col("longName")), " ")).alias("word")).distinct()
    return in_dictionary(words, "word", t.dictionary)


@check(
    "trim_company_name",
    f"""WITH {_NAMED}, {trim_sql("symbols", "longName", "tl")}, {trim_sql("symbols", "shortName", "ts")}
        SELECT symbol, longName, tl.trimmed AS long_trimmed, shortName, ts.trimmed AS short_trimmed
        FROM symbols y LEFT JOIN tl ON y.longName = tl.full_name LEFT JOIN ts ON y.shortName = ts.full_name""",
)
def q_trim_company_name(t):
    return trim_company_names(t.symbols, {"longName": "long_trimmed", "shortName": "short_trimmed"}, t.dictionary)


@check("company_name", f"WITH {_NAMED}, {COMPANY_SQL} SELECT * FROM company")
def q_company_name(t):
    return company_names(t.symbols, t.dictionary)


@check(
    "match_list",
    f"""WITH {_NAMED}, {COMPANY_SQL}
        SELECT symbol, concat_ws('|', shortName, longName, name, 'stocks', 'shares') AS matches FROM company""",
)
def q_match_list(t):
    named = company_names(t.symbols, t.dictionary)
    texts = match_list(F.col("shortName"), F.col("longName"), F.col("name"))
    return named.select("symbol", F.array_join(texts, "|").alias("matches"))


@check(
    "comment_terms",
    f"""WITH {_NAMED}, {COMPANY_SQL}, {COMMENT_TERMS_SQL} SELECT symbol, term_no, term, needs_context FROM cterms""",
)
def q_comment_terms(t):
    named = company_names(t.symbols, t.dictionary)
    return comment_terms(named, t.dictionary).select("symbol", "term_no", "term", "needs_context")


@check(
    "tweet_terms",
    f"""WITH {_NAMED}, {COMPANY_SQL}, {TWEET_TERMS_SQL}
        SELECT symbol, string_agg(term, ' OR ' ORDER BY term_no) AS search FROM tterms GROUP BY symbol""",
)
def q_tweet_terms(t):
    return render_terms(tweet_terms(company_names(t.symbols, t.dictionary)), " OR ", "%s")


@check(
    "term_document_counts",
    f"""WITH {POSTS_SQL}, {POST_TERMS_SQL},
          words AS (SELECT DISTINCT unnest(string_split(phrase, ' ')) AS token
                    FROM (SELECT trim(regexp_replace(lower(term), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', ' ', 'g')) AS phrase
                          FROM cterms)),
          tokens AS (SELECT DISTINCT id, unnest(string_split(
                       trim(regexp_replace(lower(body), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', ' ', 'g')), ' ')) AS token
                     FROM posts)
        SELECT token, count(*) AS n_posts FROM tokens WHERE token <> '' AND token IN (SELECT token FROM words)
        GROUP BY token""",
)
def q_term_document_counts(t):
    return term_document_counts(t.posts, t.comment_terms, "body")


@check("symbol_match", f"WITH {PAIRS_SQL} SELECT symbol, id, term_no, phrase FROM pairs")
def q_symbol_match(t):
    return t.pairs.select("symbol", "id", "term_no", "phrase")


@check("symbol_match_rare_anchor", f"WITH {PAIRS_SQL} SELECT symbol, id, term_no, phrase FROM pairs")
def q_symbol_match_rare_anchor(t):
    """The same match, each term found by its rarest word."""
    terms = t.comment_terms
    counts = term_document_counts(t.clean_posts, terms, "body")
    pairs = match_symbols(t.clean_posts, terms, "body", context_words=CONTEXT, document_counts=counts)
    return pairs.select("symbol", "id", "term_no", "phrase")


@check(
    "symbol_match_default_context",
    f"""WITH {POSTS_SQL}, {POST_TERMS_SQL},
          {matched_sql("posts", "body", "cterms", "pairs", ("stocks", "shares"))}
        SELECT symbol, id, term_no FROM pairs""",
)
def q_symbol_match_default_context(t):
    return match_symbols(t.posts, t.comment_terms, "body").select("symbol", "id", "term_no")


@check(
    "symbol_match_by_shuffle",
    f"WITH {PAIRS_SQL} SELECT symbol, id, term_no, phrase FROM pairs",
)
def q_symbol_match_by_shuffle(t):
    """The same match as done for term tables too large to broadcast."""
    pairs = match_symbols(t.clean_posts, t.comment_terms, "body", context_words=CONTEXT, max_rows=0)
    return pairs.select("symbol", "id", "term_no", "phrase")


_TRUNCATED = f"""{PAIRS_SQL}, {truncate_sql("clean")},
  tpairs AS (SELECT p.* REPLACE (coalesce(short, p.body) AS body) FROM pairs p LEFT JOIN cut ON p.id = cut.id)"""


@check(
    "false_positive_filter",
    f"WITH {_TRUNCATED} SELECT symbol, id, length(body) AS n_chars FROM tpairs WHERE {keep_sql('body', CONTEXT)}",
)
def q_false_positive_filter(t):
    kept = drop_false_positives(truncate_bodies(t.pairs), "body", CONTEXT)
    return kept.select("symbol", "id", F.length("body").cast("bigint").alias("n_chars"))


@check(
    "false_positive_counts",
    f"""WITH {_TRUNCATED} SELECT symbol, count(*) AS n_matched,
          count(*) FILTER (WHERE NOT {keep_sql('body', ('stocks', 'shares'))}) AS n_removed
        FROM tpairs GROUP BY symbol""",
)
def q_false_positive_counts(t):
    return false_positive_counts(truncate_bodies(t.pairs), "body")


@check(
    "false_positive_match_list",
    f"""WITH {_TRUNCATED} SELECT symbol, id FROM tpairs WHERE {keep_sql('body', ('stocks', 'shares'))}""",
)
def q_false_positive_match_list(t):
    """The same filter with the match texts held in an array."""
    texts = match_list(F.col("shortName"), F.col("longName"), F.col("name"))
    pairs = truncate_bodies(t.pairs)
    return pairs.where(is_true_match_in(F.col("body"), F.col("symbol"), texts)).select("symbol", "id")


@check(
    "symbol_slices",
    f"""WITH {_TRUNCATED} SELECT symbol, time_bucket(INTERVAL 3 DAY, ts, TIMESTAMP '{START}') AS slice_start,
          count(*) AS n_posts, min(ts) AS first_datetime, max(ts) AS last_datetime
        FROM tpairs WHERE {keep_sql('body', CONTEXT)} GROUP BY ALL""",
)
def q_symbol_slices(t):
    kept = drop_false_positives(truncate_bodies(t.pairs), "body", CONTEXT)
    placed = kept.withColumn("slice_start", slice_start(F.col("datetime"), F.lit(START).cast("timestamp")))
    stats = placed.groupBy("symbol", "slice_start").agg(
        F.count(F.lit(1)).alias("n_posts"),
        F.min("datetime").alias("first_datetime"),
        F.max("datetime").alias("last_datetime"),
    )
    return ntz(stats, "slice_start", "first_datetime", "last_datetime")


@check(
    "ingest_comments",
    f"""WITH {COMMENTS_RAW_SQL}, {POST_TERMS_SQL},
          cc AS (SELECT * REPLACE ({squeeze_sql("body")} AS body), make_timestamp(created_utc * 1000000) AS dt
                 FROM craw WHERE score > 0),
          {matched_sql("cc", "body", "cterms", "pairs", CONTEXT)}, {truncate_sql("cc")},
          tpairs AS (SELECT p.* REPLACE (coalesce(short, p.body) AS body) FROM pairs p LEFT JOIN cut ON p.id = cut.id)
        SELECT symbol, id, body, dt AS datetime, CAST(score AS INTEGER) AS score, author FROM tpairs
        WHERE {keep_sql('body', CONTEXT)}""",
)
def q_ingest_comments(t):
    rows = tag_comments(t.comments, t.comment_terms, ASOF, context_words=CONTEXT)
    return ntz(rows.select("symbol", "id", "body", "datetime", "score", "author"), "datetime")


@check(
    "ingest_tweets",
    f"""WITH {POSTS_SQL}, {TWEETS_SQL}, {POST_TERMS_SQL},
          found AS (SELECT * FROM tw WHERE NOT is_retweet AND full_text NOT LIKE 'RT @%'),
          {matched_sql("found", "full_text", "tterms", "pairs", (), cashtags=True)}
        SELECT symbol, id, full_text, date_trunc('second', ts) AS datetime, screen_name AS user_screen_name
        FROM pairs""",
)
def q_ingest_tweets(t):
    rows = tag_tweets(t.tweets, t.tweet_terms, ASOF)
    return ntz(rows.select("symbol", "id", "full_text", "datetime", "user_screen_name"), "datetime")
