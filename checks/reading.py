"""Sources and flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import ALL_SYMBOLS_SQL, POSTS_SQL, squeeze_sql
from checks.registry import check
from postlake.functions.text import normalize_text
from postlake.operators.flatten import (
    WRONG_TYPE,
    drop_promoted,
    enrich_retweets,
    flatten_comments,
    flatten_tweets,
    join_tweets,
    join_users,
    resolve_tweet_ids,
    timeline_entries,
    tweet_rejects,
)
from postlake.session import shared_dir
from postlake.sources.responses import value_rejects
from postlake.sources.symbols import dictionary_words, read_dictionary, read_symbols

_RAW = ALL_SYMBOLS_SQL


@check("symbol_scan", f"WITH {_RAW} SELECT symbol, shortName, longName, pos AS file_pos FROM master ORDER BY symbol")
def symbol_scan(t):
    return t.master.orderBy("symbol")


@check("symbol_last_wins", f"WITH {_RAW} SELECT symbol, shortName, longName FROM symbols")
def symbol_last_wins(t):
    return t.symbols


@check(
    "dictionary_scan",
    f"""SELECT DISTINCT lower(w) AS word
        FROM (SELECT unnest(string_split({squeeze_sql('text')}, ' ')) AS w FROM conversations) WHERE w <> ''""",
)
def dictionary_scan(t):
    lines = t.table("conversations").select(F.explode(F.split(normalize_text(F.col("text")), " ")).alias("word"))
    return dictionary_words(lines)


@check(
    "symbol_file_scan",
    f"""WITH {_RAW} SELECT symbol, shortName, '"' || longName || '" or ' || longName AS longName FROM master""",
)
def q_symbol_file_scan(t):
    """The master as files with a header, columns in another order, quotes and separators inside values."""
    path = shared_dir(t.spark, "master")
    quoted = F.concat(F.lit('"'), F.col("longName"), F.lit('" or '), F.col("longName")).alias("longName")
    rows = t.master.select(quoted, F.lit("X|Y").alias("exchange"), "symbol", "shortName")
    keep = {"sep": "|", "header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**keep).csv(path)
    return read_symbols(t.spark, path).drop("file_pos")


@check(
    "dictionary_file_scan",
    f"""SELECT DISTINCT lower(w) AS word
        FROM (SELECT unnest(string_split({squeeze_sql('text')}, ' ')) AS w FROM conversations) WHERE w <> ''""",
)
def q_dictionary_file_scan(t):
    path = shared_dir(t.spark, "words")
    t.table("conversations").select(F.explode(F.split(normalize_text(F.col("text")), " "))).write.text(path)
    return read_dictionary(t.spark, path)


# What a response of each post holds: entries 0 to 4 show tweets, 5 is promoted, 6 has no id.
ENTRIES_SQL = f"""{POSTS_SQL},
  offs AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS pos),
  entries AS (
    SELECT p.*, pos, CASE WHEN pos = 1 THEN 'sq-I-t-' || (n * 10 + 1) WHEN pos = 5 THEN 'tweet-' || (n * 10)
                          WHEN pos = 6 THEN 'tweet-unknown' ELSE 'tweet-' || (n * 10 + pos) END AS entry_id,
           CASE WHEN pos = 5 THEN CAST(n * 10 AS VARCHAR) WHEN pos < 5 THEN CAST(n * 10 + pos AS VARCHAR) END AS tid
    FROM posts p CROSS JOIN offs WHERE score > 0),
  shown AS (
    SELECT * FROM entries
    WHERE pos = 0 OR (pos = 1 AND kind = 'view') OR (pos = 2 AND kind = 'error')
       OR (pos = 3 AND kind = 'signup') OR (pos = 4 AND kind = 'purchase')),
  flat AS (
    SELECT *, CASE WHEN pos IN (1, 2) THEN 'RT ' || pos || ': ' || body ELSE body END AS full_text,
           CASE WHEN pos = 1 THEN CAST(n * 10 AS VARCHAR) WHEN pos = 2 THEN CAST(n * 10 + 9 AS VARCHAR) END AS rtid
    FROM shown WHERE pos <> 3)"""


@check(
    "timeline_entries", f"WITH {ENTRIES_SQL} SELECT id AS response_id, pos AS entry_pos, entry_id FROM entries"
)
def q_timeline_entries(t):
    return timeline_entries(t.responses).select("response_id", "entry_pos", F.col("entry.entryId").alias("entry_id"))


@check(
    "tweet_id_resolve",
    f"WITH {ENTRIES_SQL} SELECT id AS response_id, pos AS entry_pos, tid AS tweet_id FROM entries",
)
def q_tweet_id_resolve(t):
    return resolve_tweet_ids(timeline_entries(t.responses)).select("response_id", "entry_pos", "tweet_id")


@check(
    "drop_promoted",
    f"WITH {ENTRIES_SQL} SELECT id AS response_id, pos AS entry_pos, entry_id FROM entries WHERE pos <> 5",
)
def q_drop_promoted(t):
    return drop_promoted(timeline_entries(t.responses)).select(
        "response_id", "entry_pos", F.col("entry.entryId").alias("entry_id")
    )


@check(
    "entry_tweet_join",
    f"""WITH {ENTRIES_SQL} SELECT id AS response_id, pos AS entry_pos, tid AS tweet_id, length(
          CASE WHEN pos IN (1, 2, 3) THEN 'RT ' || pos || ': ' || body ELSE body END) AS n_chars FROM shown""",
)
def q_entry_tweet_join(t):
    entries = drop_promoted(resolve_tweet_ids(timeline_entries(t.responses)))
    return join_tweets(entries).select(
        "response_id", "entry_pos", "tweet_id", F.length("tweet.full_text").cast("bigint").alias("n_chars")
    )


@check(
    "tweet_user_join",
    f"""WITH {ENTRIES_SQL} SELECT id AS response_id, tid AS tweet_id,
          CASE WHEN pos <> 3 THEN 'User_' || u END AS screen_name FROM shown""",
)
def q_tweet_user_join(t):
    entries = drop_promoted(resolve_tweet_ids(timeline_entries(t.responses)))
    return join_users(join_tweets(entries)).select(
        "response_id", "tweet_id", F.col("user_data.screen_name").alias("screen_name")
    )


@check(
    "retweet_enrich",
    f"""WITH {ENTRIES_SQL} SELECT tid AS tweet_id,
          CASE WHEN pos = 1 THEN CAST(u AS VARCHAR) END AS user_rtid,
          CASE WHEN pos = 1 THEN body END AS user_rt,
          CASE WHEN pos = 1 THEN rtid END AS retweet_id,
          CASE WHEN pos = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' END AS retweet_date
        FROM flat WHERE rtid IS NOT NULL""",
)
def q_retweet_enrich(t):
    entries = drop_promoted(resolve_tweet_ids(timeline_entries(t.responses)))
    tweets = enrich_retweets(join_tweets(entries)).where(F.col("tweet.retweeted_status_id_str").isNotNull())
    return tweets.select("tweet_id", "retweet_data").select(
        "tweet_id", *[F.col(f"retweet_data.{c}") for c in ("user_rtid", "user_rt", "retweet_id", "retweet_date")]
    )


@check(
    "tweet_flatten",
    f"""WITH {ENTRIES_SQL} SELECT id AS response_id, pos AS entry_pos, CAST(tid AS BIGINT) AS id, full_text,
          'User_' || u AS screen_name, score AS favorite_count, rtid, pos = 1 AS has_retweet_data FROM flat""",
)
def q_tweet_flatten(t):
    return flatten_tweets(t.responses).select(
        "response_id",
        "entry_pos",
        "id",
        "full_text",
        F.col("user_data.screen_name").alias("screen_name"),
        "favorite_count",
        F.col("retweeted_status_id_str").alias("rtid"),
        F.col("retweet_data").isNotNull().alias("has_retweet_data"),
    )


@check(
    "tweet_rejects",
    f"""WITH {ENTRIES_SQL}
        SELECT id AS response_id, pos AS entry_pos, NULL::VARCHAR AS tweet_id, 'no_tweet_id' AS reject_reason
        FROM entries WHERE pos = 6
        UNION ALL SELECT id, pos, tid, 'no_user' FROM shown WHERE pos = 3""",
)
def q_tweet_rejects(t):
    return tweet_rejects(t.responses)


COMMENTS_RAW_SQL = f"""{POSTS_SQL},
  craw AS (
    SELECT n || '-' || (pos - 1) AS id, 't3_' || n AS link_id,
           CASE WHEN pos > 1 THEN n || '-' || (pos - 2) END AS parent_id, pos AS nest_level,
           (pos - 1) % 2 AS controversiality, body, CAST(epoch_us(ts) // 1000000 AS BIGINT) + pos - 1 AS created_utc,
           score - (pos - 1) AS score, source AS subreddit, 't5_' || source AS subreddit_id,
           'user_' || u AS author, CASE WHEN u % 3 > 0 THEN 't2_' || u END AS author_fullname,
           CASE WHEN u % 4 > 0 THEN u * 86400 * 30 END AS author_created_utc
    FROM (SELECT * EXCLUDE (body), generate_subscripts(lines, 1) AS pos, unnest(lines) AS body
          FROM (SELECT *, string_split(body, chr(10)) AS lines FROM posts)))"""


@check(
    "comment_flatten",
    f"""WITH {COMMENTS_RAW_SQL} SELECT id, link_id, parent_id, CAST(nest_level AS INTEGER) AS nest_level,
          CAST(controversiality AS INTEGER) AS controversiality, body, created_utc,
          CAST(score AS INTEGER) AS score, author, author_fullname, author_created_utc FROM craw""",
)
def q_comment_flatten(t):
    return t.comments.select(
        "id", "link_id", "parent_id", "nest_level", "controversiality", "body", "created_utc", "score",
        "author", "author_fullname", "author_created_utc",
    )


# Files of lines in which values take other forms than the shape states


@check(
    "comment_page_files",
    f"""WITH {COMMENTS_RAW_SQL}, craw2 AS (SELECT *, CAST(split_part(link_id, '_', 2) AS BIGINT) AS post FROM craw)
        SELECT id, link_id, CAST(nest_level AS INTEGER) AS nest_level, body, created_utc,
          CASE WHEN post % 7 > 0 THEN CAST(score AS INTEGER) END AS score, author, author_created_utc FROM craw2""",
)
def q_comment_page_files(t):
    return flatten_comments(t.page_files).select(
        "id", "link_id", "nest_level", "body", "created_utc", "score", "author", "author_created_utc"
    )


@check(
    "comment_value_rejects",
    f"""WITH {COMMENTS_RAW_SQL} SELECT 'data.' || (nest_level - 1) || '.score' AS path, 'many' AS value, count(*) AS n
        FROM craw WHERE CAST(split_part(link_id, '_', 2) AS BIGINT) % 7 = 0 GROUP BY ALL""",
)
def q_comment_value_rejects(t):
    return value_rejects(t.page_files).groupBy("path", "value").agg(F.count(F.lit(1)).alias("n"))


@check(
    "tweet_response_files",
    f"""WITH {ENTRIES_SQL} SELECT id AS response_id, pos AS entry_pos, CAST(tid AS BIGINT) AS id, full_text,
          CAST(n % 50 AS INTEGER) AS retweet_count, CASE WHEN n % 5 > 0 AND kind <> 'error' THEN false END AS possibly_sensitive
        FROM flat WHERE n % 11 > 0""",
)
def q_tweet_response_files(t):
    return flatten_tweets(t.response_files).select(
        "response_id", "entry_pos", "id", "full_text", "retweet_count", "possibly_sensitive"
    )


@check(
    "tweet_file_rejects",
    f"""WITH {ENTRIES_SQL}
        SELECT id AS response_id, CAST(pos AS VARCHAR) AS place, 'no_tweet_id' AS reject_reason
        FROM entries WHERE pos = 6 AND n % 11 > 0
        UNION ALL SELECT id, CAST(pos AS VARCHAR), 'no_user' FROM shown WHERE pos = 3 AND n % 11 > 0
        UNION ALL SELECT id, NULL, 'no_entries' FROM posts WHERE n % 11 = 0 AND score > 0
        UNION ALL SELECT id, 'globalObjects.tweets.' || tid || '.possibly_sensitive', 'value_of_wrong_type' FROM shown
                  WHERE n % 5 = 0 AND kind <> 'error'""",
)
def q_tweet_file_rejects(t):
    """Entries, responses and single values that cannot be used."""
    responses = t.response_files
    whole = tweet_rejects(responses).select("response_id", F.col("entry_pos").cast("string").alias("place"), "reject_reason")
    values = value_rejects(responses, ("response_id",)).select(
        "response_id", F.col("path").alias("place"), F.lit(WRONG_TYPE).alias("reject_reason")
    )
    return whole.unionByName(values)
