"""Projections and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import ASOF, POSTS_SQL, TWEETS_SQL, squeeze_sql, tokens_sql, truncate_sql
from checks.reading import COMMENTS_RAW_SQL
from checks.registry import check
from postlake.functions.text import normalize_text, token_string
from postlake.functions.times import (
    clock_time,
    date_time_text,
    day_of_week,
    derive_calendar,
    epoch_or_zero,
    parse_epoch,
    parse_tweet_time,
)
from postlake.operators.project import (
    clean_bodies,
    derive_comments,
    entities_json,
    project_row,
    row_as_struct,
    split_valid,
    stamp_asof,
    truncate_bodies,
)
from postlake.schemas import REDDIT, TWITTER


def ntz(df, *columns):
    """Times without zone, as SQL shows them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@check(
    "project_tweet_row",
    f"""WITH {POSTS_SQL}, {TWEETS_SQL}
        SELECT id, CAST(n * 10 AS VARCHAR) AS conversation_id, date_trunc('second', ts) AS datetime,
          strftime(ts, '%A') AS day_of_week, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S') AS time,
          favorite_count, false AS favorited, full_text, reply_name AS in_reply_to_screen_name,
          reply_status AS in_reply_to_status_id,
          CASE WHEN reply_name IS NOT NULL THEN CAST((u + 1) % 150 AS VARCHAR) END AS in_reply_to_user_id,
          kind = 'signup' AS is_quote_status, lang, CASE WHEN kind <> 'error' THEN false END AS possibly_sensitive,
          CAST(n % 4 AS INTEGER) AS quote_count, CAST(reply_count AS INTEGER) AS reply_count,
          CAST(retweet_count AS INTEGER) AS retweet_count, false AS retweeted,
          '<a href="https://example.org" rel="nofollow">' || source || '</a>' AS source,
          TIMESTAMP '{ASOF}' AS update_datetime, CAST(u AS VARCHAR) AS user_id,
          '[{{"text":"' || lang || '","indices":[0,2]}}]' AS hashtags,
          '[{{"text":"' || upper(lang) || '","indices":[3,5]}}]' AS symbols,
          CASE WHEN mention IS NULL THEN '[]' ELSE
            '[{{"screen_name":"' || mention || '","id_str":"' || ((u + 2) % 150) || '"}}]' END AS user_mentions,
          CASE WHEN has_url THEN '[{{"expanded_url":"https://example.org/' || n || '"}}]' ELSE '[]' END AS urls,
          date_trunc('second', ts) - INTERVAL 365 DAY AS user_datetime,
          CAST(u * 3 AS INTEGER) AS user_favourites_count, CAST(u * 7 AS INTEGER) AS user_followers_count,
          CAST(u * 2 AS INTEGER) AS user_friends_count, lang AS user_lang,
          CAST(u % 9 AS INTEGER) AS user_listed_count, 'User ' || u AS user_name,
          CAST(u * 6 AS INTEGER) AS user_normal_followers_count, u % 11 = 0 AS user_protected,
          screen_name AS user_screen_name, CAST(u * 5 AS INTEGER) AS user_statuses_count,
          verified AS user_verified
        FROM tw""",
)
def q_project_tweet_row(t):
    return ntz(project_row(t.tweets, TWITTER), "datetime", "update_datetime", "user_datetime")


@check(
    "project_comment_row",
    f"""WITH {COMMENTS_RAW_SQL}, cc AS (
          SELECT *, make_timestamp(created_utc * 1000000) AS dt, {squeeze_sql("body")} AS clean FROM craw),
        {truncate_sql("(SELECT id, clean AS body FROM cc)")}
        SELECT cc.id, link_id, parent_id, CAST(nest_level AS INTEGER) AS nest_level, NULL::VARCHAR AS reply_delay,
          controversiality = 1 AS controversiality, coalesce(short, clean) AS body, dt AS datetime,
          strftime(dt, '%A') AS day_of_week, CAST(dt AS DATE) AS date, strftime(dt, '%H:%M:%S') AS time,
          CAST(score AS INTEGER) AS score, subreddit, subreddit_id, TIMESTAMP '{ASOF}' AS update_datetime,
          author, author_fullname, make_timestamp(coalesce(author_created_utc, 0) * 1000000) AS author_datetime
        FROM cc LEFT JOIN cut ON cc.id = cut.id""",
)
def q_project_comment_row(t):
    rows = project_row(truncate_bodies(clean_bodies(derive_comments(t.comments, ASOF))), REDDIT)
    return ntz(rows, "datetime", "update_datetime", "author_datetime")


@check(
    "parse_tweet_time",
    f"""WITH {POSTS_SQL} SELECT id, CASE WHEN kind <> 'error' THEN date_trunc('second', ts) END AS datetime
        FROM posts""",
)
def q_parse_tweet_time(t):
    text = F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy")
    text = F.when(F.col("kind") == "error", F.concat(F.lit("junk "), text)).otherwise(text)
    return ntz(t.posts.select("id", parse_tweet_time(text).alias("datetime")), "datetime")


@check(
    "parse_epoch",
    f"WITH {COMMENTS_RAW_SQL} SELECT id, make_timestamp(created_utc * 1000000) AS datetime FROM craw",
)
def q_parse_epoch(t):
    return ntz(t.comments.select("id", parse_epoch(F.col("created_utc")).alias("datetime")), "datetime")


@check(
    "author_datetime_default",
    f"""WITH {COMMENTS_RAW_SQL}
        SELECT id, make_timestamp(coalesce(author_created_utc, 0) * 1000000) AS author_datetime FROM craw""",
)
def q_author_datetime_default(t):
    rows = t.comments.select("id", epoch_or_zero(F.col("author_created_utc")).alias("author_datetime"))
    return ntz(rows, "author_datetime")


@check(
    "derive_calendar",
    f"""WITH {POSTS_SQL} SELECT id, strftime(ts, '%A') AS day_of_week, CAST(ts AS DATE) AS date,
          strftime(ts, '%H:%M:%S') AS time FROM posts""",
)
def q_derive_calendar(t):
    return derive_calendar(t.posts, "ts").select("id", "day_of_week", "date", "time")


@check(
    "event_calendar",
    """SELECT strftime(ts, '%A') AS day_of_week, strftime(ts, '%H') AS hour, count(*) AS n_events,
         min(strftime(ts, '%H:%M:%S')) AS first_time FROM events GROUP BY ALL""",
)
def q_event_calendar(t):
    ts = F.col("ts").cast("timestamp")
    parts = t.table("events").select(
        day_of_week(ts).alias("day_of_week"), F.date_format(ts, "HH").alias("hour"), clock_time(ts).alias("time")
    )
    return parts.groupBy("day_of_week", "hour").agg(
        F.count(F.lit(1)).alias("n_events"), F.min("time").alias("first_time")
    )


@check(
    "user_datetime",
    f"""WITH {POSTS_SQL} SELECT id, strftime(ts - INTERVAL 365 DAY, '%Y-%m-%d %H:%M:%S') AS user_datetime
        FROM posts""",
)
def q_user_datetime(t):
    made = F.date_format(F.col("ts") - F.expr("interval 365 days"), "EEE MMM dd HH:mm:ss '+0000' yyyy")
    return t.posts.select("id", date_time_text(parse_tweet_time(made)).alias("user_datetime"))


@check("stamp_asof", f"WITH {POSTS_SQL} SELECT id, TIMESTAMP '{ASOF}' AS update_datetime FROM posts")
def q_stamp_asof(t):
    return ntz(stamp_asof(t.posts, ASOF).select("id", "update_datetime"), "update_datetime")


@check("normalize_text", f"SELECT doc_id, {squeeze_sql('text')} AS text FROM documents")
def q_normalize_text(t):
    return t.documents.select("doc_id", normalize_text(F.col("text")).alias("text"))


@check(
    "truncate_sentences",
    f"""WITH clean AS (SELECT doc_id AS id, {squeeze_sql('text')} AS body FROM documents), {truncate_sql("clean")}
        SELECT c.id AS doc_id, coalesce(short, body) AS text FROM clean c LEFT JOIN cut ON c.id = cut.id""",
)
def q_truncate_sentences(t):
    return truncate_bodies(clean_bodies(t.documents.select("doc_id", "text"), "text"), "text")


@check(
    "reject_nulls",
    f"""WITH {COMMENTS_RAW_SQL}
        SELECT id, CASE WHEN author_fullname IS NULL AND score % 3 = 0 THEN 'body,author'
                        WHEN author_fullname IS NULL THEN 'author' WHEN score % 3 = 0 THEN 'body' ELSE '' END
               AS reject_reason FROM craw""",
)
def q_reject_nulls(t):
    missing = t.comments.withColumns(
        {
            "body": F.when(F.col("score") % 3 != 0, F.col("body")),
            "author": F.when(F.col("author_fullname").isNotNull(), F.col("author")),
        }
    )
    valid, rejects = split_valid(project_row(clean_bodies(derive_comments(missing, ASOF)), REDDIT), REDDIT)
    return valid.select("id", F.lit("").alias("reject_reason")).unionByName(rejects.select("id", "reject_reason"))


@check(
    "entities_json",
    f"""WITH {POSTS_SQL}, {TWEETS_SQL}
        SELECT id, '[{{"text":"' || lang || '","indices":[0,2]}}]' AS hashtags,
          CASE WHEN has_url THEN '[{{"expanded_url":"https://example.org/' || n || '"}}]' ELSE '[]' END AS urls,
          CASE WHEN mention IS NULL THEN '[]' ELSE
            '[{{"screen_name":"' || mention || '","id_str":"' || ((u + 2) % 150) || '"}}]' END AS user_mentions
        FROM tw""",
)
def q_entities_json(t):
    return entities_json(t.tweets).select(F.col("id").cast("string").alias("id"), "hashtags", "urls", "user_mentions")


@check(
    "row_as_struct",
    f"""WITH {POSTS_SQL} SELECT id, '{{"id":"' || id || '","lang":"' || lang || '","score":' || score ||
          ',"kind":"' || kind || '"}}' AS row FROM posts""",
)
def q_row_as_struct(t):
    rows = row_as_struct(t.posts.select("id", "lang", "score", "kind"))
    return rows.select("row.id", F.to_json("row").alias("row"))


@check(
    "string_basics",
    f"""SELECT doc_id, length(text) AS n_chars, lower(text) AS low,
          contains(text, ' the ') AS has_the, starts_with(text, 'The') AS starts_the,
          replace(lang, 'e', '.') AS dotted, len(string_split(text, '. ')) AS n_sentences,
          {tokens_sql("text")} AS tokens FROM documents""",
)
def q_string_basics(t):
    text = F.col("text")
    return t.documents.select(
        "doc_id",
        F.length(text).cast("bigint").alias("n_chars"),
        F.lower(text).alias("low"),
        F.contains(text, F.lit(" the ")).alias("has_the"),
        F.startswith(text, F.lit("The")).alias("starts_the"),
        F.replace("lang", F.lit("e"), F.lit(".")).alias("dotted"),
        F.size(F.split(text, r"\. ", -1)).cast("bigint").alias("n_sentences"),
        token_string(text).alias("tokens"),
    )
