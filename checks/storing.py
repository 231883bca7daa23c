"""Tables, first rows, counts, incremental runs and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.columns import ntz
from checks.inputs import (
    ASOF,
    CONTEXT,
    CUTOFF,
    PAIRS_SQL,
    POST_TERMS_SQL,
    POSTS_SQL,
    START,
    TWEETS_SQL,
    keep_sql,
    matched_sql,
    spread_time,
    squeeze_sql,
    truncate_sql,
)
from checks.reading import COMMENTS_RAW_SQL, ENTRIES_SQL
from checks.registry import check
from postlake.functions.times import slice_start
from postlake.operators.incremental import (
    incremental_select,
    recency_skip,
    resume_points,
    slice_grid,
    slice_stats,
)
from postlake.operators.match import match_symbols
from postlake.operators.project import clean_bodies, derive_comments
from postlake.operators.stats import (
    get_first,
    newest,
    oldest,
    posts_union,
    size_by_symbol,
    sort_comments,
    sort_tweets,
)
from postlake.operators.table import PostTable, route_by_network, scratch_database
from postlake.plans.job import Run, run_comments, run_tweets
from postlake.plans.tweets import tag_tweets
from postlake.schemas import REDDIT, TWITTER
from postlake.session import shared_dir
from postlake.streaming.ingest import append_files, append_new, slice_stats_stream

BUCKETS = 8
HOURS = 72
RECENCY = dt.timedelta(days=2)
DELAY = "1 hour"


def before_cutoff(df):
    return df.where(F.col("datetime") < F.lit(CUTOFF).cast("timestamp"))


def new_table(t, network=REDDIT) -> PostTable:
    return PostTable(t.spark, scratch_database(t.spark), network, BUCKETS)


def filled_table(t) -> PostTable:
    """All matched posts, stored."""
    table = new_table(t)
    table.insert_ignore(t.stored_comments(t.pairs))
    return table


# First rows, counts, sorts

_FIRST = """SELECT symbol, id, ts AS datetime, score FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {key} {way}, id {way}) AS rn FROM pairs) WHERE rn = 1"""


def _first_columns(df):
    return ntz(df.select("symbol", "id", "datetime", "score"), "datetime")


@check("get_first", f"WITH {PAIRS_SQL} {_FIRST.format(key='score', way='DESC')}")
def q_get_first(t):
    return _first_columns(get_first(t.stored_comments(t.pairs), "score", "DESC"))


@check("newest", f"WITH {PAIRS_SQL} {_FIRST.format(key='ts', way='DESC')}")
def q_newest(t):
    return _first_columns(newest(t.stored_comments(t.pairs)))


@check("oldest", f"WITH {PAIRS_SQL} {_FIRST.format(key='ts', way='ASC')}")
def q_oldest(t):
    return _first_columns(oldest(t.stored_comments(t.pairs)))


@check(
    "size_by_symbol",
    f"""WITH {PAIRS_SQL}, n AS (SELECT symbol, count(*) AS n_rows FROM pairs GROUP BY symbol)
        SELECT symbol, n_rows FROM symbols LEFT JOIN n USING (symbol)""",
)
def q_size_by_symbol(t):
    return size_by_symbol(t.pairs, t.symbols)


@check(
    "sort_comments",
    f"""WITH {COMMENTS_RAW_SQL} SELECT id, created_utc, CAST(score AS INTEGER) AS score FROM craw
        ORDER BY created_utc, id""",
)
def q_sort_comments(t):
    return sort_comments(t.comments.select("id", "created_utc", "score"))


@check("sort_tweets", f"WITH {POSTS_SQL}, {TWEETS_SQL} SELECT id, lang FROM tw ORDER BY CAST(id AS BIGINT)")
def q_sort_tweets(t):
    return sort_tweets(t.tweets.select(F.col("id").cast("string").alias("id"), "lang"))


@check(
    "posts_union",
    f"""WITH {COMMENTS_RAW_SQL}, {TWEETS_SQL}
        SELECT 'twitter' AS network, id, full_text AS body, date_trunc('second', ts) AS datetime,
               screen_name AS author FROM tw
        UNION ALL SELECT 'reddit', id, {squeeze_sql("body")}, make_timestamp(created_utc * 1000000), author FROM craw""",
)
def q_posts_union(t):
    comments = clean_bodies(derive_comments(t.comments, ASOF))
    tweets = t.tweets.withColumn("id", F.col("id").cast("string"))
    return ntz(posts_union(tweets, comments), "datetime")


# Tables


@check(
    "create_table_schema",
    f"""WITH {PAIRS_SQL} SELECT symbol, id, body, ts AS datetime, strftime(ts, '%A') AS day_of_week,
          CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S') AS time, score, strftime(ts, '%Y-%m') AS month
        FROM pairs""",
)
def q_create_table_schema(t):
    table = filled_table(t)
    table.create()
    rows = table.read().select("symbol", "id", "body", "datetime", "day_of_week", "date", "time", "score", "month")
    return ntz(rows, "datetime")


@check(
    "insert_ignore",
    f"""WITH {PAIRS_SQL} SELECT symbol, id, ts AS datetime, length(body) AS n_chars,
          CASE WHEN ts < TIMESTAMP '{CUTOFF}' THEN 'v1' ELSE 'v2' END AS version FROM pairs""",
)
def q_insert_ignore(t):
    """Old posts are stored; the batch brings them again, and every post twice."""
    table = new_table(t)
    table.insert_ignore(before_cutoff(t.stored_comments(t.pairs, "v1")))
    batch = t.stored_comments(t.pairs, "v3", hours=2).unionByName(t.stored_comments(t.pairs, "v2", hours=1))
    table.insert_ignore(batch)
    return _versions(table)


def _versions(table):
    rows = table.read().select(
        "symbol",
        "id",
        "datetime",
        F.length("body").cast("bigint").alias("n_chars"),
        F.col("reply_delay").alias("version"),
    )
    return ntz(rows, "datetime")


@check(
    "insert_ignore_stable_datetime",
    f"""WITH {PAIRS_SQL} SELECT symbol, id, ts AS datetime, length(body) AS n_chars, 'v1' AS version FROM pairs""",
)
def q_insert_ignore_stable(t):
    """A repeated insert adds nothing; stored keys are read from the batch's months only."""
    table = filled_table(t)
    table.insert_ignore(t.stored_comments(t.pairs, "v2", hours=1), stable_datetime=True)
    return _versions(table)


@check(
    "delete_recent",
    f"""WITH {PAIRS_SQL} SELECT symbol, id, ts AS datetime FROM pairs
        WHERE ts <= TIMESTAMP '{ASOF}' - INTERVAL {HOURS} HOUR""",
)
def q_delete_recent(t):
    table = filled_table(t)
    table.delete_recent(ASOF, HOURS)
    return ntz(table.read().select("symbol", "id", "datetime"), "datetime")


@check(
    "delete_recent_count",
    f"""WITH {PAIRS_SQL} SELECT count(*) FILTER (WHERE ts > TIMESTAMP '{ASOF}' - INTERVAL {HOURS} HOUR) AS n_deleted,
          count(*) FILTER (WHERE ts <= TIMESTAMP '{ASOF}' - INTERVAL {HOURS} HOUR) AS n_left FROM pairs""",
)
def q_delete_recent_count(t):
    table = filled_table(t)
    deleted = table.delete_recent(ASOF, HOURS)
    return table.read().agg(F.count(F.lit(1)).alias("n_left")).select(
        F.lit(deleted).cast("bigint").alias("n_deleted"), "n_left"
    )


# What is left of two inserts, a delete of recent rows and one of a symbol.
_LEFT = f"""{PAIRS_SQL},
  kept AS (SELECT * FROM pairs WHERE ts <= TIMESTAMP '{ASOF}' - INTERVAL {HOURS} HOUR AND symbol <> 'THAT')"""


def changed_table(t) -> PostTable:
    table = new_table(t)
    rows = t.stored_comments(t.pairs)
    table.insert_ignore(before_cutoff(rows))
    table.insert_ignore(rows)
    table.delete_recent(ASOF, HOURS)
    table.drop_symbol("THAT")
    return table


@check(
    "table_newest",
    f"WITH {_LEFT} {_FIRST.format(key='ts', way='DESC').replace('FROM pairs', 'FROM kept')}",
)
def q_table_newest(t):
    return _first_columns(changed_table(t).newest())


@check(
    "table_summary",
    f"""WITH {_LEFT} SELECT symbol, count(*) AS n_rows, min(ts) AS oldest_datetime, arg_min(id, (ts, id)) AS oldest_id,
          max(ts) AS newest_datetime, arg_max(id, (ts, id)) AS newest_id FROM kept GROUP BY symbol""",
)
def q_table_summary(t):
    rows = changed_table(t).summary()
    ends = [F.col(end)[part].alias(f"{end}_{part}") for end in ("oldest", "newest") for part in ("datetime", "id")]
    return ntz(rows.select("symbol", "n_rows", *ends), "oldest_datetime", "newest_datetime")


@check("drop_symbol", f"WITH {PAIRS_SQL} SELECT symbol, id, score FROM pairs WHERE symbol <> 'THAT'")
def q_drop_symbol(t):
    table = filled_table(t)
    table.drop_symbol("THAT")
    return table.read().select("symbol", "id", "score")


@check(
    "route_by_network",
    f"""WITH {PAIRS_SQL}, {TWEETS_SQL},
          found AS (SELECT * FROM tw WHERE NOT is_retweet AND full_text NOT LIKE 'RT @%'),
          {matched_sql("found", "full_text", "tterms", "tpairs", (), cashtags=True)}
        SELECT 'reddit' AS network, symbol, id FROM pairs UNION ALL SELECT 'twitter', symbol, id FROM tpairs""",
)
def q_route_by_network(t):
    database = scratch_database(t.spark)
    tables = {n: PostTable(t.spark, database, n, BUCKETS) for n in (REDDIT, TWITTER)}
    comments = t.stored_comments(t.pairs).withColumn("network", F.lit(REDDIT))
    tweets = tag_tweets(t.tweets, t.tweet_terms, ASOF).withColumn("network", F.lit(TWITTER))
    route_by_network(comments.unionByName(tweets, allowMissingColumns=True), tables)
    reddit, twitter = (
        tables[n].read().select(F.lit(n).alias("network"), "symbol", "id") for n in (REDDIT, TWITTER)
    )
    return reddit.unionByName(twitter)


# Incremental runs

_POINTS = f"""{PAIRS_SQL},
  newest AS (SELECT symbol, max(ts) AS newest FROM pairs WHERE ts < TIMESTAMP '{CUTOFF}' GROUP BY symbol),
  points AS (SELECT symbol, newest, coalesce(newest, TIMESTAMP '{START}') AS since
             FROM symbols LEFT JOIN newest USING (symbol)),
  grid AS (
    SELECT symbol, slice_start, greatest(least(slice_start + INTERVAL 3 DAY, TIMESTAMP '{ASOF}'), slice_start) AS slice_end
    FROM (SELECT symbol, unnest(generate_series(since, greatest(since, TIMESTAMP '{ASOF}' - INTERVAL 1 MICROSECOND),
                                                INTERVAL 3 DAY)) AS slice_start FROM points))"""


def points_of(t):
    return resume_points(t.symbols, before_cutoff(t.pairs), START)


@check("resume_points", f"WITH {_POINTS} SELECT symbol, newest, since FROM points")
def q_resume_points(t):
    return ntz(points_of(t), "newest", "since")


@check(
    "recency_skip",
    f"""WITH {_POINTS} SELECT symbol, coalesce(newest > TIMESTAMP '2024-01-17 00:00:00' - INTERVAL 2 DAY, false) AS skip
        FROM points""",
)
def q_recency_skip(t):
    return recency_skip(points_of(t), "2024-01-17 00:00:00", RECENCY).select("symbol", "skip")


@check("slice_grid", f"WITH {_POINTS} SELECT * FROM grid")
def q_slice_grid(t):
    return ntz(slice_grid(points_of(t), ASOF), "slice_start", "slice_end")


@check(
    "slice_assign",
    f"""SELECT event_id, time_bucket(INTERVAL 3 DAY, ts, TIMESTAMP '2024-01-01 06:30:00') AS slice_start FROM events""",
)
def q_slice_assign(t):
    anchor = F.lit("2024-01-01 06:30:00").cast("timestamp")
    events = t.table("events")
    return ntz(
        events.select("event_id", slice_start(F.col("ts").cast("timestamp"), anchor).alias("slice_start")),
        "slice_start",
    )


@check(
    "slice_stats",
    f"""WITH {_POINTS}, stats AS (
          SELECT symbol, since + to_days(CAST(3 * floor((epoch_us(ts) - epoch_us(since)) / 259200000000.0) AS INTEGER))
                   AS slice_start, min(ts) AS lo, max(ts) AS hi, count(*) AS n
          FROM pairs JOIN points USING (symbol) WHERE ts >= since AND ts < TIMESTAMP '{ASOF}' GROUP BY ALL)
        SELECT symbol, slice_start, slice_end, coalesce(lo, slice_start) AS first_datetime,
          coalesce(hi, slice_end) AS last_datetime, coalesce(n, 0) AS n_posts
        FROM grid LEFT JOIN stats USING (symbol, slice_start)""",
)
def q_slice_stats(t):
    stats = slice_stats(t.pairs, points_of(t), ASOF)
    return ntz(stats, "slice_start", "slice_end", "first_datetime", "last_datetime")


@check("incremental_select", f"WITH {_POINTS} SELECT symbol, id, ts AS datetime FROM pairs JOIN points USING (symbol) WHERE ts > since")
def q_incremental_select(t):
    return ntz(incremental_select(t.pairs, points_of(t)).select("symbol", "id", "datetime"), "datetime")


# Streams


def stream_table(t, name):
    return (
        t.spark.readStream.schema(t.table(name).schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .option("maxFilesPerTrigger", 100)
        .parquet(t.sf_dir)
    )


def streamed_posts(t):
    """Documents as they arrive, with what the events table knows of them."""
    docs, events = stream_table(t, "documents"), t.table("events")
    return docs.join(events, docs.doc_id == events.event_id).select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("body"),
        "lang",
        "source",
        spread_time(F.col("ts")).alias("datetime"),
        F.col("user_id").alias("u"),
        F.floor("value").cast("int").alias("score"),
    )


@check(
    "stream_ingest",
    f"""WITH {POSTS_SQL} SELECT id, {squeeze_sql("body")} AS body, ts AS datetime, score FROM posts""",
)
def q_stream_ingest(t):
    path = shared_dir(t.spark, "stream")
    rows = clean_bodies(streamed_posts(t)).select("id", "body", "datetime", "score")
    append_files(rows, path, shared_dir(t.spark, "checkpoint")).awaitTermination()
    return ntz(t.spark.read.schema(rows.schema).parquet(path), "datetime")


@check(
    "stream_insert_ignore",
    f"""WITH {PAIRS_SQL} SELECT symbol, id, ts AS datetime, length(body) AS n_chars, 'v1' AS version FROM pairs""",
)
def q_stream_insert_ignore(t):
    """The stream is run, then replayed from the start under a new checkpoint."""
    table, terms = new_table(t), t.comment_terms

    def matched(version):
        def prepare(batch):
            pairs = match_symbols(clean_bodies(batch), terms, "body", context_words=CONTEXT)
            return t.stored_comments(pairs, version, hours=1 if version == "v2" else 0)

        return prepare

    for version in ("v1", "v2"):
        append_new(streamed_posts(t), table, shared_dir(t.spark, "checkpoint"), matched(version)).awaitTermination()
    return _versions(table)


@check(
    "stream_slice_stats",
    f"""WITH s AS (SELECT event_type AS symbol, time_bucket(INTERVAL 3 DAY, ts, TIMESTAMP '{START}') AS slice_start,
                     min(ts) AS first_datetime, max(ts) AS last_datetime, count(*) AS n_posts FROM events GROUP BY ALL)
        SELECT symbol, slice_start, slice_start + INTERVAL 3 DAY AS slice_end, first_datetime, last_datetime, n_posts
        FROM s WHERE slice_start + INTERVAL 3 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def q_stream_slice_stats(t):
    path = shared_dir(t.spark, "slices")
    rows = stream_table(t, "events").select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("datetime")
    )
    stats = slice_stats_stream(rows, dt.datetime.fromisoformat(START), DELAY)
    append_files(stats, path, shared_dir(t.spark, "checkpoint")).awaitTermination()
    out = t.spark.read.schema(stats.schema).parquet(path)
    return ntz(out, "slice_start", "slice_end", "first_datetime", "last_datetime")


# The events table itself as stored posts, each user being a symbol: the widest grouped reads.


def event_posts(t):
    return t.table("events").select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("ts").cast("timestamp").alias("datetime"),
        "event_type",
        "value",
    )


@check(
    "newest_event",
    """SELECT 'U' || user_id AS symbol, CAST(event_id AS VARCHAR) AS id, ts AS datetime, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1""",
)
def q_newest_event(t):
    return ntz(newest(event_posts(t)).select("symbol", "id", "datetime", "event_type"), "datetime")


@check(
    "event_slices",
    f"""SELECT 'U' || user_id AS symbol, time_bucket(INTERVAL 3 DAY, ts, TIMESTAMP '{START}') AS slice_start,
          count(*) AS n_posts, min(ts) AS first_datetime, max(ts) AS last_datetime FROM events GROUP BY ALL""",
)
def q_event_slices(t):
    placed = event_posts(t).withColumn("slice_start", slice_start(F.col("datetime"), F.lit(START).cast("timestamp")))
    stats = placed.groupBy("symbol", "slice_start").agg(
        F.count(F.lit(1)).alias("n_posts"),
        F.min("datetime").alias("first_datetime"),
        F.max("datetime").alias("last_datetime"),
    )
    return ntz(stats, "slice_start", "first_datetime", "last_datetime")


# Incremental jobs from captured texts to the table: a run up to the cutoff, then one up to the end that leaves out symbols
# with a post in the last hours before the cutoff and goes on from each other symbol's newest post.

JOB_RECENCY = dt.timedelta(days=15, hours=6)


def _two_runs_sql(kept: str) -> str:
    """``kept`` names pairs (symbol, id, dt, n_chars) of all times."""
    return f"""
  run1 AS (SELECT * FROM {kept} WHERE dt > TIMESTAMP '{START}' AND dt < TIMESTAMP '{CUTOFF}'),
  known AS (SELECT symbol, max(dt) AS newest FROM run1 GROUP BY symbol),
  run2 AS (
    SELECT k.* FROM {kept} k LEFT JOIN known USING (symbol)
    WHERE dt > coalesce(newest, TIMESTAMP '{START}') AND dt < TIMESTAMP '{ASOF}'
      AND NOT coalesce(newest > TIMESTAMP '{ASOF}' - INTERVAL 366 HOUR, false))
  SELECT 1 AS run, symbol, id, dt AS datetime, n_chars FROM run1
  UNION ALL SELECT 2, symbol, id, dt, n_chars FROM run2"""


def _two_runs(t, network, go, text):
    table, folder = new_table(t, network), shared_dir(t.spark, "runs")
    for n, asof, recency in ((1, CUTOFF, None), (2, ASOF, JOB_RECENCY)):
        go(Run(table, f"{folder}/{n}", asof, START, recency))
    rows = table.read().select(
        F.when(F.col("update_datetime") == F.lit(CUTOFF).cast("timestamp"), 1).otherwise(2).alias("run"),
        "symbol", "id", "datetime", F.length(text).cast("bigint").alias("n_chars"),
    )
    return ntz(rows, "datetime")


@check(
    "run_comments",
    f"""WITH {COMMENTS_RAW_SQL}, {POST_TERMS_SQL},
          cc AS (SELECT * REPLACE ({squeeze_sql("body")} AS body), make_timestamp(created_utc * 1000000) AS dt
                 FROM craw WHERE score > 0),
          {matched_sql("cc", "body", "cterms", "pairs", CONTEXT)}, {truncate_sql("cc")},
          tpairs AS (SELECT p.* REPLACE (coalesce(short, p.body) AS body) FROM pairs p LEFT JOIN cut ON p.id = cut.id),
          kept AS (SELECT symbol, id, dt, length(body) AS n_chars FROM tpairs WHERE {keep_sql('body', CONTEXT)}),
          {_two_runs_sql("kept")}""",
)
def q_run_comments(t):
    return _two_runs(
        t, REDDIT, lambda run: run_comments(run, t.pages, t.symbols, t.dictionary, context_words=CONTEXT), "body"
    )


@check(
    "run_tweets",
    f"""WITH {ENTRIES_SQL}, {POST_TERMS_SQL},
          found AS (
            SELECT tid AS id, date_trunc('second', ts) AS dt, {squeeze_sql("full_text")} AS full_text FROM flat
            WHERE rtid IS NULL AND full_text NOT LIKE 'RT @%'),
          {matched_sql("found", "full_text", "tterms", "tpairs", (), cashtags=True)},
          kept AS (SELECT symbol, id, dt, length(full_text) AS n_chars FROM tpairs),
          {_two_runs_sql("kept")}""",
)
def q_run_tweets(t):
    return _two_runs(t, TWITTER, lambda run: run_tweets(run, t.responses, t.symbols, t.dictionary), "full_text")
