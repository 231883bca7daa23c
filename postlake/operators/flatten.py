"""Captured responses to one row per tweet or comment.

Everything a tweet needs (its author, the tweet it repeats) is in the same response, so flattening
is row-local: an explode and map lookups, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.text import any_of
from postlake.functions.times import date_time_text, parse_tweet_time
from postlake.operators.sizing import compute_once
from postlake.schemas import CORRUPT

# Entry id prefixes of tweets in a search timeline.
TWEET_ENTRY_PREFIXES = ("sq-I-t-", "tweet-")

NO_TWEET_ID = "no_tweet_id"
NO_USER = "no_user"
NO_ENTRIES = "no_entries"
UNREADABLE = "unreadable_json"
WRONG_TYPE = "value_of_wrong_type"


def timeline_entries(responses: DataFrame) -> DataFrame:
    """Tweet entries of the first timeline instruction; cursors and other entries are left out.

    A response without any tweet object contributes nothing.
    """
    entries = F.get("timeline.instructions", F.lit(0))["addEntries"]["entries"]
    return (
        responses.where(F.size("globalObjects.tweets") > 0)
        .select("response_id", "globalObjects", F.posexplode(entries).alias("entry_pos", "entry"))
        .where(_is_tweet_entry(F.col("entry.entryId")))
    )


def _is_tweet_entry(entry_id: Column) -> Column:
    return any_of([F.startswith(entry_id, F.lit(p)) for p in TWEET_ENTRY_PREFIXES])


def resolve_tweet_ids(entries: DataFrame) -> DataFrame:
    """Add ``tweet_id``: the entry's tweet, else the tweet behind its tombstone, else NULL."""
    content = F.col("entry.content.item.content")
    return entries.withColumn("tweet_id", F.coalesce(content["tweet"]["id"], content["tombstone"]["tweet"]["id"]))


def drop_promoted(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("entry.content.item.content.tweet.promotedMetadata").isNull())


def join_tweets(entries: DataFrame) -> DataFrame:
    """Entry to tweet object by id; an entry whose tweet is not in the response is skipped."""
    tweet = F.try_element_at(F.col("globalObjects.tweets"), F.col("tweet_id"))
    return compute_once(entries, "tweet", tweet).where(F.col("tweet").isNotNull())


def join_users(tweets: DataFrame) -> DataFrame:
    """Tweet to author; a missing author leaves ``user_data`` NULL."""
    user = F.try_element_at(F.col("globalObjects.users"), F.col("tweet.user_id_str"))
    return compute_once(tweets, "user_data", user)


def enrich_retweets(tweets: DataFrame) -> DataFrame:
    """Add ``retweet_data``, read from the repeated tweet when the response holds it."""
    rtid = F.col("tweet.retweeted_status_id_str")
    tweets = compute_once(tweets, "_target", F.try_element_at(F.col("globalObjects.tweets"), rtid))
    target = F.col("_target")
    when = F.concat(date_time_text(parse_tweet_time(target["created_at"])), F.lit(" UTC"))
    data = F.struct(
        target["user_id_str"].alias("user_rtid"),
        target["full_text"].alias("user_rt"),
        rtid.alias("retweet_id"),
        when.alias("retweet_date"),
    )
    return tweets.withColumn("retweet_data", F.when(target.isNotNull(), data)).drop("_target")


def classified_entries(responses: DataFrame) -> DataFrame:
    """One pass over the responses: every candidate tweet entry with its tweet, author, and
    ``reject_reason`` where there is one. Unreadable responses, and those that hold tweets but no entries, give one row
    each.

    To store tweets and rejects of one reading, persist or write this and split it with
    :func:`accepted_tweets` and :func:`rejected_entries`.
    """
    corrupt = F.col(CORRUPT) if CORRUPT in responses.columns else F.lit(None)
    # A malformed record parses to nothing; a value of a wrong type only costs that value.
    unreadable = corrupt.isNotNull() & F.col("timeline").isNull()
    some = F.size("globalObjects.tweets") > 0
    entries = F.when(some, F.get("timeline.instructions", F.lit(0))["addEntries"]["entries"])
    no_entries = F.coalesce(some & (F.coalesce(F.size(entries), F.lit(0)) <= 0), F.lit(False))
    rows = responses.select(
        "response_id",
        "globalObjects",
        unreadable.alias("unreadable"),
        no_entries.alias("no_entries"),
        F.posexplode_outer(entries).alias("entry_pos", "entry"),
    )
    rows = resolve_tweet_ids(
        rows.where(F.col("unreadable") | F.col("no_entries") | _is_tweet_entry(F.col("entry.entryId")))
    )
    rows = drop_promoted(rows)
    tweet = F.try_element_at(F.col("globalObjects.tweets"), F.col("tweet_id"))
    rows = join_users(compute_once(rows, "tweet", tweet))
    reason = (
        F.when(F.col("unreadable"), F.lit(UNREADABLE))
        .when(F.col("no_entries"), F.lit(NO_ENTRIES))
        .when(F.col("tweet_id").isNull(), F.lit(NO_TWEET_ID))
        .when(F.col("tweet").isNotNull() & F.col("user_data").isNull(), F.lit(NO_USER))
    )
    return rows.withColumn("reject_reason", reason)


def accepted_tweets(entries: DataFrame, strict: bool = False) -> DataFrame:
    """Flattened tweets of :func:`classified_entries`; ``strict`` stops the job on a reject."""
    reason = F.col("reject_reason")
    on_reject = F.raise_error(F.concat(F.lit("unusable entry: "), reason)).cast("boolean") if strict else F.lit(False)
    kept = entries.where(F.when(reason.isNotNull(), on_reject).otherwise(F.col("tweet").isNotNull()))
    return enrich_retweets(kept).select("response_id", "entry_pos", "tweet.*", "user_data", "retweet_data")


def rejected_entries(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("reject_reason").isNotNull()).select(
        "response_id", "entry_pos", "tweet_id", "reject_reason"
    )


def flatten_tweets(responses: DataFrame, strict: bool = False) -> DataFrame:
    """One row per tweet entry: the tweet's fields, ``user_data`` and ``retweet_data``.

    What cannot be used is left to :func:`tweet_rejects`; ``strict`` stops the job on it instead.
    """
    return accepted_tweets(classified_entries(responses), strict)


def tweet_rejects(responses: DataFrame) -> DataFrame:
    """Side output of :func:`flatten_tweets`: (response_id, entry_pos, tweet_id, reject_reason)."""
    return rejected_entries(classified_entries(responses))


def flatten_comments(pages: DataFrame) -> DataFrame:
    """One row per element of each page's ``data``."""
    return pages.select(F.explode("data").alias("c")).select("c.*")


def comment_page_rejects(pages: DataFrame) -> DataFrame:
    """Pages that are not JSON, or hold a value of a wrong type (their other values are kept)."""
    reason = F.when(F.col("data").isNull(), F.lit(UNREADABLE)).otherwise(F.lit(WRONG_TYPE))
    return pages.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("text"), reason.alias("reject_reason"))
