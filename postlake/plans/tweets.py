"""Captured tweet searches to stored rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame

from postlake.operators.enrich import company_names, tweet_terms
from postlake.operators.filters import TweetFilter
from postlake.operators.flatten import flatten_tweets
from postlake.operators.match import match_symbols
from postlake.operators.project import derive_tweets, project_row, split_valid
from postlake.schemas import TWEET_FIELDS, TWITTER


def tweet_symbol_terms(symbols: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = company_names(symbols, dictionary)
    return tweet_terms(named).select("symbol", "term_no", "term", "needs_context")


def tweet_pairs(
    tweets: DataFrame,
    terms: DataFrame,
    asof: Column | dt.datetime | str,
    search: TweetFilter | None = None,
    list_members: DataFrame | None = None,
) -> DataFrame:
    """Flattened tweets to stored-shape rows, one per tweet and symbol; retweets are left out unless
    ``search`` says otherwise."""
    search = search or TweetFilter(exclude_retweets=True)
    found = project_row(search.apply(derive_tweets(tweets, asof), list_members), TWITTER)
    pairs = match_symbols(found, terms, "full_text", cashtags=True)
    return pairs.select(*[f.name for f in TWEET_FIELDS], "symbol")


tag_tweets = tweet_pairs  # nothing more is removed: a tweet search has no false-positive test


def tweets_to_store(
    responses: DataFrame,
    terms: DataFrame,
    asof: Column | dt.datetime | str,
    search: TweetFilter | None = None,
    list_members: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows for the tweet table, rows missing a required value)."""
    return split_valid(tweet_pairs(flatten_tweets(responses), terms, asof, search, list_members), TWITTER)
