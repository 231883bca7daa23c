import json

import pytest
from pyspark.sql import functions as F

from postlake.operators.flatten import flatten_tweets, timeline_entries, tweet_rejects
from postlake.operators.project import derive_tweets, project_row, require_valid, split_valid
from postlake.schemas import TWEET_FIELDS, TWITTER, stored_fields
from postlake.sources.responses import read_tweet_responses, value_rejects

TIME = "Mon Jan 01 00:00:07 +0000 2024"


def tweet(tid, user="u1", **more):
    entities = {"hashtags": [], "symbols": [], "user_mentions": [], "urls": []}
    return {
        "id": int(tid), "id_str": tid, "conversation_id": tid, "created_at": TIME, "full_text": "a \n b",
        "favorite_count": 1, "favorited": False, "is_quote_status": False, "quote_count": 0, "reply_count": 0,
        "retweet_count": 0, "retweeted": False, "user_id_str": user, "entities": entities, **more,
    }


def user(**more):
    return {
        "created_at": TIME, "favourites_count": 1, "followers_count": 2, "friends_count": 3, "listed_count": 4,
        "name": "N", "normal_followers_count": 2, "protected": False, "screen_name": "n", "statuses_count": 9,
        "verified": True, **more,
    }


def shown(tid, prefix="tweet-", **more):
    return {"entryId": prefix + tid, "content": {"item": {"content": {"tweet": {"id": tid, **more}}}}}


def read(spark, tmp_path, entries, tweets, users=("u1",)):
    response = {
        "response_id": "r",
        "globalObjects": {"tweets": tweets, "users": {u: user() for u in users}},
        "timeline": {"instructions": [{"addEntries": {"entries": entries}}, {"addEntries": {"entries": [shown("1")]}}]},
    }
    (tmp_path / "r.json").write_text(json.dumps(response) + "\n")
    return read_tweet_responses(spark, str(tmp_path))


TOMB = {"entryId": "tweet-3", "content": {"item": {"content": {"tombstone": {"tweet": {"id": "3"}}}}}}
NO_ID = {"entryId": "tweet-9", "content": {"item": {"content": {}}}}
CURSOR = {"entryId": "sq-cursor-bottom", "content": {"operation": {"cursor": {"value": "c"}}}}


def test_entries_of_every_kind(spark, tmp_path):
    entries = [shown("1"), shown("2", "sq-I-t-"), TOMB, shown("4", promotedMetadata={"a": "b"}), shown("5"), shown("6"),
               NO_ID, CURSOR]
    tweets = {
        "1": tweet("1"),
        "2": tweet("2", retweeted_status_id_str="1"),
        "3": tweet("3", retweeted_status_id_str="404"),
        "4": tweet("4"),
        "6": tweet("6", user="gone"),
    }
    responses = read(spark, tmp_path, entries, tweets).cache()
    assert timeline_entries(responses).count() == 7
    got = {r.id: r.retweet_data for r in flatten_tweets(responses).collect()}
    assert sorted(got) == [1, 2, 3]
    assert got[1] is None and got[3] is None
    assert tuple(got[2]) == ("u1", "a \n b", "1", "2024-01-01 00:00:07 UTC")
    rejects = {(r.entry_pos, r.tweet_id, r.reject_reason) for r in tweet_rejects(responses).collect()}
    assert rejects == {(6, None, "no_tweet_id"), (5, "6", "no_user")}


@pytest.mark.parametrize("entry,tweets", [(NO_ID, {"1": tweet("1")}), (shown("6"), {"6": tweet("6", user="gone")})])
def test_strict_mode_stops(spark, tmp_path, entry, tweets):
    with pytest.raises(Exception, match="unusable entry: no_"):
        flatten_tweets(read(spark, tmp_path, [entry], tweets), strict=True).collect()


def test_response_without_tweets(spark, tmp_path):
    responses = read(spark, tmp_path, [shown("1"), NO_ID], {})
    assert flatten_tweets(responses).count() == 0 and tweet_rejects(responses).count() == 0


def test_unreadable_responses(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"response_id": "x", "globalObj\n')
    responses = read(spark, tmp_path, [shown("1")], {"1": tweet("1", favorite_count="many")})
    assert [(r.id, r.favorite_count) for r in flatten_tweets(responses).collect()] == [(1, None)]
    assert [r.reject_reason for r in tweet_rejects(responses).collect()] == ["unreadable_json"]
    assert tweet_rejects(responses).count() == 1


def test_values_of_other_types_and_responses_without_entries(spark, tmp_path):
    odd = tweet("1", favorite_count="12", quote_count=3.0, possibly_sensitive="maybe", entities={"hashtags": [
        {"text": "x", "indices": [1, "end"]}]})
    responses = read(spark, tmp_path, [shown("1"), shown("2")], {"1": odd, "2": tweet("2")})
    got = {r.id: (r.favorite_count, r.quote_count, r.possibly_sensitive) for r in flatten_tweets(responses).collect()}
    assert got == {1: (12, 3, None), 2: (1, 0, None)}
    assert sorted(map(tuple, value_rejects(responses, ("response_id",)).collect())) == [
        ("r", "globalObjects.tweets.1.entities.hashtags.0.indices.1", "end"),
        ("r", "globalObjects.tweets.1.possibly_sensitive", "maybe"),
    ]
    assert tweet_rejects(responses).count() == 0
    empty = {"response_id": "e", "globalObjects": {"tweets": {"1": tweet("1")}}, "timeline": {"instructions": []}}
    (tmp_path / "e.json").write_text(json.dumps(empty) + "\n")
    responses = read_tweet_responses(spark, str(tmp_path))
    assert [(r.response_id, r.reject_reason) for r in tweet_rejects(responses).collect()] == [("e", "no_entries")]
    with pytest.raises(Exception, match="unusable entry: no_entries"):
        flatten_tweets(responses, strict=True).collect()


def test_stored_row(spark, tmp_path):
    flat = flatten_tweets(read(spark, tmp_path, [shown("1"), shown("2")], {"1": tweet("1"), "2": tweet("2", full_text="z", user_id="77", quote_count=None)}))
    rows = project_row(derive_tweets(flat, "2024-02-01"), TWITTER)
    assert rows.columns == [f.name for f in TWEET_FIELDS] and len(rows.columns) == 38
    valid, rejects = split_valid(rows, TWITTER)
    row = valid.first()
    assert (row.id, row.full_text, row.user_id, row.hashtags, row.time) == ("1", "a b", "u1", "[]", "00:00:07")
    assert str(row.user_datetime) == "2024-01-01 00:00:07" and row.user_verified is True
    assert [(r.id, r.user_id, r.reject_reason) for r in rejects.collect()] == [("2", "77", "quote_count")]


def test_required_values(spark):
    bad = spark.range(1).select(F.lit("S").alias("symbol"), *[F.lit(None).cast(f.type).alias(f.name) for f in TWEET_FIELDS])
    with pytest.raises(Exception, match="required value missing"):
        require_valid(bad, TWITTER).collect()
    with pytest.raises(ValueError, match="unknown network"):
        stored_fields("myspace")
