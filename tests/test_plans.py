"""Whole jobs and the driver contract on small data."""

import json

import __spark_entry__ as driver
from postlake.operators.table import PostTable, scratch_database
from postlake.plans.comments import comment_symbol_terms, comments_to_store
from postlake.plans.tweets import tweet_symbol_terms, tweets_to_store
from postlake.schemas import REDDIT, TWITTER
from postlake.sources.responses import read_comment_pages, read_tweet_responses
from tests.test_flatten import shown, tweet, user


def master(spark):
    symbols = spark.createDataFrame(
        [("ZYX", "Zyxcorp", "Zyxcorp Holdings Inc."), ("GAP", "Gap", "Gap, Inc.")],
        "symbol string, shortName string, longName string",
    )
    return symbols, spark.createDataFrame([("gap",), ("holdings",)], "word string")


def comment(cid, body, **more):
    return {"id": cid, "body": body, "created_utc": 1704067207, "score": 1, "subreddit": "s", "subreddit_id": "t",
            "author": "a", **more}


def test_comments_from_pages_to_table(spark, tmp_path):
    long_tail = "x" * 2100 + ". " + "zyxcorp"
    data = [
        comment("1", "I like\n Zyxcorp  a lot"),
        comment("2", "zyxcorp", score=0),
        comment("3", "the GAP stocks"),
        comment("4", "mind the gap"),
        comment("5", long_tail),
        comment("6", "zyxcorp and gap, inc", author=None),
    ]
    (tmp_path / "p.json").write_text(json.dumps({"data": data}) + "\n")
    terms = comment_symbol_terms(*master(spark))
    valid, rejects = comments_to_store(read_comment_pages(spark, str(tmp_path)), terms, "2024-02-01")
    # 5 is found by its full text but the name is cut off: a false positive
    assert sorted((r.symbol, r.id) for r in valid.collect()) == [("GAP", "3"), ("GAP", "4"), ("ZYX", "1")]
    assert sorted((r.symbol, r.id, r.reject_reason) for r in rejects.collect()) == [("GAP", "6", "author"), ("ZYX", "6", "author")]
    table = PostTable(spark, scratch_database(spark), REDDIT, 4)
    assert table.insert_ignore(valid) == 3
    assert table.newest("ZYX").first().body == "I like Zyxcorp a lot"


def test_tweets_from_responses_to_table(spark, tmp_path):
    tweets = {
        "1": tweet("1", full_text="buy $ZYX"),
        "2": tweet("2", full_text="zyxcorp holdings is up", retweeted_status_id_str="1"),
        "3": tweet("3", full_text="zyxcorp  holdings is down"),
        "4": tweet("4", full_text="ZYX alone says nothing"),
    }
    response = {"response_id": "r", "globalObjects": {"tweets": tweets, "users": {"u1": user()}},
                "timeline": {"instructions": [{"addEntries": {"entries": [shown(i) for i in tweets]}}]}}
    (tmp_path / "r.json").write_text(json.dumps(response) + "\n")
    terms = tweet_symbol_terms(*master(spark))
    valid, rejects = tweets_to_store(read_tweet_responses(spark, str(tmp_path)), terms, "2024-02-01")
    assert sorted((r.symbol, r.id, r.full_text) for r in valid.collect()) == [
        ("ZYX", "1", "buy $ZYX"), ("ZYX", "3", "zyxcorp holdings is down")]
    assert rejects.count() == 0
    assert PostTable(spark, scratch_database(spark), TWITTER, 4).insert_ignore(valid) == 2


def test_driver_contract(spark):
    assert driver.entry(spark).count() > 0
    assert set(driver.ORACLES) == set(driver.QUERIES)
    assert set(driver.oracle_sql()) <= set(driver.queries())
