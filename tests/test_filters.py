import pytest
from pyspark.sql import functions as F

from postlake.functions.geo import parse_geocode
from postlake.operators.filters import CommentFilter, TweetFilter

SCHEMA = """id string, datetime timestamp, lang string, full_text string, source string,
  in_reply_to_screen_name string, in_reply_to_status_id string, retweeted_status_id_str string,
  favorite_count int, retweet_count int, reply_count int,
  coordinates struct<coordinates: array<double>>, place struct<full_name: string>,
  entities struct<user_mentions: array<struct<screen_name: string>>, urls: array<struct<expanded_url: string>>,
                  media: array<struct<type: string>>>,
  user_data struct<screen_name: string, verified: boolean>"""


@pytest.fixture(scope="module")
def tweets(spark):
    base = dict(
        id="0", lang="en", full_text="plain words", source='<a href="x">Web</a>', favorite_count=1, retweet_count=1,
        reply_count=1, entities={"user_mentions": [], "urls": [], "media": None},
        user_data={"screen_name": "Ann", "verified": False},
    )
    rows = [
        base,
        {**base, "id": "1", "lang": "fr", "in_reply_to_screen_name": "BOB", "in_reply_to_status_id": "9"},
        {**base, "id": "2", "retweeted_status_id_str": "9", "full_text": "buy $ABC now"},
        {**base, "id": "3", "full_text": "RT @x: y", "user_data": {"screen_name": "bob", "verified": True}},
        {**base, "id": "4", "entities": {"user_mentions": [{"screen_name": "Bob"}], "urls": [{"expanded_url": "u"}],
                                         "media": [{"type": "photo"}]}},
        {**base, "id": "5", "entities": {"user_mentions": [{"screen_name": "bobby"}], "urls": None,
                                         "media": [{"type": "video"}]}, "favorite_count": 9, "retweet_count": 9},
        {**base, "id": "6", "coordinates": {"coordinates": [179.9, 0.0]}, "place": {"full_name": "New York, USA"},
         "reply_count": 9, "source": None},
        {**base, "id": "7", "coordinates": {"coordinates": [0.0, 89.9]}, "full_text": None},
    ]
    return spark.createDataFrame(rows, SCHEMA).withColumn("datetime", F.expr(
        "timestamp '2024-01-01' + make_interval(0, 0, 0, int(id))")).cache()


@pytest.mark.parametrize(
    "options,expected",
    [
        ({}, "01234567"),
        ({"since": "2024-01-03", "until": "2024-01-05"}, "23"),
        ({"lang": "fr"}, "1"),
        ({"query": "BOB"}, "3"),
        ({"username": "bob"}, "3"),
        ({"to": "bob"}, "1"),
        ({"all": "bob"}, "134"),
        ({"near": "new york"}, "6"),
        ({"has_images": True}, "4"),
        ({"has_videos": True}, "5"),
        ({"has_media": True}, "45"),
        ({"has_replies": True}, "1"),
        ({"has_native_retweets": True}, "2"),
        ({"exclude_retweets": True}, "014567"),
        ({"min_likes": 5}, "5"),
        ({"min_retweets": 5}, "5"),
        ({"min_replies": 5}, "6"),
        ({"include_links": True}, "4"),
        ({"exclude_links": True}, "0123567"),
        ({"source": "Web"}, "0123457"),
        ({"is_verified": True}, "3"),
        ({"search": ["$abc", "plain words"]}, "012456"),
        ({"search": ["abc"]}, ""),
        ({"geo": "0, -179.9, 50km"}, "6"),
        ({"geo": "89.9,180,30mi"}, "7"),
        ({"geo": "0,0,10km"}, ""),
        ({"min_likes": 0, "lang": "", "has_media": False}, "01234567"),
        ({"lang": "en", "all": "bob", "exclude_retweets": True}, "4"),
    ],
)
def test_option(tweets, options, expected):
    assert "".join(sorted(r.id for r in TweetFilter(**options).apply(tweets).collect())) == expected


def test_members_list(spark, tweets):
    members = spark.createDataFrame([("l1", "BOB"), ("l1", "bob"), ("l2", "ann")], "list_id string, screen_name string")
    got = TweetFilter(members_list="l1").apply(tweets, members).collect()
    assert [r.id for r in got] == ["3"]
    with pytest.raises(ValueError):
        TweetFilter(members_list="l1").apply(tweets)


def test_geocode_text():
    assert parse_geocode(" 1.5, -2 ,3 km") == (1.5, -2.0, 3.0)
    assert parse_geocode("1,2,1mi")[2] == pytest.approx(1.609344)


def test_comment_search(spark):
    df = spark.createDataFrame(
        [("a", "Good stocks", 1, "2024-01-02"), ("b", "good", 0, "2024-01-02"), ("c", "goods", 5, "2024-01-02"),
         ("d", "GOOD!", 5, "2024-01-03")],
        "id string, body string, score int, day string",
    ).selectExpr("*", "timestamp(day) AS datetime")
    search = CommentFilter(since="2024-01-02", until="2024-01-03", search=["good"])
    assert [r.id for r in search.apply(df).collect()] == ["a"]
    assert sorted(r.id for r in CommentFilter().apply(df).collect()) == ["a", "c", "d"]
