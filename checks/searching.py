"""Search predicates, one query per option."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import CUTOFF, POSTS_SQL, START, TWEETS_SQL, squeeze_sql, tokens_sql
from checks.reading import COMMENTS_RAW_SQL
from checks.registry import check
from postlake.functions.geo import EARTH_KM
from postlake.operators.filters import CommentFilter, TweetFilter
from postlake.operators.project import clean_bodies, derive_comments


def _tweet_check(name: str, where: str, options: dict, extra: str = "") -> None:
    sql = f"""WITH {POSTS_SQL}, {TWEETS_SQL}{extra}
              SELECT id, lang, screen_name, favorite_count FROM tw WHERE {where}"""

    @check(name, sql)
    def run(t):
        members = _list_members(t) if "members_list" in options else None
        return TweetFilter(**options).apply(t.tweets, members).select(
            F.col("id").cast("string").alias("id"),
            "lang",
            F.col("user_data.screen_name").alias("screen_name"),
            "favorite_count",
        )


def _list_members(t):
    """Customers of each market segment are the members of a list."""
    return t.table("customer").select(
        F.col("c_mktsegment").alias("list_id"),
        F.concat(F.lit("USER_"), F.col("c_custkey").cast("string")).alias("screen_name"),
    )


_GEO_LAT, _GEO_LON, _GEO_KM = 40.0, 170.0, 2500.0
_DISTANCE = f"""2 * {EARTH_KM} * asin(least(1.0, sqrt(
    pow(sin(radians(lat - {_GEO_LAT}) / 2), 2)
    + cos(radians(lat)) * cos(radians({_GEO_LAT})) * pow(sin(radians(lon - {_GEO_LON}) / 2), 2))))"""

_PADDED = f"(' ' || {tokens_sql('full_text', cashtags=True)} || ' ')"

for _name, _where, _options in [
    ("tw_time_range", f"date_trunc('second', ts) >= TIMESTAMP '{START}' AND date_trunc('second', ts) < TIMESTAMP '{CUTOFF}'",
     {"since": START, "until": CUTOFF}),
    ("tw_lang", "lang = 'fr'", {"lang": "fr"}),
    ("tw_query", "lower(screen_name) = 'user_7'", {"query": "uSER_7"}),
    ("tw_username", "lower(screen_name) = 'user_8'", {"username": "User_8"}),
    ("tw_geo", f"{_DISTANCE} <= {_GEO_KM}", {"geo": f"{_GEO_LAT}, {_GEO_LON}, {_GEO_KM:.0f}km"}),
    ("tw_search", f"contains({_PADDED}, ' of the ') OR contains({_PADDED}, ' les ')", {"search": ["of the", "Les"]}),
    ("tw_verified", "verified", {"is_verified": True}),
    ("tw_to", "lower(reply_name) = 'user_10'", {"to": "user_10"}),
    ("tw_all", "lower(reply_name) = 'user_7' OR lower(screen_name) = 'user_7' OR lower(mention) = 'user_7'",
     {"all": "User_7"}),
    ("tw_near", "contains(lower(place), 'springfield, de')", {"near": "Springfield, de"}),
    ("tw_images", "media = 'photo'", {"has_images": True}),
    ("tw_videos", "media IN ('video', 'animated_gif')", {"has_videos": True}),
    ("tw_media", "media IS NOT NULL", {"has_media": True}),
    ("tw_replies", "reply_status IS NOT NULL", {"has_replies": True}),
    ("tw_native_rt", "is_retweet", {"has_native_retweets": True}),
    ("tw_min_likes", "favorite_count >= 100", {"min_likes": 100}),
    ("tw_min_retweets", "retweet_count >= 25", {"min_retweets": 25}),
    ("tw_min_replies", "reply_count >= 3", {"min_replies": 3}),
    ("tw_links", "has_url", {"include_links": True}),
    ("tw_no_links", "NOT has_url", {"exclude_links": True}),
    ("tw_source", "source = 'src3'", {"source": "src3"}),
    ("tw_list", "lower(screen_name) IN (SELECT 'user_' || c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')",
     {"members_list": "MACHINERY"}),
    ("tw_no_rt", "NOT is_retweet AND full_text NOT LIKE 'RT @%'", {"exclude_retweets": True}),
    ("tw_combined", """date_trunc('second', ts) < TIMESTAMP '2024-01-16 00:00:00' AND lang = 'en' AND verified
                       AND NOT is_retweet AND full_text NOT LIKE 'RT @%' AND favorite_count >= 5""",
     {"until": CUTOFF, "lang": "en", "is_verified": True, "exclude_retweets": True, "min_likes": 5}),
]:
    _tweet_check(_name, _where, _options)


@check(
    "comment_search",
    f"""WITH {COMMENTS_RAW_SQL}, cc AS (SELECT *, ' ' || {tokens_sql("body")} || ' ' AS padded,
             make_timestamp(created_utc * 1000000) AS dt FROM craw)
        SELECT id, {squeeze_sql("body")} AS body, CAST(score AS INTEGER) AS score FROM cc
        WHERE score > 0 AND dt >= TIMESTAMP '{START}' AND dt < TIMESTAMP '{CUTOFF}'
          AND (contains(padded, ' of the ') OR contains(padded, ' que '))""",
)
def q_comment_search(t):
    comments = clean_bodies(derive_comments(t.comments, CUTOFF))
    return CommentFilter(since=START, until=CUTOFF, search=["of the", "que"]).apply(comments).select(
        "id", "body", "score"
    )
