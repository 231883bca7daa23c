"""Search predicates of both networks. Options are ANDed; an unset option filters nothing."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.geo import parse_geocode, within_radius
from postlake.functions.text import any_of, has_phrase, padded_tokens, strip_tags, token_string
from postlake.functions.times import as_ts
from postlake.operators.sizing import broadcast_if_small

VIDEO_TYPES = ("video", "animated_gif")


def _all_of(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _same_name(column: Column, name: str) -> Column:
    return F.lower(column) == name.lower()


def _any_phrase(text: Column, phrases: list[str], cashtags: bool) -> Column:
    padded = padded_tokens(text, cashtags)
    return any_of([has_phrase(padded, token_string(F.lit(p), cashtags)) for p in phrases])


def _media_of(*types: str) -> Column:
    return F.coalesce(F.arrays_overlap("entities.media.type", F.array(*[F.lit(t) for t in types])), F.lit(False))


def _mentions(name: str) -> Column:
    """Screen names hold no spaces, so joined names can be searched as words."""
    names = F.concat(F.lit(" "), F.lower(F.array_join("entities.user_mentions.screen_name", " ")), F.lit(" "))
    return F.contains(names, F.lit(f" {name.lower()} "))


def _count_of(array: str) -> Column:
    return F.coalesce(F.size(array), F.lit(0))


@dataclass
class CommentFilter:
    """Comments with more than ``min_score`` points in ``[since, until)`` holding any of the phrases."""

    since: dt.datetime | str | None = None
    until: dt.datetime | str | None = None
    min_score: int | None = 0
    search: list[str] = field(default_factory=list)

    def to_column(self) -> Column:
        found = []
        if self.min_score is not None:
            found.append(F.col("score") > self.min_score)
        if self.since:
            found.append(F.col("datetime") >= as_ts(self.since))
        if self.until:
            found.append(F.col("datetime") < as_ts(self.until))
        if self.search:
            found.append(_any_phrase(F.col("body"), self.search, cashtags=False))
        return _all_of(found)

    def apply(self, comments: DataFrame) -> DataFrame:
        return comments.where(self.to_column())


@dataclass
class TweetFilter:
    """Search options over derived tweets (stored columns plus the raw ``entities``, ``place``,
    ``coordinates`` and ``user_data``)."""

    since: dt.datetime | str | None = None
    until: dt.datetime | str | None = None
    lang: str | None = None
    query: str | None = None
    username: str | None = None
    geo: str | None = None
    search: list[str] = field(default_factory=list)
    is_verified: bool = False
    to: str | None = None
    all: str | None = None
    near: str | None = None
    has_images: bool = False
    has_videos: bool = False
    has_media: bool = False
    has_replies: bool = False
    has_native_retweets: bool = False
    min_likes: int = 0
    min_retweets: int = 0
    min_replies: int = 0
    include_links: bool = False
    exclude_links: bool = False
    source: str | None = None
    members_list: str | None = None
    exclude_retweets: bool = False

    def to_column(self) -> Column:
        """Every option but ``members_list``, which needs a join (see :meth:`apply`)."""
        screen_name = F.col("user_data.screen_name")
        reply_name = F.col("in_reply_to_screen_name")
        is_retweet = F.col("retweeted_status_id_str").isNotNull()
        found: list[Column] = []
        if self.since:
            found.append(F.col("datetime") >= as_ts(self.since))
        if self.until:
            found.append(F.col("datetime") < as_ts(self.until))
        if self.lang:
            found.append(F.col("lang") == self.lang)
        for author in (self.query, self.username):
            if author:
                found.append(_same_name(screen_name, author))
        if self.geo:
            point = F.col("coordinates.coordinates")
            found.append(within_radius(F.get(point, 1), F.get(point, 0), *parse_geocode(self.geo)))
        if self.search:
            found.append(_any_phrase(F.col("full_text"), self.search, cashtags=True))
        if self.is_verified:
            found.append(F.col("user_data.verified"))
        if self.to:
            found.append(_same_name(reply_name, self.to))
        if self.all:
            options = (_same_name(reply_name, self.all), _same_name(screen_name, self.all), _mentions(self.all))
            found.append(any_of([F.coalesce(o, F.lit(False)) for o in options]))
        if self.near:
            found.append(F.contains(F.lower("place.full_name"), F.lit(self.near.lower())))
        if self.has_images:
            found.append(_media_of("photo"))
        if self.has_videos:
            found.append(_media_of(*VIDEO_TYPES))
        if self.has_media:
            found.append(_count_of("entities.media") > 0)
        if self.has_replies:
            found.append(F.col("in_reply_to_status_id").isNotNull())
        if self.has_native_retweets:
            found.append(is_retweet)
        if self.min_likes:
            found.append(F.col("favorite_count") >= self.min_likes)
        if self.min_retweets:
            found.append(F.col("retweet_count") >= self.min_retweets)
        if self.min_replies:
            found.append(F.col("reply_count") >= self.min_replies)
        if self.include_links:
            found.append(_count_of("entities.urls") > 0)
        if self.exclude_links:
            found.append(_count_of("entities.urls") == 0)
        if self.source:
            found.append(strip_tags(F.col("source")) == self.source)
        if self.exclude_retweets:
            found.append(~is_retweet & ~F.coalesce(F.startswith(F.col("full_text"), F.lit("RT @")), F.lit(False)))
        return _all_of(found)

    def apply(self, tweets: DataFrame, list_members: DataFrame | None = None) -> DataFrame:
        """Filtered tweets; ``members_list`` needs ``list_members(list_id, screen_name)``."""
        out = tweets.where(self.to_column())
        if not self.members_list:
            return out
        if list_members is None:
            raise ValueError("members_list needs the list_members table")
        members = (
            list_members.where(F.col("list_id") == self.members_list)
            .select(F.lower("screen_name").alias("_member"))
            .distinct()
        )
        members, _ = broadcast_if_small(members)
        return out.join(members, F.lower(F.col("user_data.screen_name")) == F.col("_member"), "left_semi")
