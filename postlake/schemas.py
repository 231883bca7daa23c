"""Shapes of captured responses and stored rows."""

from __future__ import annotations

from dataclasses import dataclass

TWITTER = "twitter"
REDDIT = "reddit"
NETWORKS = (TWITTER, REDDIT)


@dataclass(frozen=True)
class Field:
    """One stored column: where its value is found and what it must be."""

    name: str
    type: str
    required: bool = False
    path: str | None = None

    @property
    def source(self) -> str:
        return self.path or self.name


def _fields(text: str) -> list[Field]:
    out = []
    for line in text.split():
        name, kind, *path = line.split(":")
        out.append(Field(name, kind.rstrip("!"), kind.endswith("!"), path[0] if path else None))
    return out


# The stored columns of each network, in table order. "!" marks a required column;
# a third part is the key path when it differs from the column name.
TWEET_FIELDS = _fields("""
    id:string! conversation_id:string! datetime:timestamp! day_of_week:string! date:date! time:string!
    favorite_count:int! favorited:boolean! full_text:string in_reply_to_screen_name:string
    in_reply_to_status_id:string in_reply_to_user_id:string is_quote_status:boolean! lang:string
    possibly_sensitive:boolean quote_count:int! reply_count:int! retweet_count:int! retweeted:boolean!
    source:string update_datetime:timestamp! user_id:string!
    hashtags:string! symbols:string! user_mentions:string! urls:string!
    user_datetime:timestamp!:user_data.datetime
    user_favourites_count:int!:user_data.favourites_count
    user_followers_count:int!:user_data.followers_count
    user_friends_count:int!:user_data.friends_count
    user_lang:string:user_data.lang
    user_listed_count:int!:user_data.listed_count
    user_name:string!:user_data.name
    user_normal_followers_count:int!:user_data.normal_followers_count
    user_protected:boolean!:user_data.protected
    user_screen_name:string!:user_data.screen_name
    user_statuses_count:int!:user_data.statuses_count
    user_verified:boolean!:user_data.verified
""")
COMMENT_FIELDS = _fields("""
    id:string! link_id:string parent_id:string nest_level:int reply_delay:string controversiality:boolean
    body:string! datetime:timestamp! day_of_week:string! date:date! time:string! score:int!
    subreddit:string! subreddit_id:string! update_datetime:timestamp! author:string!
    author_fullname:string author_datetime:timestamp!
""")


def stored_fields(network: str) -> list[Field]:
    """Column list of a network's table; an unknown network is an error."""
    if network == TWITTER:
        return TWEET_FIELDS
    if network == REDDIT:
        return COMMENT_FIELDS
    raise ValueError(f"unknown network {network!r}, expected one of {NETWORKS}")


SYMBOL_SCHEMA = "symbol string, shortName string, longName string"

# Search responses keep tweets and users in objects keyed by id, so they are maps: inferring a
# schema would turn every id into a column.
TWEET_RESPONSE_DDL = """
response_id string,
globalObjects struct<
  tweets: map<string, struct<
    id: bigint, id_str: string, conversation_id: string, created_at: string, full_text: string,
    favorite_count: int, favorited: boolean, in_reply_to_screen_name: string,
    in_reply_to_status_id: string, in_reply_to_user_id: string, is_quote_status: boolean,
    lang: string, possibly_sensitive: boolean, quote_count: int, reply_count: int,
    retweet_count: int, retweeted: boolean, source: string, user_id: string, user_id_str: string,
    retweeted_status_id_str: string,
    coordinates: struct<coordinates: array<double>>, place: struct<full_name: string>,
    entities: struct<
      hashtags: array<struct<text: string, indices: array<int>>>,
      symbols: array<struct<text: string, indices: array<int>>>,
      user_mentions: array<struct<screen_name: string, id_str: string>>,
      urls: array<struct<expanded_url: string>>,
      media: array<struct<type: string>>>>>,
  users: map<string, struct<
    created_at: string, favourites_count: int, followers_count: int, friends_count: int,
    lang: string, listed_count: int, name: string, normal_followers_count: int,
    protected: boolean, screen_name: string, statuses_count: int, verified: boolean>>>,
timeline struct<instructions: array<struct<addEntries: struct<entries: array<struct<
  entryId: string,
  content: struct<item: struct<content: struct<
    tweet: struct<id: string, promotedMetadata: map<string, string>>,
    tombstone: struct<tweet: struct<id: string>>>>>>>>>>>
"""
COMMENT_PAGE_DDL = """
data array<struct<
  id: string, link_id: string, parent_id: string, nest_level: int, reply_delay: string,
  controversiality: int, body: string, created_utc: bigint, score: int, subreddit: string,
  subreddit_id: string, author: string, author_fullname: string, author_created_utc: bigint>>
"""
CORRUPT = "_corrupt_record"
# Values of another type than stated above, as (path, value).
WRONG_VALUES = "_wrong_values"
