"""Posts, symbols, responses and pages derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.text import normalize_text
from postlake.functions.times import derive_calendar
from postlake.operators.flatten import flatten_comments
from postlake.operators.match import match_symbols
from postlake.operators.project import clean_bodies, derive_tweets
from postlake.operators.sizing import compute_once, spread_scan
from postlake.plans.comments import comment_symbol_terms
from postlake.plans.tweets import tweet_symbol_terms
from postlake.session import shared_dir
from postlake.sources.responses import (
    parse_comment_pages,
    parse_tweet_responses,
    read_comment_pages,
    read_tweet_responses,
)
from postlake.sources.symbols import dictionary_words, last_wins, parse_symbol_lines

ASOF = "2024-01-31 00:00:00"
START = "2024-01-01 00:00:00"
CUTOFF = "2024-01-16 00:00:00"
# Every tenth event belongs to a document and they come first, so ten times their distance from the
# start spreads the posts over the month.
SPREAD = 10
CONTEXT = ("for", "was")
USERS = 150

# Hand-made master rows, names being words that do occur in the documents.
NAMED_SYMBOLS = [
    (" THAT", "That Inc", "That"),
    ("WTH", "With Corp", "With"),
    ("FRM", "From, Ltd", "The From Corporation"),
    ("THS", "This", "A This (Class A), Inc."),
    ("ARE", "Are", "Are"),
    ("FOR", "For Shares", "For"),
    ("IN", "In", "In Limited"),
    ("TWO", "and the", "of the"),
    ("ZZZ", "Zebra Quux (US)", "Zebra Quux"),
    ("PAR", "Les (Holdings)", "Les que"),
    ("DER", "Der", "Der und"),
    ("EMP", "", ""),
    ("PAD ", "la", "el los"),
    (" PAD", "de la", "und"),
]
DICTIONARY_WORDS = ["That", "with", "FROM", "this", "are", "for", "in", "the", "of", "and", "group", "that", "Class"]

WS = (
    r"[\s\x{1c}-\x{1f}\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def squeeze_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def tokens_sql(x: str, cashtags: bool = False) -> str:
    keep = "$" if cashtags else ""
    return rf"trim(regexp_replace(lower({x}), '[^\p{{L}}\p{{M}}\p{{N}}{keep}]+', ' ', 'g'))"


def truncate_sql(cte: str) -> str:
    """(id, body) of ``cte`` truncated: sentences are taken while the length before them is small."""
    return f"""
    sentences AS (
      SELECT id, generate_subscripts(s, 1) AS pos, trim(unnest(s)) || '. ' AS sentence
      FROM (SELECT id, string_split(body, '. ') AS s FROM {cte} WHERE length(body) > 2000)),
    running AS (
      SELECT *, coalesce(sum(length(sentence)) OVER (
        PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM sentences),
    cut AS (
      SELECT id, string_agg(sentence, '' ORDER BY pos) || '[...]' AS short
      FROM running WHERE before <= 2000 GROUP BY id)"""


POSTS_SQL = f"""
  posts AS (
    SELECT CAST(d.doc_id AS VARCHAR) AS id, d.doc_id AS n, d.text AS body, d.lang, d.source,
           TIMESTAMP '{START}' + to_microseconds((epoch_us(e.ts) - epoch_us(TIMESTAMP '{START}')) * {SPREAD}) AS ts,
           e.user_id AS u, CAST(floor(e.value) AS INTEGER) AS score, e.event_type AS kind
    FROM documents d JOIN events e ON d.doc_id = e.event_id)"""

_VALUES = ", ".join(f"({i}, '{s}', '{a}', '{b}')" for i, (s, a, b) in enumerate(NAMED_SYMBOLS))
NAMED_SQL = f"""
  named_rows AS (SELECT * FROM (VALUES {_VALUES}) v(pos, symbol, shortName, longName)),
  bench_rows AS (
    SELECT 1000 + item_id AS pos, 'B' || item_id AS symbol,
           array_to_string(w[1:2], ' ') || ' Inc.' AS shortName,
           array_to_string(w[1:3], ' ') || ' Corporation, ' || array_to_string(w[4:5], ' ') AS longName
    FROM (SELECT item_id, string_split({squeeze_sql("text")}, ' ') AS w FROM benchmark))"""
PART_SQL = """
  part_rows AS (
    SELECT 1000000000 + p_partkey AS pos,
           ' ' || upper(substr(p_name, 1, 1) || substr(split_part(p_name, ' ', 2), 1, 2)) || p_size AS symbol,
           CASE p_size % 5 WHEN 0 THEN p_name || ' Inc.' WHEN 1 THEN p_name || ' ' || p_brand || ' Corp'
                WHEN 2 THEN split_part(p_name, ' ', 1) WHEN 3 THEN p_brand || ' (' || p_name || ')' ELSE '' END
             AS shortName,
           CASE p_size % 4 WHEN 0 THEN 'The ' || p_name || ' ' || p_brand || ' Group, Inc.'
                WHEN 1 THEN p_brand || '  ' || p_name || ' Holdings Limited'
                WHEN 2 THEN split_part(p_name, ' ', 2) || ', ' || p_type
                ELSE 'A.' || p_type || ' (' || p_name || ') ETF' END AS longName
    FROM part)"""


def _symbols_sql(parts: str) -> str:
    return f"""
  master AS (
    SELECT pos, trim(symbol) AS symbol, nullif(shortName, '') AS shortName, nullif(longName, '') AS longName
    FROM ({parts})),
  symbols AS (
    SELECT symbol, shortName, longName
    FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY pos DESC) AS rn FROM master) WHERE rn = 1)"""


ALL_SYMBOLS_SQL = f"""{NAMED_SQL}, {PART_SQL}, {_symbols_sql('''
      SELECT * FROM named_rows UNION ALL SELECT * FROM bench_rows UNION ALL SELECT * FROM part_rows''')}"""

_WORDS = ", ".join(f"('{w}')" for w in DICTIONARY_WORDS)
DICTIONARY_SQL = f"""
  dictionary AS (
    SELECT DISTINCT lower(word) AS word FROM (
      SELECT word FROM (VALUES {_WORDS}) v(word)
      UNION ALL SELECT split_part(p_name, ' ', 2) FROM part
      UNION ALL SELECT p_type FROM part) WHERE word <> '')"""


def trim_sql(source: str, column: str, out: str) -> str:
    """CTE ``out(full_name, trimmed)`` for the distinct values of a column."""
    return f"""
  {out}_w AS (
    SELECT f AS full_name, pos, w.word, d.word IS NOT NULL AS is_word
    FROM (SELECT f, generate_subscripts(a, 1) AS pos, unnest(a) AS word
          FROM (SELECT f, string_split({squeeze_sql("lower(split_part(f, ',', 1))")}, ' ') AS a
                FROM (SELECT DISTINCT {column} AS f FROM {source} WHERE {column} IS NOT NULL))) w
    LEFT JOIN dictionary d ON w.word = d.word
    WHERE w.word <> ''),
  {out}_s AS (
    SELECT *, min(CASE WHEN word NOT IN ('a', 'an', 'the') THEN pos END) OVER (PARTITION BY full_name) AS s
    FROM {out}_w),
  {out}_b AS (
    SELECT *, min(CASE WHEN NOT is_word AND pos > s THEN pos END) OVER (PARTITION BY full_name) AS b FROM {out}_s),
  {out}_e AS (
    SELECT *, min(CASE WHEN is_word AND pos > b THEN pos END) OVER (PARTITION BY full_name) AS e FROM {out}_b),
  {out}_k AS (
    SELECT full_name, list(word ORDER BY pos) AS k FROM {out}_e
    WHERE pos >= s AND (e IS NULL OR pos < e) GROUP BY full_name),
  {out}_c AS (
    SELECT full_name, array_to_string(
      CASE WHEN replace(k[len(k)], '.', '') IN
             ('corporation', 'corp', 'cor', 'etf', 'incorporated', 'inc', 'limited', 'ltd')
           THEN k[1:len(k) - 1] ELSE k END, ' ') AS core FROM {out}_k),
  {out}_n AS (
    SELECT full_name,
      CASE WHEN length(core) <= 5 AND core IN (SELECT word FROM dictionary)
           THEN CASE WHEN lower(full_name) IN (SELECT word FROM dictionary) THEN NULL
                     ELSE replace(replace(lower(full_name), '.', ''), ',', '') END
           ELSE core END AS name FROM {out}_c),
  {out} AS (SELECT full_name, CASE WHEN length(name) > 3 THEN name END AS trimmed FROM {out}_n)"""


COMPANY_SQL = f"""{trim_sql("symbols", "longName", "tl")}, {trim_sql("symbols", "shortName", "ts")},
  company AS (
    SELECT symbol, shortName, longName,
      CASE WHEN s IS NOT NULL AND l IS NOT NULL AND contains(s, '(') THEN l
           WHEN s IS NOT NULL AND l IS NOT NULL AND contains(l, '(') THEN s
           ELSE coalesce(l, s, symbol) END AS name
    FROM (SELECT y.*, tl.trimmed AS l, ts.trimmed AS s FROM symbols y
          LEFT JOIN tl ON y.longName = tl.full_name LEFT JOIN ts ON y.shortName = ts.full_name))"""
COMMENT_TERMS_SQL = """
  cterms AS (
    SELECT symbol, shortName, longName, name, term_no, term, needs_context FROM (
      SELECT *, 1 AS term_no, shortName AS term, false AS needs_context FROM company
      UNION ALL SELECT *, 2, longName, false FROM company
      UNION ALL SELECT *, 3, CASE WHEN lower(name) <> lower(symbol) THEN name END,
                       lower(name) IN (SELECT word FROM dictionary) FROM company
      UNION ALL SELECT *, 4, CASE WHEN length(symbol) >= 3 THEN symbol END, true FROM company)
    WHERE trim(term) <> '')"""
TWEET_TERMS_SQL = """
  tterms AS (
    SELECT symbol, term_no, term, false AS needs_context FROM (
      SELECT symbol, 1 AS term_no, CASE WHEN lower(name) <> lower(symbol) THEN name END AS term FROM company
      UNION ALL SELECT symbol, 2, '$' || symbol FROM company) WHERE trim(term) <> '')"""
POST_TERMS_SQL = f"{ALL_SYMBOLS_SQL}, {DICTIONARY_SQL}, {COMPANY_SQL}, {COMMENT_TERMS_SQL}, {TWEET_TERMS_SQL}"


def matched_sql(posts: str, text: str, terms: str, out: str, context: tuple[str, ...], cashtags: bool = False) -> str:
    """CTE ``out``: each post of ``posts`` once under each symbol, at its first matching term."""
    around = " OR ".join([f"contains(p.padded, ' {w} ')" for w in context]) or "false"
    return f"""
  {out}_p AS (SELECT *, ' ' || {tokens_sql(text, cashtags)} || ' ' AS padded FROM {posts}),
  {out}_t AS (SELECT * FROM (SELECT *, {tokens_sql("term", cashtags)} AS phrase FROM {terms}) WHERE phrase <> ''),
  {out}_w AS (SELECT DISTINCT id, unnest(string_split(trim(padded), ' ')) AS word FROM {out}_p),
  {out} AS (
    SELECT p.*, t.* EXCLUDE (term, needs_context, term_no), t.term_no
    FROM {out}_w w JOIN {out}_t t ON split_part(t.phrase, ' ', 1) = w.word JOIN {out}_p p ON p.id = w.id
    WHERE contains(p.padded, ' ' || t.phrase || ' ') AND (NOT t.needs_context OR {around})
    QUALIFY row_number() OVER (PARTITION BY p.id, t.symbol ORDER BY t.term_no) = 1)"""


def keep_sql(body: str, context: tuple[str, ...]) -> str:
    """False-positive test on a matched pair."""
    texts = ["shortName", "longName", "name", *[f"'{w}'" for w in context]]
    hits = [f"coalesce({t} <> '' AND contains(lower({body}), lower({t})), false)" for t in texts]
    return f"({' OR '.join(hits)} OR contains({body}, symbol))"


# Stored comment rows and their times; matched pairs of all posts under all symbols.
COMMENTS_SQL = f"""
  clean AS (SELECT * REPLACE ({squeeze_sql("body")} AS body) FROM posts),
  {matched_sql("clean", "body", "cterms", "pairs", CONTEXT)}"""
PAIRS_SQL = f"{POSTS_SQL}, {POST_TERMS_SQL}, {COMMENTS_SQL}"


def spread_time(ts: Column) -> Column:
    start = F.unix_micros(F.lit(START).cast("timestamp"))
    return F.timestamp_micros(start + (F.unix_micros(ts.cast("timestamp")) - start) * SPREAD)


class Inputs:
    """Derived tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def documents(self) -> DataFrame:
        return spread_scan(self.table("documents"))

    @cached_property
    def posts(self) -> DataFrame:
        d, e = self.documents, self.table("events")
        return d.join(e, d.doc_id == e.event_id).select(
            d.doc_id.cast("string").alias("id"),
            d.doc_id.alias("n"),
            d.text.alias("body"),
            "lang",
            "source",
            spread_time(e.ts).alias("ts"),
            e.user_id.alias("u"),
            F.floor("value").cast("int").alias("score"),
            e.event_type.alias("kind"),
        )

    @cached_property
    def clean_posts(self) -> DataFrame:
        return clean_bodies(self.posts).withColumnRenamed("ts", "datetime")

    # Symbol master and dictionary

    @cached_property
    def named_lines(self) -> DataFrame:
        rows = ", ".join(f"({i}L, '{'|'.join(r)}')" for i, r in enumerate(NAMED_SYMBOLS))
        literal = self.spark.sql(f"SELECT * FROM VALUES {rows} AS v(file_pos, value)")
        words = F.split(normalize_text(F.col("text")), " ")
        bench = self.table("benchmark").select(
            (F.lit(1000) + F.col("item_id")).alias("file_pos"),
            F.concat(
                F.lit("B"),
                F.col("item_id").cast("string"),
                F.lit("|"),
                F.array_join(F.slice(words, 1, 2), " "),
                F.lit(" Inc.|"),
                F.array_join(F.slice(words, 1, 3), " "),
                F.lit(" Corporation, "),
                F.array_join(F.slice(words, 4, 2), " "),
            ).alias("value"),
        )
        return literal.unionByName(bench)

    @cached_property
    def part_lines(self) -> DataFrame:
        return self.table("part").select(
            (F.lit(1000000000) + F.col("p_partkey")).alias("file_pos"),
            F.expr("""concat_ws('|',
                concat(' ', upper(concat(substr(p_name, 1, 1), substr(split_part(p_name, ' ', 2), 1, 2))), p_size),
                CASE p_size % 5 WHEN 0 THEN p_name || ' Inc.' WHEN 1 THEN p_name || ' ' || p_brand || ' Corp'
                     WHEN 2 THEN split_part(p_name, ' ', 1) WHEN 3 THEN p_brand || ' (' || p_name || ')' ELSE '' END,
                CASE p_size % 4 WHEN 0 THEN 'The ' || p_name || ' ' || p_brand || ' Group, Inc.'
                     WHEN 1 THEN p_brand || '  ' || p_name || ' Holdings Limited'
                     WHEN 2 THEN split_part(p_name, ' ', 2) || ', ' || p_type
                     ELSE 'A.' || p_type || ' (' || p_name || ') ETF' END)""").alias("value"),
        )

    @cached_property
    def master(self) -> DataFrame:
        """Master rows of all symbols, repeated symbols included."""
        return parse_symbol_lines(self.named_lines.unionByName(self.part_lines))

    @cached_property
    def symbols(self) -> DataFrame:
        return last_wins(self.master)

    @cached_property
    def dictionary(self) -> DataFrame:
        literal = self.spark.sql(f"SELECT * FROM VALUES {_WORDS} AS v(word)")
        part = self.table("part")
        return dictionary_words(
            literal.unionByName(part.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("word"))).unionByName(
                part.select(F.col("p_type").alias("word"))
            )
        )

    @cached_property
    def comment_terms(self) -> DataFrame:
        return comment_symbol_terms(self.symbols, self.dictionary)

    @cached_property
    def tweet_terms(self) -> DataFrame:
        return tweet_symbol_terms(self.symbols, self.dictionary)

    @cached_property
    def pairs(self) -> DataFrame:
        """Every post under every symbol it matches, full text."""
        return match_symbols(self.clean_posts, self.comment_terms, "body", context_words=CONTEXT)

    # Tweets

    def _tweet(self, offset: int, text: Column, repeats: Column, author: Column) -> Column:
        no_text = F.lit(None).cast("string")
        n, u, kind = F.col("n"), F.col("u"), F.col("kind")
        reply = kind == "click"
        media = F.when(kind == "error", F.lit("photo")).when(
            kind == "signup", F.when(n % 2 == 0, F.lit("video")).otherwise(F.lit("animated_gif"))
        )
        point = F.array((n * 37 % 360).cast("double") - 180, (n * 17 % 180).cast("double") - 90)
        mention = F.struct(
            F.concat(F.lit("user_"), ((u + 2) % USERS).cast("string")).alias("screen_name"),
            ((u + 2) % USERS).cast("string").alias("id_str"),
        )
        link = F.struct(F.concat(F.lit("https://example.org/"), n.cast("string")).alias("expanded_url"))
        tag = F.struct(F.col("lang").alias("text"), F.array(F.lit(0), F.lit(2)).alias("indices"))
        stock = F.struct(F.upper("lang").alias("text"), F.array(F.lit(3), F.lit(5)).alias("indices"))

        def when_else_empty(condition: Column, item: Column) -> Column:
            return F.when(condition, F.array(item)).otherwise(F.slice(F.array(item), 1, 0))

        return F.struct(
            (n * 10 + offset).alias("id"),
            (n * 10 + offset).cast("string").alias("id_str"),
            (n * 10).cast("string").alias("conversation_id"),
            F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
            text.alias("full_text"),
            F.col("score").alias("favorite_count"),
            F.lit(False).alias("favorited"),
            F.when(reply, F.concat(F.lit("User_"), ((u + 1) % USERS).cast("string"))).alias("in_reply_to_screen_name"),
            F.when(reply, (n * 10 - 10).cast("string")).alias("in_reply_to_status_id"),
            F.when(reply, ((u + 1) % USERS).cast("string")).alias("in_reply_to_user_id"),
            (kind == "signup").alias("is_quote_status"),
            F.col("lang"),
            F.when(kind != "error", F.lit(False)).alias("possibly_sensitive"),
            (n % 4).cast("int").alias("quote_count"),
            (n % 7).cast("int").alias("reply_count"),
            (n % 50).cast("int").alias("retweet_count"),
            F.lit(False).alias("retweeted"),
            F.concat(F.lit('<a href="https://example.org" rel="nofollow">'), F.col("source"), F.lit("</a>")).alias(
                "source"
            ),
            F.when(n % 2 == 0, author).otherwise(no_text).alias("user_id"),
            author.alias("user_id_str"),
            repeats.alias("retweeted_status_id_str"),
            F.when(kind != "view", F.struct(point.alias("coordinates"))).alias("coordinates"),
            F.struct(F.concat(F.lit("Springfield, "), F.upper("lang")).alias("full_name")).alias("place"),
            F.struct(
                F.array(tag).alias("hashtags"),
                F.array(stock).alias("symbols"),
                when_else_empty(n % 4 == 0, mention).alias("user_mentions"),
                when_else_empty(n % 3 == 0, link).alias("urls"),
                F.when(media.isNotNull(), F.array(F.struct(media.alias("type")))).alias("media"),
            ).alias("entities"),
        )

    def _user(self) -> Column:
        u = F.col("u")
        return F.struct(
            F.date_format(F.col("ts") - F.expr("interval 365 days"), "EEE MMM dd HH:mm:ss '+0000' yyyy").alias(
                "created_at"
            ),
            (u * 3).cast("int").alias("favourites_count"),
            (u * 7).cast("int").alias("followers_count"),
            (u * 2).cast("int").alias("friends_count"),
            F.col("lang"),
            (u % 9).cast("int").alias("listed_count"),
            F.concat(F.lit("User "), u.cast("string")).alias("name"),
            (u * 6).cast("int").alias("normal_followers_count"),
            (u % 11 == 0).alias("protected"),
            F.concat(F.lit("User_"), u.cast("string")).alias("screen_name"),
            (u * 5).cast("int").alias("statuses_count"),
            (u % 5 == 0).alias("verified"),
        )

    @cached_property
    def tweets(self) -> DataFrame:
        """One flattened, derived tweet per post, for the filters."""
        manual = (F.col("kind") == "purchase") & (F.col("n") % 2 == 0)
        text = F.when(manual, F.concat(F.lit("RT @user_1: "), F.col("body"))).otherwise(F.col("body"))
        repeats = F.when(F.col("kind") == "view", (F.col("n") * 10 + 9).cast("string"))
        tweet = self._tweet(0, text, repeats, F.col("u").cast("string"))
        flat = self.posts.select(tweet.alias("t"), self._user().alias("user_data")).select("t.*", "user_data")
        return derive_tweets(flat, ASOF)

    @cached_property
    def response_texts(self) -> DataFrame:
        """One search response per post as JSON text, with every kind of timeline entry."""
        base, none = F.col("n") * 10, F.lit(None).cast("string")
        author = F.col("u").cast("string")
        body, kind = F.col("body"), F.col("kind")

        def number(offset: int) -> Column:
            return (base + offset).cast("string")

        def item(offset: int, repeats: Column, by: Column) -> Column:
            text = body if offset in (0, 4) else F.concat(F.lit(f"RT {offset}: "), body)
            return F.struct(number(offset).alias("key"), self._tweet(offset, text, repeats, by).alias("value"))

        more = (
            F.when(kind == "view", F.array(item(1, number(0), author)))
            .when(kind == "error", F.array(item(2, number(9), author)))
            .when(kind == "signup", F.array(item(3, none, F.concat(F.lit("gone-"), author))))
            .when(kind == "purchase", F.array(item(4, none, author)))
        )
        first = F.array(item(0, none, author))
        tweets = F.map_from_entries(
            F.when(F.col("score") == 0, F.slice(first, 1, 0))
            .when(more.isNotNull(), F.concat(first, more))
            .otherwise(first)
        )
        users = F.create_map(author, self._user())
        no_tweet = F.lit(None).cast("struct<id: string, promotedMetadata: map<string, string>>")
        no_tomb = F.lit(None).cast("struct<tweet: struct<id: string>>")
        no_ad = F.lit(None).cast("map<string, string>")

        def entry(name: Column, tweet: Column = no_tweet, tomb: Column = no_tomb) -> Column:
            content = F.struct(tweet.alias("tweet"), tomb.alias("tombstone"))
            return F.struct(
                name.alias("entryId"),
                F.struct(F.struct(content.alias("content")).alias("item")).alias("content"),
            )

        def shown(offset: int, ad: Column = no_ad) -> Column:
            return F.struct(number(offset).alias("id"), ad.alias("promotedMetadata"))

        def named(prefix: str, offset: int) -> Column:
            return F.concat(F.lit(prefix), number(offset))

        entries = F.array(
            entry(named("tweet-", 0), shown(0)),
            entry(named("sq-I-t-", 1), shown(1)),
            entry(named("tweet-", 2), shown(2)),
            entry(named("tweet-", 3), shown(3)),
            entry(named("tweet-", 4), tomb=F.struct(F.struct(number(4).alias("id")).alias("tweet"))),
            entry(named("tweet-", 0), shown(0, F.create_map(F.lit("advertiser"), F.lit("ad")))),
            entry(F.lit("tweet-unknown")),
            entry(F.lit("sq-cursor-bottom")),
        )
        response = F.struct(
            F.col("id").alias("response_id"),
            F.struct(tweets.alias("tweets"), users.alias("users")).alias("globalObjects"),
            F.struct(F.array(F.struct(F.struct(entries.alias("entries")).alias("addEntries"))).alias("instructions"))
            .alias("timeline"),
        )
        return self._as_captured(response)

    def _as_captured(self, response: Column) -> DataFrame:
        return compute_once(self.posts, "value", F.to_json(response)).select("value")

    @cached_property
    def responses(self) -> DataFrame:
        return parse_tweet_responses(self.response_texts)

    def _captured_files(self, texts: DataFrame, purpose: str) -> str:
        path = shared_dir(self.spark, purpose)
        texts.select("value").write.option("compression", "gzip").text(path)
        return path

    @cached_property
    def response_files(self) -> DataFrame:
        """The responses as files of lines: counts as text or with a fraction, flags that are none, lists of no entries."""
        n = F.get_json_object("value", "$.response_id").cast("bigint")
        value = F.when(n % 2 == 0, F.regexp_replace("value", '"retweet_count":([0-9]+)', '"retweet_count":"$1"')).otherwise(
            F.regexp_replace("value", '"retweet_count":([0-9]+)', '"retweet_count":$1.0')
        )
        flag = '"possibly_sensitive":(true|false)'
        value = F.when(n % 5 == 0, F.regexp_replace(value, flag, '"possibly_sensitive":"maybe"')).otherwise(value)
        empty = '"timeline":{"instructions":[]}}'
        value = F.when(n % 11 == 0, F.regexp_replace(value, '"timeline":\\{.*$', empty)).otherwise(value)
        return read_tweet_responses(
            self.spark, self._captured_files(self.response_texts.select(value.alias("value")), "responses")
        )

    # Comments

    @cached_property
    def page_texts(self) -> DataFrame:
        """One comment page per post as JSON text; each line of the post is a comment."""
        n, u = F.col("n").cast("string"), F.col("u")
        line = F.transform(
            F.split("body", "\n"),
            lambda text, i: F.struct(
                F.concat(n, F.lit("-"), i.cast("string")).alias("id"),
                F.concat(F.lit("t3_"), n).alias("link_id"),
                F.when(i > 0, F.concat(n, F.lit("-"), (i - 1).cast("string"))).alias("parent_id"),
                (i + 1).alias("nest_level"),
                F.lit(None).cast("string").alias("reply_delay"),
                (i % 2).alias("controversiality"),
                text.alias("body"),
                (F.unix_seconds("ts") + i).alias("created_utc"),
                (F.col("score") - i).alias("score"),
                F.col("source").alias("subreddit"),
                F.concat(F.lit("t5_"), F.col("source")).alias("subreddit_id"),
                F.concat(F.lit("user_"), u.cast("string")).alias("author"),
                F.when(u % 3 > 0, F.concat(F.lit("t2_"), u.cast("string"))).alias("author_fullname"),
                F.when(u % 4 > 0, u * 86400 * 30).alias("author_created_utc"),
            ),
        )
        return self._as_captured(F.struct(line.alias("data")))

    @cached_property
    def pages(self) -> DataFrame:
        return parse_comment_pages(self.page_texts)

    @cached_property
    def page_files(self) -> DataFrame:
        """The pages as files of lines: times as text or with a fraction, scores that are no numbers."""
        n = F.split_part(F.get_json_object("value", "$.data[0].link_id"), F.lit("_"), F.lit(2)).cast("bigint")
        time = '"created_utc":([0-9]+)'
        value = F.when(n % 2 == 0, F.regexp_replace("value", time, '"created_utc":"$1"')).otherwise(
            F.regexp_replace("value", time, '"created_utc":$1.0')
        )
        value = F.when(n % 7 == 0, F.regexp_replace(value, '"score":-?[0-9]+', '"score":"many"')).otherwise(value)
        return read_comment_pages(self.spark, self._captured_files(self.page_texts.select(value.alias("value")), "pages"))

    @cached_property
    def comments(self) -> DataFrame:
        return flatten_comments(self.pages)

    def stored_comments(self, pairs: DataFrame, version: str = "v1", hours: int = 0) -> DataFrame:
        """Matched posts in the stored comment shape; ``version`` marks the copy, ``hours`` delays it."""
        return derive_calendar(pairs).select(
            "id",
            F.lit(None).cast("string").alias("link_id"),
            F.lit(None).cast("string").alias("parent_id"),
            F.lit(1).alias("nest_level"),
            F.lit(version).alias("reply_delay"),
            F.lit(False).alias("controversiality"),
            "body",
            "datetime",
            "day_of_week",
            "date",
            "time",
            "score",
            F.col("source").alias("subreddit"),
            F.concat(F.lit("t5_"), F.col("source")).alias("subreddit_id"),
            (F.lit(ASOF).cast("timestamp") + F.expr(f"interval {hours} hours")).alias("update_datetime"),
            F.concat(F.lit("user_"), F.col("u").cast("string")).alias("author"),
            F.lit(None).cast("string").alias("author_fullname"),
            F.lit("1970-01-01").cast("timestamp").alias("author_datetime"),
            "symbol",
        )


TWEET_TEXT_SQL = """CASE WHEN kind = 'purchase' AND n % 2 = 0 THEN 'RT @user_1: ' || body ELSE body END"""
TWEETS_SQL = f"""
  tw AS (
    SELECT CAST(n * 10 AS VARCHAR) AS id, n, u, kind, lang, source, ts, score AS favorite_count,
      {squeeze_sql(TWEET_TEXT_SQL)} AS full_text,
      'User_' || u AS screen_name, u % 5 = 0 AS verified,
      CASE WHEN kind = 'click' THEN 'User_' || ((u + 1) % {USERS}) END AS reply_name,
      CASE WHEN kind = 'click' THEN CAST(n * 10 - 10 AS VARCHAR) END AS reply_status,
      kind = 'view' AS is_retweet, n % 50 AS retweet_count, n % 7 AS reply_count,
      CASE WHEN kind = 'error' THEN 'photo' WHEN kind = 'signup' AND n % 2 = 0 THEN 'video'
           WHEN kind = 'signup' THEN 'animated_gif' END AS media,
      n % 3 = 0 AS has_url, CASE WHEN n % 4 = 0 THEN 'user_' || ((u + 2) % {USERS}) END AS mention,
      CASE WHEN kind <> 'view' THEN CAST(n * 37 % 360 AS DOUBLE) - 180 END AS lon,
      CASE WHEN kind <> 'view' THEN CAST(n * 17 % 180 AS DOUBLE) - 90 END AS lat,
      'Springfield, ' || upper(lang) AS place
    FROM posts)"""
