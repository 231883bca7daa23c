"""Counts, sorts and first rows, for all symbols at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.operators.sizing import broadcast_if_small


def size_by_symbol(posts: DataFrame, symbols: DataFrame | None = None) -> DataFrame:
    """Stored rows per symbol; with ``symbols`` given, one row each, NULL where nothing is stored."""
    counts = posts.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts if symbols is None else symbols.select("symbol").join(counts, "symbol", "left")


def get_first(posts: DataFrame, order_by: str = "datetime", order: str = "DESC", stored: bool = False) -> DataFrame:
    """Per symbol the row with the largest (``DESC``) or smallest ``order_by``, NULL being smallest.

    Ties go to the largest id for ``DESC`` and the smallest for ``ASC``. ``posts`` are read once, and a task passes on
    one row a symbol. Of ``stored`` posts, where reading again is cheap and reading texts is not, the best values
    are found from two narrow columns first, and only rows that have them are read in full.
    """
    if order not in ("ASC", "DESC"):
        raise ValueError(f"order must be ASC or DESC, not {order!r}")
    value = F.struct(F.col(order_by).isNotNull().alias("known"), F.col(order_by).alias("v"))
    pick = F.max_by if order == "DESC" else F.min_by
    if stored:
        posts = _with_best_value(posts, order_by, order)
    rest = [c for c in posts.columns if c != "symbol"]
    return (
        posts.groupBy("symbol")
        .agg(pick(F.struct(*rest), F.struct(value, "id")).alias("r"))
        .select("symbol", "r.*")
        .select(*posts.columns)
    )


def _with_best_value(posts: DataFrame, order_by: str, order: str) -> DataFrame:
    if order == "DESC":
        best = F.max(order_by)
    else:
        best = F.when(F.max(F.col(order_by).isNull()), F.lit(None)).otherwise(F.min(order_by))
    narrow, _ = broadcast_if_small(posts.groupBy(F.col("symbol").alias("_symbol")).agg(best.alias("_best")))
    return posts.join(
        narrow, (F.col("symbol") == F.col("_symbol")) & F.col(order_by).eqNullSafe(F.col("_best"))
    ).drop("_symbol", "_best")


def newest(posts: DataFrame, stored: bool = False) -> DataFrame:
    return get_first(posts, "datetime", "DESC", stored)


def oldest(posts: DataFrame, stored: bool = False) -> DataFrame:
    return get_first(posts, "datetime", "ASC", stored)


def sort_comments(comments: DataFrame) -> DataFrame:
    """By creation time, ascending."""
    return comments.orderBy("created_utc", "id")


def sort_tweets(tweets: DataFrame) -> DataFrame:
    """By numeric id, ascending; ids that are no numbers come first, by text."""
    return tweets.orderBy(F.col("id").try_cast("bigint"), "id")


def posts_union(tweets: DataFrame, comments: DataFrame) -> DataFrame:
    """Both networks as one relation of their common meaning."""
    t = tweets.select(
        F.lit("twitter").alias("network"),
        "id",
        F.col("full_text").alias("body"),
        "datetime",
        F.col("user_data.screen_name").alias("author"),
    )
    c = comments.select(F.lit("reddit").alias("network"), "id", "body", "datetime", "author")
    return t.unionByName(c)
