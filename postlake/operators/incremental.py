"""Resume points, slices, and what is new since the last run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.times import SLICE_DAYS, as_ts, slice_start
from postlake.operators.sizing import broadcast_if_small, stored

Time = Column | dt.datetime | str


def resume_points(symbols: DataFrame, stored: DataFrame, start_date: Time) -> DataFrame:
    """(symbol, newest, since): newest stored time of each symbol, and that or the start date."""
    newest = stored.groupBy("symbol").agg(F.max("datetime").alias("newest"))
    return (
        symbols.select("symbol")
        .join(newest, "symbol", "left")
        .withColumn("since", F.coalesce("newest", as_ts(start_date)))
    )


def recency_skip(points: DataFrame, asof: Time, recency: dt.timedelta | None) -> DataFrame:
    """Add ``skip``: the newest stored post is younger than ``recency``. Never without one of both."""
    if recency is None:
        return points.withColumn("skip", F.lit(False))
    edge = as_ts(asof) - F.lit(recency)
    return points.withColumn("skip", F.coalesce(F.col("newest") > edge, F.lit(False)))


def slice_grid(points: DataFrame, until: Time, days: int = SLICE_DAYS) -> DataFrame:
    """(symbol, slice_start, slice_end): steps of ``days`` from ``since``, the last one clamped.

    At least one slice each, of zero width when ``since`` is not before ``until``.
    """
    end, step = as_ts(until), F.expr(f"interval {days} days")
    last = F.greatest(F.col("since"), end - F.expr("interval 1 microsecond"))
    starts = points.select("symbol", F.explode(F.sequence("since", last, step)).alias("slice_start"))
    bound = F.least(F.col("slice_start") + step, end)
    return starts.withColumn("slice_end", F.greatest(bound, F.col("slice_start")))


def slice_stats(posts: DataFrame, points: DataFrame, until: Time, days: int = SLICE_DAYS) -> DataFrame:
    """Per symbol and slice: first and last post time and count; an empty slice shows its bounds, 0.

    Counts are reduced per (symbol, slice) before they meet the grid, so a hot symbol moves one
    small row per task. The points are computed once.
    """
    points = stored(points, "points")
    anchors, _ = broadcast_if_small(points.select("symbol", "since"))
    placed = (
        posts.select("symbol", "datetime")
        .join(anchors, "symbol")
        .where((F.col("datetime") >= F.col("since")) & (F.col("datetime") < as_ts(until)))
        .withColumn("slice_start", slice_start(F.col("datetime"), F.col("since"), days))
    )
    stats = placed.groupBy("symbol", "slice_start").agg(
        F.min("datetime").alias("lo"), F.max("datetime").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    return (
        slice_grid(points, until, days)
        .join(stats, ["symbol", "slice_start"], "left")
        .select(
            "symbol",
            "slice_start",
            "slice_end",
            F.coalesce("lo", "slice_start").alias("first_datetime"),
            F.coalesce("hi", "slice_end").alias("last_datetime"),
            F.coalesce("n", F.lit(0)).alias("n_posts"),
        )
    )


def incremental_select(posts: DataFrame, points: DataFrame) -> DataFrame:
    """Posts younger than their symbol's resume point."""
    since, _ = broadcast_if_small(points.select("symbol", "since"))
    return posts.join(since, "symbol").where(F.col("datetime") > F.col("since")).select(*posts.columns)
