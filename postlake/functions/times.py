"""Time parsing and calendar parts. All times are UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_DAYS = 3
_MICROS_PER_DAY = 86_400_000_000


def parse_tweet_time(created_at: Column, strict: bool = False) -> Column:
    """``'Mon Jan 01 00:00:07 +0000 2024'`` to a timestamp; junk is NULL unless ``strict``.

    The weekday is skipped since it adds nothing and is not accepted when parsing.
    """
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(F.substring(created_at, 5, 40), F.lit("MMM dd HH:mm:ss Z yyyy"))


def parse_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.cast("bigint"))


def epoch_or_zero(seconds: Column) -> Column:
    """Author creation time; a missing one counts as the epoch."""
    return F.timestamp_seconds(F.coalesce(seconds.cast("bigint"), F.lit(0)))


def day_of_week(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def clock_time(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def date_time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def derive_calendar(df: DataFrame, ts: str = "datetime") -> DataFrame:
    return df.withColumns(
        {"day_of_week": day_of_week(F.col(ts)), "date": F.to_date(ts), "time": clock_time(F.col(ts))}
    )


def as_ts(value: Column | dt.datetime | str) -> Column:
    """Timestamp column from a column, a datetime (naive means UTC) or its text."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def slice_start(ts: Column, since: Column, days: int = SLICE_DAYS) -> Column:
    """Start of the ``days``-long slice holding ``ts``, slices being counted from ``since``.

    Plain arithmetic, because ``window()`` counts from 1970 and a per-symbol ``since`` can be no
    literal offset.
    """
    elapsed = F.unix_micros(ts) - F.unix_micros(since)
    return F.timestamp_micros(F.unix_micros(ts) - F.pmod(elapsed, F.lit(days * _MICROS_PER_DAY)))
