import datetime as dt

from pyspark.sql import functions as F

from postlake.functions.times import (
    as_ts,
    day_of_week,
    derive_calendar,
    epoch_or_zero,
    parse_epoch,
    parse_tweet_time,
    slice_start,
)


def one(spark, column):
    return spark.range(1).select(column.cast("string")).first()[0]


def test_tweet_time(spark):
    assert one(spark, parse_tweet_time(F.lit("Mon Jan 01 00:00:07 +0000 2024"))) == "2024-01-01 00:00:07"
    assert one(spark, parse_tweet_time(F.lit("Mon Jan 01 00:00:07 +0100 2024"))) == "2023-12-31 23:00:07"
    assert one(spark, parse_tweet_time(F.lit("not a time"))) is None


def test_epoch(spark):
    assert one(spark, parse_epoch(F.lit(86400))) == "1970-01-02 00:00:00"
    assert one(spark, epoch_or_zero(F.lit(None))) == "1970-01-01 00:00:00"


def test_calendar(spark):
    row = derive_calendar(spark.range(1).select(as_ts("2024-02-29 23:59:58").alias("datetime"))).first()
    assert (row.day_of_week, row.date, row.time) == ("Thursday", dt.date(2024, 2, 29), "23:59:58")
    assert one(spark, day_of_week(as_ts(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)))) == "Friday"


def test_slices_are_counted_from_the_start(spark):
    since = as_ts("2024-01-02 05:00:00")
    assert one(spark, slice_start(as_ts("2024-01-05 04:59:59.999999"), since)) == "2024-01-02 05:00:00"
    assert one(spark, slice_start(as_ts("2024-01-05 05:00:00"), since)) == "2024-01-05 05:00:00"
    assert one(spark, slice_start(as_ts("2024-01-01 00:00:00"), since)) == "2023-12-30 05:00:00"
