import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlake.operators.incremental import (
    incremental_select,
    recency_skip,
    resume_points,
    slice_grid,
    slice_stats,
)
from postlake.operators.stats import get_first, newest, oldest, size_by_symbol, sort_tweets


def posts(spark):
    rows = [("A", "1", "2024-01-01", 5), ("A", "2", "2024-01-03", None), ("A", "3", "2024-01-03", 5),
            ("B", "4", "2024-01-02", 1), ("B", "5", None, 2)]
    return spark.createDataFrame(rows, "symbol string, id string, day string, score int").selectExpr(
        "symbol", "id", "timestamp(day) AS datetime", "score"
    )


def test_first_rows(spark):
    df = posts(spark)

    def ids(out):
        assert out.columns == df.columns
        return {r.symbol: r.id for r in out.collect()}

    assert ids(newest(df)) == {"A": "3", "B": "4"}
    assert ids(oldest(df)) == {"A": "1", "B": "5"}
    assert ids(get_first(df, "score", "DESC")) == {"A": "3", "B": "5"}
    assert ids(get_first(df, "score", "ASC")) == {"A": "2", "B": "4"}
    with pytest.raises(ValueError):
        get_first(df, "score", "down")


def test_first_row_when_all_values_are_null(spark):
    df = posts(spark).withColumn("score", F.lit(None).cast("int"))
    assert {r.symbol: r.id for r in get_first(df, "score").collect()} == {"A": "3", "B": "5"}


def test_sizes_and_sort(spark):
    symbols = spark.createDataFrame([("A",), ("Z",)], "symbol string")
    assert {r.symbol: r.n_rows for r in size_by_symbol(posts(spark), symbols).collect()} == {"A": 3, "Z": None}
    df = spark.createDataFrame([("10",), ("9",)], "id string")
    assert [r.id for r in sort_tweets(df).collect()] == ["9", "10"]


def points(spark):
    symbols = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    return resume_points(symbols, posts(spark), "2023-12-30")


def test_resume_and_recency(spark):
    got = {r.symbol: str(r.since) for r in points(spark).collect()}
    assert got == {"A": "2024-01-03 00:00:00", "B": "2024-01-02 00:00:00", "C": "2023-12-30 00:00:00"}

    def skipped(recency):
        rows = recency_skip(points(spark), "2024-01-04", recency).collect()
        return sorted(r.symbol for r in rows if r.skip)

    assert skipped(dt.timedelta(days=2)) == ["A"]
    assert skipped(dt.timedelta(days=3)) == ["A", "B"]
    assert skipped(None) == []


def test_grid_is_clamped_and_never_empty(spark):
    got = [(r.symbol, str(r.slice_start), str(r.slice_end)) for r in slice_grid(points(spark), "2024-01-02 12:00:00").collect()]
    assert sorted(got) == [
        ("A", "2024-01-03 00:00:00", "2024-01-03 00:00:00"),
        ("B", "2024-01-02 00:00:00", "2024-01-02 12:00:00"),
        ("C", "2023-12-30 00:00:00", "2024-01-02 00:00:00"),
        ("C", "2024-01-02 00:00:00", "2024-01-02 12:00:00"),
    ]
    exact = slice_grid(points(spark).where("symbol = 'C'"), "2024-01-02")
    assert exact.count() == 1


def test_slice_stats_and_selection(spark):
    since = points(spark).where("symbol <> 'A'").unionByName(
        spark.sql("SELECT 'A' AS symbol, CAST(NULL AS timestamp) AS newest, timestamp '2024-01-01' AS since")
    )
    got = {(r.symbol, str(r.slice_start)): (str(r.first_datetime), str(r.last_datetime), r.n_posts)
           for r in slice_stats(posts(spark), since, "2024-01-03 06:00:00").collect()}
    assert got[("A", "2024-01-01 00:00:00")] == ("2024-01-01 00:00:00", "2024-01-03 00:00:00", 3)
    assert got[("C", "2023-12-30 00:00:00")] == ("2023-12-30 00:00:00", "2024-01-02 00:00:00", 0)
    assert sorted(r.id for r in incremental_select(posts(spark), since).collect()) == ["2", "3"]


def test_nothing_is_kept_between_calls(spark, tmp_path):
    """A file added from outside is seen by the next call."""
    path, schema = str(tmp_path / "posts"), "symbol string, id string, datetime timestamp"
    for day in (1, 2):
        spark.createDataFrame([("A", str(day))], "symbol string, id string").selectExpr(
            "symbol", "id", f"timestamp'2024-01-0{day} 00:00:00' AS datetime"
        ).write.mode("append").parquet(path)
        assert [r.id for r in newest(spark.read.schema(schema).parquet(path)).collect()] == [str(day)]
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
