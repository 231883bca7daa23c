import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postlake.operators.match import observe_false_positives
from postlake.operators.project import clean_bodies, derive_comments, project_row
from postlake.operators.table import PostTable, scratch_database
from postlake.operators.flatten import flatten_comments
from postlake.schemas import REDDIT
from postlake.session import shared_dir
from postlake.sources.responses import stream_comment_pages
from postlake.streaming.ingest import append_files, append_new, drop_recent_duplicates, slice_stats_stream


def page(path, name, ids, epoch=86400 * 19000):
    comment = {"body": "b", "score": 1, "subreddit": "s", "subreddit_id": "t", "author": "a"}
    data = [{**comment, "id": str(i), "created_utc": epoch + i} for i in ids]
    (path / f"{name}.json").write_text(json.dumps({"data": data}) + "\n")


def test_pages_arrive_are_stored_once_and_survive_a_replay(spark, tmp_path):
    table = PostTable(spark, scratch_database(spark), REDDIT, 4)
    checkpoint = shared_dir(spark, "checkpoint")

    def rows():
        pages = stream_comment_pages(spark, str(tmp_path), files_per_trigger=1)
        clean = clean_bodies(derive_comments(flatten_comments(pages), "2024-01-01"))
        return project_row(clean, REDDIT).withColumn("symbol", F.lit("S"))

    page(tmp_path, "one", range(10))
    page(tmp_path, "two", range(5, 15))
    append_new(rows(), table, checkpoint).awaitTermination()
    assert table.read().count() == 15
    page(tmp_path, "three", range(100), epoch=0)
    query = append_new(rows(), table, checkpoint)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    # rows far older than anything seen are still taken, ids already stored are not
    assert table.read().count() == 100
    # from the start under another checkpoint
    append_new(rows(), table, shared_dir(spark, "checkpoint")).awaitTermination()
    assert table.read().count() == 100
    with pytest.raises(ValueError, match="checkpoint"):
        append_new(rows(), table, "")


def test_a_batch_delivered_again_is_recognised(spark, tmp_path):
    """The stream stops after a write, before its commit; the replayed batch is not inserted again."""
    table, checkpoint = PostTable(spark, scratch_database(spark), REDDIT, 4), shared_dir(spark, "checkpoint")
    prepared = []

    def rows():
        pages = stream_comment_pages(spark, str(tmp_path), files_per_trigger=1)
        clean = clean_bodies(derive_comments(flatten_comments(pages), "2024-01-01"))
        return project_row(clean, REDDIT).withColumn("symbol", F.lit("S"))

    def prepare(batch):
        prepared.append(batch.count())
        return batch

    for n, ids in enumerate((range(10), range(5, 15), range(12, 30)), 1):
        page(tmp_path, f"p{n}", ids)
        append_new(rows(), table, checkpoint, prepare).awaitTermination()
    last = max(Path(checkpoint, "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for commit in (last, last.with_name(f".{last.name}.crc")):
        commit.unlink(missing_ok=True)
    append_new(rows(), table, checkpoint, prepare).awaitTermination()
    assert prepared == [10, 10, 18]
    assert sorted(int(r.id) for r in table.read().select("id").collect()) == list(range(30))


def events(spark, tmp_path, times):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(times)], "id string, t string")
    df.selectExpr("id", "'S' AS symbol", "timestamp(t) AS datetime").coalesce(1).write.mode("append").parquet(str(tmp_path))
    return spark.readStream.schema("id string, symbol string, datetime timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path))


def run(spark, df):
    path = shared_dir(spark, "out")
    append_files(df, path, shared_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def test_slices_close_with_the_watermark(spark, tmp_path):
    stream = events(spark, tmp_path / "e", ["2024-01-02 05:00:00", "2024-01-05 04:59:59", "2024-01-05 05:00:00", "2024-01-09 00:00:00"])
    stats = slice_stats_stream(stream, dt.datetime(2024, 1, 2, 5), "1 hour")
    got = [(str(r.slice_start), str(r.slice_end), r.n_posts) for r in run(spark, stats).collect()]
    assert sorted(got) == [("2024-01-02 05:00:00", "2024-01-05 05:00:00", 2), ("2024-01-05 05:00:00", "2024-01-08 05:00:00", 1)]


def test_removed_matches_are_reported_per_batch(spark, tmp_path):
    rows = [("ABC", "abcorp", "abc only"), ("ABC", "abcorp", "ABC"), ("ABC", "abcorp", "Abcorp")]
    spark.createDataFrame(rows, "symbol string, name string, body string").coalesce(1).write.parquet(str(tmp_path / "p"))
    stream = spark.readStream.schema("symbol string, name string, body string").parquet(str(tmp_path / "p"))
    pairs = stream.withColumns({"shortName": F.lit(None).cast("string"), "longName": F.lit("")})
    query = append_files(
        observe_false_positives(pairs, "matches").select("body"), shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    )
    query.awaitTermination()
    seen = [p["observedMetrics"]["matches"] for p in query.recentProgress if p["numInputRows"]]
    assert [(m["n_matched"], m["n_removed"]) for m in seen] == [(3, 1)]


def test_optional_sieve_drops_copies(spark, tmp_path):
    stream = events(spark, tmp_path / "e", ["2024-01-02", "2024-01-02", "2024-01-03"])
    same = stream.withColumn("id", F.lit("x"))
    assert run(spark, drop_recent_duplicates(same, "datetime", "5 days")).count() == 1
