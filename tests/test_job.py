"""Incremental runs: resume points, dispositions, and going on after a crash."""

import datetime as dt
import json

import pytest

from postlake.operators.table import PostTable, scratch_database
from postlake.plans.job import Run, run_comments
from postlake.schemas import REDDIT
from postlake.session import shared_dir
from postlake.sources.responses import read_comment_pages
from tests.test_plans import comment, master

DAY = 86400


def at(day):
    return 1704067200 + round(day * DAY)  # from 2024-01-01


@pytest.fixture
def pages(spark, tmp_path):
    data = [
        comment("1", "zyxcorp is up", created_utc=at(1)),
        comment("2", "zyxcorp is down", created_utc=at(9)),
        comment("3", "the gap stocks", created_utc=at(2)),
        comment("4", "mind the gap", created_utc=at(12)),
        comment("5", "x" * 2100 + ". zyxcorp", created_utc=at(3)),
        comment("6", "zyxcorp and gap, inc", created_utc=at(4), author=None),
        comment("7", "zyxcorp before the start", created_utc=at(-3)),
    ]
    (tmp_path / "p.json").write_text(json.dumps({"data": data}) + "\n")
    return read_comment_pages(spark, str(tmp_path))


def stored(table):
    return sorted((r.symbol, r.id) for r in table.read().collect())


def test_two_runs_and_a_skipped_symbol(spark, pages):
    table, folder = PostTable(spark, scratch_database(spark), REDDIT, 4), shared_dir(spark, "runs")
    first = Run(table, f"{folder}/1", "2024-01-08", "2024-01-01")
    assert run_comments(first, pages, *master(spark)) == 2
    assert stored(table) == [("GAP", "3"), ("ZYX", "1")]
    counts = {(r.symbol, r.disposition): r.n_pairs for r in first.counts().collect()}
    assert counts == {
        ("ZYX", "new"): 1, ("ZYX", "later"): 1, ("ZYX", "false_positive"): 1, ("ZYX", "reject"): 1, ("ZYX", "old"): 1,
        ("GAP", "new"): 1, ("GAP", "later"): 1, ("GAP", "reject"): 1,
    }
    assert {(r.symbol, r.id, r.reject_reason) for r in first.rejects().collect()} == {("ZYX", "6", "author"), ("GAP", "6", "author")}
    assert sum(r.n_posts for r in first.slices().collect()) == 2
    # GAP has a post of the 3rd, ZYX of the 2nd: an edge between them skips GAP
    second = Run(table, f"{folder}/2", "2024-01-20", "2024-01-01", dt.timedelta(days=17, hours=12))
    assert run_comments(second, pages, *master(spark)) == 1
    assert stored(table) == [("GAP", "3"), ("ZYX", "1"), ("ZYX", "2")]
    assert {r.symbol for r in second.slices().collect()} == {"ZYX"}


def test_a_run_goes_on_after_a_crash(spark, pages, monkeypatch):
    table, folder = PostTable(spark, scratch_database(spark), REDDIT, 4), shared_dir(spark, "run")

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(PostTable, "_changing_keys", fail)  # the record is written, nothing is stored
        with pytest.raises(OSError):
            run_comments(Run(table, folder, "2024-01-20", "2024-01-01"), pages, *master(spark))
    assert stored(table) == []
    # part of the rows get in by another way; the points stay as they were, so nothing is left out
    record = spark.read.parquet(f"{folder}/record").where("disposition = 'new' AND id = '2'")
    assert table.insert_ignore(record.select(*table.columns)) == 1
    with monkeypatch.context() as m:
        m.setattr("postlake.plans.job.comment_pairs", lambda *_: None)  # the posts are not matched again
        assert run_comments(Run(table, folder, "2024-01-20", "2024-01-01"), pages, *master(spark)) == 3
    assert stored(table) == [("GAP", "3"), ("GAP", "4"), ("ZYX", "1"), ("ZYX", "2")]
