"""One incremental run over what was captured: resume points, one classified record, insert, report.

A run has a folder of its own, in which each step leaves its result: the resume points as they were before the run, then
the record of every matched pair with what becomes of it. A run that is started again under the same folder takes finished
steps from there, so it goes on from the same points although part of its rows may be stored by now; inserting again
adds nothing. Posts are matched once; inserts, rejects and the report all read the record.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions.times import as_ts
from postlake.operators.enrich import CONTEXT_WORDS
from postlake.operators.filters import CommentFilter, TweetFilter
from postlake.operators.flatten import flatten_comments, flatten_tweets
from postlake.operators.incremental import recency_skip, resume_points, slice_stats
from postlake.operators.project import null_reasons
from postlake.operators.sizing import broadcast_if_small
from postlake.operators.table import PostTable
from postlake.plans.comments import comment_pairs, comment_symbol_terms
from postlake.plans.tweets import tweet_pairs, tweet_symbol_terms
from postlake.session import path_exists

NEW = "new"
OLD = "old"
LATER = "later"
FALSE_POSITIVE = "false_positive"
REJECT = "reject"


class Run:
    """A run into ``table``. ``folder`` is a shared folder of this run alone; ``asof`` is the run's time, up to which
    posts are taken and with which they are stamped. Symbols with a post younger than ``recency`` are left out."""

    def __init__(
        self,
        table: PostTable,
        folder: str,
        asof: dt.datetime | str,
        start_date: dt.datetime | str,
        recency: dt.timedelta | None = None,
    ):
        self.table, self.folder, self.asof, self.start_date, self.recency = table, folder.rstrip("/"), asof, start_date, recency
        self.spark = table.spark

    def _once(self, step: str, make: Callable[[], DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
        """The result of a step: read, if an earlier attempt finished it, else made. A broken attempt is overwritten."""
        path = f"{self.folder}/{step}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            make().write.mode("overwrite").partitionBy(*by).parquet(path)
        return self.spark.read.parquet(path)

    def points(self, symbols: DataFrame) -> DataFrame:
        """(symbol, newest, since, skip) as of before the run."""

        def make() -> DataFrame:
            self.table.create()
            stored = self.table.summary().select("symbol", F.col("newest")["datetime"].alias("datetime"))
            points = resume_points(symbols, stored, self.start_date)
            return recency_skip(points, self.asof, self.recency)

        return self._once("points", make)

    def wanted(self, terms: DataFrame, symbols: DataFrame) -> DataFrame:
        """Terms of the symbols that this run does not skip."""
        return terms.join(self.points(symbols).where("NOT skip").select("symbol"), "symbol", "left_semi")

    def record(self, pairs: DataFrame, symbols: DataFrame) -> DataFrame:
        """Every pair (stored columns, symbol, ``is_true``) with its ``disposition`` and ``reject_reason``.

        ``old``: not younger than the symbol's resume point. ``later``: not before this run's time. ``false_positive``:
        the stored text does not speak of the symbol. ``reject``: a required value is missing. The others are ``new``.
        """

        def make() -> DataFrame:
            since, _ = broadcast_if_small(self.points(symbols).where("NOT skip").select("symbol", "since"))
            reason = null_reasons(self.table.network)
            known_time = F.col("datetime").isNotNull()
            disposition = (
                F.when(known_time & (F.col("datetime") <= F.col("since")), F.lit(OLD))
                .when(known_time & (F.col("datetime") >= as_ts(self.asof)), F.lit(LATER))
                .when(~F.col("is_true"), F.lit(FALSE_POSITIVE))
                .when(reason != "", F.lit(REJECT))
                .otherwise(F.lit(NEW))
            )
            placed = pairs.join(since, "symbol").withColumns({"disposition": disposition, "reject_reason": reason})
            return placed.drop("since", "is_true")

        return self._once("record", make, ("disposition",))

    def _of(self, disposition: str) -> DataFrame:
        """Record rows of one disposition; no others are read."""
        return self.spark.read.parquet(f"{self.folder}/record").where(F.col("disposition") == disposition)

    def insert(self) -> int:
        """Store the new rows; returns how many were not stored before."""
        return self.table.insert_ignore(self._of(NEW).select(*self.table.columns))

    def rejects(self) -> DataFrame:
        return self._of(REJECT).drop("disposition")

    def counts(self) -> DataFrame:
        """Pairs per symbol and disposition."""
        record = self.spark.read.parquet(f"{self.folder}/record")
        return record.groupBy("symbol", "disposition").agg(F.count(F.lit(1)).alias("n_pairs"))

    def slices(self) -> DataFrame:
        """Per symbol and slice from its resume point on: first and last time and count of the new rows."""
        points = self.spark.read.parquet(f"{self.folder}/points").where("NOT skip")
        return slice_stats(self._of(NEW).select("symbol", "datetime"), points, self.asof)


def run_comments(
    run: Run,
    pages: DataFrame,
    symbols: DataFrame,
    dictionary: DataFrame,
    search: CommentFilter | None = None,
    context_words: tuple[str, ...] = CONTEXT_WORDS,
) -> int:
    """Captured comment pages into the run's table; returns how many rows are new."""
    terms = run.wanted(comment_symbol_terms(symbols, dictionary), symbols)
    run.record(comment_pairs(flatten_comments(pages), terms, run.asof, search, context_words), symbols)
    return run.insert()


def run_tweets(
    run: Run,
    responses: DataFrame,
    symbols: DataFrame,
    dictionary: DataFrame,
    search: TweetFilter | None = None,
    list_members: DataFrame | None = None,
) -> int:
    """Captured search responses into the run's table; returns how many rows are new."""
    terms = run.wanted(tweet_symbol_terms(symbols, dictionary), symbols)
    pairs = tweet_pairs(flatten_tweets(responses), terms, run.asof, search, list_members)
    run.record(pairs.withColumn("is_true", F.lit(True)), symbols)
    return run.insert()
