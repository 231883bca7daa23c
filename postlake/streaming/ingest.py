"""Continuous arrival of pages into a table, and slice statistics over it."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.functions.times import SLICE_DAYS
from postlake.operators.table import PostTable


def append_new(
    rows: DataFrame,
    table: PostTable,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write what has arrived into ``table``, each (symbol, id) once, then stop.

    The checkpoint, in a shared folder, records consumed files and names the stream: a run under the same one goes on
    where the last stopped. The table remembers the last batch it finished of each stream, so a batch that is delivered
    again after its insert, but before its commit, is recognised and costs nothing; one that stopped within its insert is
    inserted again, which ignores stored keys. Rows of any age are accepted. ``prepare`` runs on each micro-batch, for
    steps that measure sizes or read the table.
    """
    if not checkpoint:
        raise ValueError("name the stream's checkpoint folder")
    table.create()
    stream = f"stream.{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:16]}"

    def write(batch: DataFrame, number: int) -> None:
        here = PostTable(batch.sparkSession, table.name.rpartition(".")[0], table.network, table.n_buckets)
        done = here.get_property(stream)
        if done is not None and number <= int(done):
            return
        here.insert_ignore(prepare(batch) if prepare else batch)
        here.set_property(stream, str(number))

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_files(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what has arrived as parquet files, then stop."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def drop_recent_duplicates(
    rows: DataFrame, ts: str, delay: str, keys: tuple[str, ...] = ("symbol", "id")
) -> DataFrame:
    """Optional first sieve for live feeds: drops copies that arrive within ``delay``, and rows older
    than the watermark."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def slice_stats_stream(
    rows: DataFrame,
    since: dt.datetime,
    delay: str,
    ts: str = "datetime",
    symbol: str = "symbol",
    days: int = SLICE_DAYS,
) -> DataFrame:
    """Counts and bounds per symbol and closed slice; slices are counted from ``since`` (UTC)."""
    start = since.replace(tzinfo=dt.timezone.utc) if since.tzinfo is None else since
    offset = round(start.timestamp()) % (days * 86400)
    slices = F.window(ts, f"{days} days", startTime=f"{offset} seconds")
    return (
        rows.withWatermark(ts, delay)
        .groupBy(slices.alias("w"), F.col(symbol).alias("symbol"))
        .agg(
            F.min(ts).alias("first_datetime"),
            F.max(ts).alias("last_datetime"),
            F.count(F.lit(1)).alias("n_posts"),
        )
        .select(
            "symbol",
            F.col("w.start").alias("slice_start"),
            F.col("w.end").alias("slice_end"),
            "first_datetime",
            "last_datetime",
            "n_posts",
        )
    )
