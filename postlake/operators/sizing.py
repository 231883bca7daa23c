"""Physical choices made from measured sizes, and expressions computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.session import shared_dir

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure a frame with one distributed aggregate: rows and approximate bytes."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, b = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= max_rows and b <= max_bytes


def stored(df: DataFrame, purpose: str = "side") -> DataFrame:
    """The frame written once to the shared folder and read back, for a side that several steps read.

    Nothing is kept in executors, and a later call writes its own copy, so changed files are seen.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> tuple[DataFrame, bool]:
    """The frame, computed once and :func:`stored`, with a broadcast hint when its measured size allows it, and
    whether it did."""
    side = stored(df)
    if fits_broadcast(side, max_rows, max_bytes):
        return F.broadcast(side), True
    return side, False


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` for costly values that filters read several times.

    Filters are pushed below a projection by copying its expressions into the filter, once per use,
    even into a join's condition. They are not pushed below an explode, so a one-element one makes
    the value a plain column. It is row-local and stays in generated code.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name)).select(
        *(df.columns if name in df.columns else [*others, name])
    )


def spread_scan(df: DataFrame) -> DataFrame:
    """Deal the rows of a plain scan over all cores when it has fewer splits than there are cores,
    as with one large file that cannot be split. A scan with enough splits is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
