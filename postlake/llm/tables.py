"""Helpers shared by the operators: tables between steps, batches with their keys, whole groups of sorted rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from postlake.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, and a lost executor costs a re-read."""
    path = shared_dir(df.sparkSession, purpose)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def sliced(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def salted(column: str, salts: int):
    """A salt by content: the same row gets the same salt when a task is run again."""
    return F.pmod(F.xxhash64(column), F.lit(salts))


def with_columns(df: DataFrame, text: str, compute, fields: str, keep: list[str] | None = None) -> DataFrame:
    """``df`` with columns made from one text column in Arrow batches, without a shuffle.

    ``compute`` maps a string array to one array for each of ``fields`` (a DDL list). Columns of ``df`` outside
    ``keep`` are dropped. New names must differ from the kept ones.
    """
    names = df.columns if keep is None else keep
    feed = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("_text_in"))
    schema = StructType(feed.schema.fields[:-1])
    added = StructType.fromDDL(fields)
    arrow = to_arrow_schema(added)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            made = compute(batch.column(len(names)))
            made = [a if a.type == f.type else a.cast(f.type) for a, f in zip(made, arrow)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], [*names, *arrow.names])

    return feed.mapInArrow(run, StructType([*schema.fields, *added.fields]))
