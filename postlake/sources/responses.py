"""Captured search responses (nested JSON), at rest or arriving.

A record whose values all have their types is parsed once. One that does not is parsed again with a text for every value:
numbers in another form (``1600000000.0``, ``"1600000000"``) are taken, and what is no such value is NULL and listed with
its path in ``WRONG_VALUES``. ``CORRUPT`` holds the text of records that are not JSON of the shape, or have such values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from postlake.functions.text import any_of
from postlake.functions.values import text_leaves, typed, wrong_values
from postlake.operators.sizing import compute_once
from postlake.schemas import COMMENT_PAGE_DDL, CORRUPT, TWEET_RESPONSE_DDL, WRONG_VALUES

_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def read_tweet_responses(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark.read, TWEET_RESPONSE_DDL, path)


def read_comment_pages(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark.read, COMMENT_PAGE_DDL, path)


def stream_tweet_responses(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return _read(spark.readStream.option("maxFilesPerTrigger", files_per_trigger), TWEET_RESPONSE_DDL, path)


def stream_comment_pages(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return _read(spark.readStream.option("maxFilesPerTrigger", files_per_trigger), COMMENT_PAGE_DDL, path)


def parse_tweet_responses(texts: DataFrame, column: str = "value") -> DataFrame:
    """Responses held as JSON text in a column (a message queue, a text table)."""
    return _parse(texts, column, TWEET_RESPONSE_DDL)


def parse_comment_pages(texts: DataFrame, column: str = "value") -> DataFrame:
    return _parse(texts, column, COMMENT_PAGE_DDL)


def value_rejects(records: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, path, value) of every value that is not of its type; the record's other values are kept."""
    return records.select(*keys, F.explode(WRONG_VALUES).alias("w")).select(*keys, "w.path", "w.value")


def _with_corrupt(shape: StructType) -> StructType:
    return StructType([*shape]).add(CORRUPT, StringType())


def _read(reader, ddl: str, path: str) -> DataFrame:
    shape = StructType.fromDDL(ddl)
    return _recovered(reader.schema(_with_corrupt(shape)).options(**_OPTIONS).json(path), shape)


def _parse(texts: DataFrame, column: str, ddl: str) -> DataFrame:
    shape = StructType.fromDDL(ddl)
    parsed = F.from_json(F.col(column), _with_corrupt(shape), _OPTIONS)
    return _recovered(compute_once(texts, "_parsed", parsed).select("_parsed.*"), shape)


def _recovered(records: DataFrame, shape: StructType) -> DataFrame:
    """Second layer for flagged records. All columns are asked for, since a reader flags only values of columns it reads."""
    flagged = F.col(CORRUPT).isNotNull() & any_of([F.col(f.name).isNotNull() for f in shape])
    again = F.from_json(F.col(CORRUPT), _with_corrupt(text_leaves(shape)), _OPTIONS)
    rows = compute_once(records, "_texts", F.when(flagged, again))
    texts = F.col("_texts")
    is_json = texts.isNotNull() & texts[CORRUPT].isNull()
    rows = compute_once(rows, WRONG_VALUES, F.when(is_json, wrong_values("_texts", shape)))
    values = [
        F.when(is_json, typed(f"_texts.`{f.name}`", f.dataType)).otherwise(F.col(f.name)).alias(f.name) for f in shape
    ]
    corrupt = F.when(~is_json | (F.size(WRONG_VALUES) > 0), F.col(CORRUPT)).alias(CORRUPT)
    return rows.select(*values, corrupt, WRONG_VALUES)
