"""Symbol master and dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.schemas import SYMBOL_SCHEMA


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-delimited master with a header; symbols are trimmed and rows keep their file position.

    Columns are taken by their names in the header, in any order; one that lacks stops the read. A
    doubled quote in a quoted value is a quote.

    The position orders rows that come from one file: byte offset of the block a row was read
    from, then the row's rank in it.
    """
    rows = (
        spark.read.option("sep", "|").option("header", True).option("mode", "PERMISSIVE").option("escape", '"').csv(path)
    )
    return rows.select(
        F.trim("symbol").alias("symbol"),
        "shortName",
        "longName",
        F.struct(
            F.input_file_name().alias("file"),
            F.input_file_block_start().alias("offset"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("file_pos"),
    )


def parse_symbol_lines(lines: DataFrame, line: str = "value", file_pos: str = "file_pos") -> DataFrame:
    """Same as :func:`read_symbols` for master lines already held in a column."""
    row = F.from_csv(F.col(line), SYMBOL_SCHEMA, {"sep": "|", "escape": '"'})
    return lines.select(row.alias("r"), F.col(file_pos).alias("file_pos")).select(
        F.trim("r.symbol").alias("symbol"), "r.shortName", "r.longName", "file_pos"
    )


def last_wins(symbols: DataFrame) -> DataFrame:
    """One row per symbol: the last one in the file.

    An aggregate, not a window: copies of one symbol are reduced before the shuffle.
    """
    keep = F.max_by(F.struct("shortName", "longName"), "file_pos")
    return symbols.groupBy("symbol").agg(keep.alias("r")).select("symbol", "r.shortName", "r.longName")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, lower-cased and distinct."""
    return dictionary_words(spark.read.text(path), "value")


def dictionary_words(words: DataFrame, column: str = "word") -> DataFrame:
    return words.select(F.lower(column).alias("word")).where(F.col("word") != "").distinct()
