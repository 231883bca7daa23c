"""Derived columns and the stored row shape."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.text import truncate_sentences
from postlake.functions.times import (
    as_ts,
    date_time_text,
    derive_calendar,
    epoch_or_zero,
    parse_epoch,
    parse_tweet_time,
)
from postlake.operators.anchors import squeezed
from postlake.operators.sizing import compute_once
from postlake.schemas import Field, stored_fields

ENTITY_KINDS = ("hashtags", "symbols", "user_mentions", "urls")


def stamp_asof(df: DataFrame, asof: Column | dt.datetime | str) -> DataFrame:
    """Ingestion time; a parameter, so a repeated run writes the same rows."""
    return df.withColumn("update_datetime", as_ts(asof))


def entities_json(df: DataFrame) -> DataFrame:
    return df.withColumns({k: F.to_json(F.col("entities")[k]) for k in ENTITY_KINDS})


def derive_tweets(tweets: DataFrame, asof: Column | dt.datetime | str) -> DataFrame:
    """Times, clean text, entity text and ids of flattened tweets."""
    user = F.col("user_data")
    clean = squeezed(tweets.sparkSession, F.col("full_text"))
    out = compute_once(tweets, "full_text", clean).withColumns(
        {
            "datetime": parse_tweet_time(F.col("created_at")),
            "user_id": F.coalesce("user_id", "user_id_str"),
            "user_data": user.withField("datetime", date_time_text(parse_tweet_time(user["created_at"]))),
        }
    )
    return stamp_asof(entities_json(derive_calendar(out)), asof)


def derive_comments(comments: DataFrame, asof: Column | dt.datetime | str) -> DataFrame:
    """Times of flattened comments; text is left to :func:`clean_bodies` and :func:`truncate_bodies`."""
    out = comments.withColumns(
        {
            "datetime": parse_epoch(F.col("created_utc")),
            "author_datetime": epoch_or_zero(F.col("author_created_utc")),
        }
    )
    return stamp_asof(derive_calendar(out), asof)


def clean_bodies(comments: DataFrame, column: str = "body") -> DataFrame:
    """White space squeezed."""
    return compute_once(comments, column, squeezed(comments.sparkSession, F.col(column)))


def truncate_bodies(comments: DataFrame, column: str = "body") -> DataFrame:
    """Clean bodies cut to the stored length."""
    return compute_once(comments, column, truncate_sentences(F.col(column)))


def _has_path(schema: T.StructType, path: str) -> bool:
    node: T.DataType = schema
    for part in path.split("."):
        if not isinstance(node, T.StructType) or part not in node.names:
            return False
        node = node[part].dataType
    return True


def project_row(df: DataFrame, network: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The stored columns of a network, by key path and with their types.

    A path the input lacks gives NULL. ``keep`` names further columns to carry.
    """

    def column(field: Field) -> Column:
        found = F.col(field.source) if _has_path(df.schema, field.source) else F.lit(None)
        return found.cast(field.type).alias(field.name)

    return df.select(*[column(f) for f in stored_fields(network)], *keep)


def null_reasons(network: str, also: tuple[str, ...] = ()) -> Column:
    """Comma-separated names of the required columns that are NULL; empty for a valid row."""
    required = [*[f.name for f in stored_fields(network) if f.required], *also]
    return F.concat_ws(",", *[F.when(F.col(n).isNull(), F.lit(n)) for n in required])


def split_valid(rows: DataFrame, network: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reject_reason``): parquet does not enforce NOT NULL.

    The reason is a column of its own before it is filtered on. As a condition over all required columns it would be
    restated by the optimizer for every subset of the names they have further down.
    """
    told = compute_once(rows, "reject_reason", null_reasons(network))
    return told.where("reject_reason = ''").drop("reject_reason"), told.where("reject_reason != ''")


def require_valid(rows: DataFrame, network: str) -> DataFrame:
    """Stop the job on the first row that misses a required value or its symbol."""
    first = stored_fields(network)[0].name
    reason = null_reasons(network, also=("symbol",))
    failed = F.raise_error(F.concat(F.lit("required value missing: "), reason))
    return rows.withColumn(first, F.when(reason == "", F.col(first)).otherwise(failed))


def row_as_struct(rows: DataFrame, alias: str = "row") -> DataFrame:
    """Each row as one struct of named fields."""
    return rows.select(F.struct(*rows.columns).alias(alias))
