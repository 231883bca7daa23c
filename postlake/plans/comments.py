"""Captured comment pages to stored rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.enrich import CONTEXT_WORDS, comment_terms, company_names
from postlake.operators.filters import CommentFilter
from postlake.operators.flatten import flatten_comments
from postlake.operators.match import is_true_match, match_symbols, name_columns
from postlake.operators.project import clean_bodies, derive_comments, project_row, split_valid, truncate_bodies
from postlake.schemas import COMMENT_FIELDS, REDDIT


def comment_symbol_terms(symbols: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Search terms of a master, carrying the names the false-positive filter looks for."""
    return comment_terms(company_names(symbols, dictionary), dictionary)


def comment_pairs(
    comments: DataFrame,
    terms: DataFrame,
    asof: Column | dt.datetime | str,
    search: CommentFilter | None = None,
    context_words: tuple[str, ...] = CONTEXT_WORDS,
) -> DataFrame:
    """Flattened comments in stored shape, one row per comment and symbol it matches, with ``is_true``: whether the
    stored body speaks of the symbol.

    The search sees the full text; the false-positive test sees the truncated body.
    """
    clean = project_row(clean_bodies(derive_comments(comments, asof)), REDDIT)
    pairs = match_symbols((search or CommentFilter()).apply(clean), terms, "body", context_words=context_words)
    is_true = is_true_match(F.col("body"), F.col("symbol"), name_columns(context_words))
    return truncate_bodies(pairs).select(*[f.name for f in COMMENT_FIELDS], "symbol", is_true.alias("is_true"))


def tag_comments(
    comments: DataFrame,
    terms: DataFrame,
    asof: Column | dt.datetime | str,
    search: CommentFilter | None = None,
    context_words: tuple[str, ...] = CONTEXT_WORDS,
) -> DataFrame:
    """:func:`comment_pairs` without false positives."""
    return comment_pairs(comments, terms, asof, search, context_words).where("is_true").drop("is_true")


def comments_to_store(
    pages: DataFrame,
    terms: DataFrame,
    asof: Column | dt.datetime | str,
    search: CommentFilter | None = None,
    context_words: tuple[str, ...] = CONTEXT_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """(rows for the comment table, rows missing a required value)."""
    return split_valid(tag_comments(flatten_comments(pages), terms, asof, search, context_words), REDDIT)
