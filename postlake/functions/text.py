"""Text cleaning and tokenising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in posts.
WHITESPACE = r"\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Printable ASCII is ruled out first, which halves the time on ordinary text.
_WHITESPACE_RUN = rf"[[^!-~]&&[{WHITESPACE}]]+"
MAX_BODY_CHARS = 2000
TRUNCATION_MARK = "[...]"

_NOT_WORD = r"[^\p{L}\p{M}\p{N}]"
_NOT_WORD_OR_CASHTAG = r"[^\p{L}\p{M}\p{N}$]"


def normalize_text(text: Column) -> Column:
    """Squeeze every run of Unicode white space to one space and trim the ends."""
    return F.trim(F.regexp_replace(text, _WHITESPACE_RUN, " "))


def truncate_sentences(text: Column, limit: int = MAX_BODY_CHARS) -> Column:
    """Cut a long body at the first sentence end that lies beyond ``limit`` characters.

    Expects text from :func:`normalize_text`. Whole sentences are kept, so the result is longer
    than ``limit``, and a text without a later sentence end survives whole. Sentences end in
    ``". "``; a space standing before that full stop belongs to no sentence and is dropped.
    Written as a position search, so it stays in generated code and looks at each character once.
    """
    loose_stop = F.regexp_replace(text, r"(?<=[^.]) \. ", ". ")
    tidy = F.when(F.contains(text, F.lit(" . ")), loose_stop).otherwise(text)
    stop = F.locate(". ", tidy, limit)
    cut = F.when(stop > 0, F.substring(tidy, F.lit(1), stop + 1)).otherwise(F.concat(tidy, F.lit(". ")))
    return F.when(F.length(text) > limit, F.concat(cut, F.lit(TRUNCATION_MARK))).otherwise(text)


def not_word(cashtags: bool = False) -> str:
    """Pattern of a character that is in no word."""
    return _NOT_WORD_OR_CASHTAG if cashtags else _NOT_WORD


def token_string(text: Column, cashtags: bool = False) -> Column:
    """Lower-cased words of a text, joined by single spaces; ``cashtags`` keeps ``$`` in words."""
    return F.trim(F.regexp_replace(F.lower(text), not_word(cashtags) + "+", " "))


def padded_tokens(text: Column, cashtags: bool = False) -> Column:
    """Token string with a space at both ends, so ``contains(' phrase ')`` is a whole-word test."""
    return F.concat(F.lit(" "), token_string(text, cashtags), F.lit(" "))


def has_phrase(padded: Column, phrase: Column) -> Column:
    return F.contains(padded, F.concat(F.lit(" "), phrase, F.lit(" ")))


def any_of(conditions: list[Column]) -> Column:
    """OR of the given conditions; no condition at all is false."""
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]*>", "")
