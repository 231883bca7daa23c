"""From symbol master and dictionary to company names and search terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.text import normalize_text
from postlake.operators.sizing import broadcast_if_small

# Words a company name is trimmed of, and context words of ambiguous names.
ARTICLES = ("a", "an", "the")
COMPANY_ENDINGS = ("corporation", "corp", "cor", "etf", "incorporated", "inc", "limited", "ltd")
CONTEXT_WORDS = ("stocks", "shares")
SHORT_NAME = 5
MIN_NAME = 4
MIN_SYMBOL_TERM = 3


def in_dictionary(df: DataFrame, column: str, dictionary: DataFrame, out: str = "is_word") -> DataFrame:
    """Add whether the lower-cased value is a dictionary word (false for NULL).

    A plain join: adaptive execution broadcasts whichever side turns out small.
    """
    words = dictionary.select(F.col("word").alias("_word"), F.lit(True).alias("_hit"))
    return (
        df.join(words, F.lower(F.col(column)) == F.col("_word"), "left")
        .withColumn(out, F.coalesce("_hit", F.lit(False)))
        .drop("_word", "_hit")
    )


def _first_pos(words: str, test) -> Column:
    return F.array_min(F.transform(F.filter(words, test), lambda w: w["pos"]))


def trim_company_names(names: DataFrame, columns: dict[str, str], dictionary: DataFrame) -> DataFrame:
    """Add the searchable core of company names, or NULL when nothing usable is left; ``columns`` maps
    name columns to the columns to add.

    The words before the first comma count. Leading articles go, so does everything from the first
    dictionary word that follows a non-dictionary word (not counting the name's first word), and a
    closing company form. A short core that is a dictionary word gives way to the full name, unless
    that is a word too. Works once per distinct name.
    """
    dictionary, _ = broadcast_if_small(dictionary)
    full = (
        names.select(F.explode(F.array(*columns)).alias("full")).where(F.col("full").isNotNull()).distinct()
    )
    words = full.select(
        "full",
        F.posexplode(F.split(normalize_text(F.lower(F.substring_index("full", ",", 1))), " ")).alias("pos", "word"),
    ).where(F.col("word") != "")
    words = in_dictionary(words, "word", dictionary).groupBy("full").agg(
        F.collect_list(F.struct("pos", "word", "is_word")).alias("words")
    )
    words = (
        words.withColumn("start", _first_pos("words", lambda w: ~w["word"].isin(*ARTICLES)))
        .withColumn("foreign", _first_pos("words", lambda w: ~w["is_word"] & (w["pos"] > F.col("start"))))
        .withColumn("stop", _first_pos("words", lambda w: w["is_word"] & (w["pos"] > F.col("foreign"))))
    )
    kept = F.array_sort(
        F.filter("words", lambda w: (w["pos"] >= F.col("start")) & (F.col("stop").isNull() | (w["pos"] < F.col("stop"))))
    )
    core = words.select("full", F.transform(kept, lambda w: w["word"]).alias("kept"))
    last = F.replace(F.try_element_at("kept", F.lit(-1)), F.lit("."), F.lit(""))
    core = core.select(
        "full",
        F.array_join(
            F.when(last.isin(*COMPANY_ENDINGS), F.slice("kept", F.lit(1), F.size("kept") - 1)).otherwise(F.col("kept")),
            " ",
        ).alias("core"),
    )
    judged = in_dictionary(in_dictionary(core, "core", dictionary, "core_is_word"), "full", dictionary, "full_is_word")
    plain_full = F.replace(F.replace(F.lower("full"), F.lit("."), F.lit("")), F.lit(","), F.lit(""))
    ambiguous = (F.length("core") < SHORT_NAME + 1) & F.col("core_is_word")
    name = F.when(~ambiguous, F.col("core")).when(~F.col("full_is_word"), plain_full)
    trimmed = judged.select("full", F.when(F.length(name) >= MIN_NAME, name).alias("trimmed"))
    out = names
    for column, target in columns.items():
        found = trimmed.select(F.col("full").alias("_full"), F.col("trimmed").alias(target))
        out = out.join(found, F.col(column) == F.col("_full"), "left").drop("_full")
    return out


def company_names(symbols: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add ``name``: trimmed long name, else trimmed short name, else the symbol.

    When both exist, one with a parenthesis loses to the other; the short one is looked at first.
    """
    both = trim_company_names(symbols, {"longName": "_long", "shortName": "_short"}, dictionary)
    use_short = F.col("_long").isNull() | (~F.contains("_short", F.lit("(")) & F.contains("_long", F.lit("(")))
    name = F.when(F.coalesce(use_short, F.lit(False)), F.col("_short")).otherwise(F.col("_long"))
    return both.withColumn("name", F.coalesce(name, "_long", "symbol")).drop("_long", "_short")


def _explode_terms(named: DataFrame, slots: list[tuple[Column, Column]]) -> DataFrame:
    structs = [
        F.struct(F.lit(n).alias("term_no"), term.alias("term"), context.alias("needs_context"))
        for n, (term, context) in enumerate(slots, 1)
    ]
    return named.select("*", F.explode(F.array(*structs)).alias("t")).select(
        *named.columns, "t.term_no", "t.term", "t.needs_context"
    ).where(F.trim("term") != "")


def comment_terms(named: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Search terms per symbol: both full names, the name when it says more than the symbol, and
    the symbol itself. A name that is a dictionary word, and the symbol, need a context word nearby.
    """
    flagged = in_dictionary(named, "name", dictionary, "_name_is_word")
    own_name = F.when(F.lower("name") != F.lower("symbol"), F.col("name"))
    own_symbol = F.when(F.length("symbol") >= MIN_SYMBOL_TERM, F.col("symbol"))
    return _explode_terms(
        flagged,
        [
            (F.col("shortName"), F.lit(False)),
            (F.col("longName"), F.lit(False)),
            (own_name, F.col("_name_is_word")),
            (own_symbol, F.lit(True)),
        ],
    ).drop("_name_is_word")


def tweet_terms(named: DataFrame) -> DataFrame:
    """Search terms per symbol: the name when it says more than the symbol, and the cashtag."""
    own_name = F.when(F.lower("name") != F.lower("symbol"), F.col("name"))
    return _explode_terms(
        named, [(own_name, F.lit(False)), (F.concat(F.lit("$"), F.col("symbol")), F.lit(False))]
    )


def render_terms(terms: DataFrame, separator: str, context: str) -> DataFrame:
    """The terms of each symbol as one search text, for reports."""
    text = F.when(F.col("needs_context"), F.format_string(context, F.col("term"))).otherwise(F.col("term"))
    parts = F.array_sort(F.collect_list(F.struct("term_no", text.alias("text"))))
    return terms.groupBy("symbol").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), separator).alias("search")
    )


def match_list(short_name: Column, long_name: Column, name: Column) -> Column:
    """Texts that confirm a match; missing or empty names are left out."""
    return F.filter(
        F.array(short_name, long_name, name, *[F.lit(w) for w in CONTEXT_WORDS]), lambda m: m.isNotNull() & (m != "")
    )
