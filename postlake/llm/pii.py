"""Personal data by pattern, checksum and context, in built-in column functions only.

A pattern proposes spans, a validator (Luhn, mod-97, number ranges, digit counts) confirms them, and words shortly
before or after a span raise its score. Other matches of the kind don't count as text there, and kinds that need such a
word look around the whole list their span is in (matches with only a separator between them), however long. The four base kinds are reported whatever their score; the kinds this method adds
(IBAN, national telephone and social security numbers) need ``MIN_SCORE`` and must not lie within a base span.

Positions: a text is split by a pattern and its matches are listed; piece and match lengths alternate, so running sums
give the spans. The sums run over blocks of ``BLOCK`` matches, so a text with very many matches stays near linear.
Quantifiers are possessive where nothing can be given back, and number and address patterns start at the start of a
run (or after the previous match), so long runs cost no quadratic time and no deep recursion; the matches stay the same.
An IBAN's pattern takes the country code alone and looks ahead for the rest, of the length that the country has, so
neither what follows an IBAN nor a failed proposal before it hides it. Codes without a listed length take the whole run.

Defined results: a null or empty text has no spans (counts 0, digest of the empty string). Repeated rows, equal and
null ids each keep a row; other columns are left out of the query and kept by ``redacted``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.tables import table

BLOCK = 128
CONTEXT_CHARS = 48
AFTER_CHARS = 32
LONGEST_IBAN = 67  # with spaces
CHUNK_CHARS = 4096
MIN_SCORE = 0.5

_LOCAL = "A-Za-z0-9._%+-"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Countries by the characters of their IBAN (ISO 13616, then codes in use outside the registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST" + " AO CV GW MZ", 26: "IS TR" + " DZ IR", 27: "BI DJ FR GR IT MC MR SM" + " CF CG CM GA GQ KM TD",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV" + " BF BJ CI MA MG ML NE SN TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_OF_LENGTH = "|".join(
    rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items()
)
_LISTED = " ".join(IBAN_LENGTHS.values()).replace(" ", "|")
_IBAN = (
    rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{_OF_LENGTH}|(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}"
    r"(?:\x20?[A-Z0-9]){11,30}+)(?![A-Za-z0-9])))[A-Z]{2}"
)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(10, 15)


def _mod97(match: Column) -> Column:
    plain = F.translate(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.length(plain).between(15, 34) & (F.aggregate(F.regexp_extract_all(turned, F.lit("."), F.lit(0)), F.lit(0), step) == 1)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without a match of this is not searched
    valid: object
    score: float
    context: str
    base: bool = True
    group: int = 0  # of the pattern, has the match
    taken: int | None = None  # characters the pattern takes, where it looks ahead for the others


KINDS = [
    Kind("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         lambda m: F.lit(True), 0.8, "e-?mail|contact|write|correo|courriel"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]",
         lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), 0.6, r"\bip\b|address|host|server|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]",
         _luhn, 0.7, "card|visa|master|amex|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]",
         _phone, 0.7, r"phone|\btel|call|mobile|fax|fon"),
    Kind("iban", _IBAN, "[A-Z]{2}[0-9]{2}",
         _mod97, 0.7, "iban|account|bank|konto|compte|cuenta", base=False, group=1, taken=2),
    Kind("local_phone", r"(?<![0-9+(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
         r"[0-9]{3}\)?[\x20.-][0-9]{3}", lambda m: F.lit(True), 0.3, r"phone|\btel|call|mobile|fax", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
         lambda m: ~m.rlike("^(?:000|666|9)"), 0.3, r"\bssn\b|social security", base=False),
]
CONTEXT_BONUS = 0.25
#: What may lie between two entries of a list.
_SEPARATOR = r"(?i)^[^\p{L}\p{N}]{0,12}(?:(?:and|or|und|oder|et|ou|y|o)[^\p{L}\p{N}]{1,6})?$"
SEPARATOR_CHARS = 20
BASE_NAMES = [k.name for k in KINDS if k.base]


def _steps(text: Column, kind: Kind) -> Column:
    """Each match with the length of the text before it and that text's ends; the last entry has no match."""
    listed = F.zip_with(
        F.split(text, kind.pattern, -1),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)),
        lambda piece, match: F.struct(
            F.length(piece).alias("gap"),
            F.substring(piece, 1, AFTER_CHARS if kind.taken is None else AFTER_CHARS + LONGEST_IBAN).alias("head"),
            F.substring(piece, -CONTEXT_CHARS, CONTEXT_CHARS).alias("tail"),
            match.alias("match"),
        ),
    )
    # an empty list of its own, so that a text without the kind is not split
    none = F.expr("CAST(array() AS array<struct<gap: int, head: string, tail: string, match: string>>)")
    return F.when(text.rlike(kind.needs), listed).otherwise(none)


def _width(step: Column, kind: Kind) -> Column:
    taken = F.length(step["match"]) if kind.taken is None else F.when(step["match"].isNotNull(), kind.taken)
    return step["gap"] + F.coalesce(taken, F.lit(0))


def _sum(steps: Column, start: Column, kind: Kind) -> Column:
    return F.aggregate(steps, start, lambda total, x: total + _width(x, kind))


def _block_widths(blocks: Column, kind: Kind) -> Column:
    return F.transform(blocks, lambda block: _sum(block, F.lit(0), kind))


def _lists(steps: Column) -> Column:
    """How many matches of its list lie before and after each match."""
    joined = F.transform(
        steps,
        lambda x: F.when((x["gap"] <= SEPARATOR_CHARS) & x["match"].isNotNull() & x["head"].rlike(_SEPARATOR), "+").otherwise("|"),
    )
    lists = F.regexp_extract_all(F.array_join(joined, ""), F.lit(r".\+*+"), F.lit(0))
    places = F.transform(
        lists,
        lambda r: F.transform(
            F.sequence(F.lit(1), F.length(r)), lambda i: F.struct((i - 1).alias("before"), (F.length(r) - i).alias("after"))
        ),
    )
    return F.flatten(places)


def _near(steps: Column, first: Column, last: Column, length: Column, kind: Kind) -> Column:
    """Whether a context word is near matches ``first`` to ``last``; matches are left out of the text around them."""
    low = F.greatest(first - CONTEXT_CHARS + 1, F.lit(0))
    before = F.transform(F.slice(steps, low + 1, first - low + 1), lambda x: x["tail"])
    after = F.transform(F.slice(steps, last + 2, F.lit(AFTER_CHARS)), lambda x: x["head"])
    past = F.lit(1) if kind.taken is None else length - kind.taken + 1
    return F.lower(F.substring(F.array_join(before, " "), -CONTEXT_CHARS, CONTEXT_CHARS)).rlike(kind.context) | F.lower(
        F.substr(F.array_join(after, " "), past, F.lit(AFTER_CHARS))
    ).rlike(kind.context)


def _spans(steps: Column, lists: Column, blocks: Column, before: Column, number: int, kind: Kind) -> Column:
    def proposal(x: Column, start: Column, at: Column) -> Column:
        return F.struct(
            (start + x["gap"]).alias("start"),
            (start + x["gap"] + F.coalesce(F.length(x["match"]), F.lit(0))).alias("end"),
            at.alias("at"),
            (x["match"].isNotNull() & F.coalesce(kind.valid(x["match"]), F.lit(False))).alias("valid"),
        )

    def span(s: Column) -> Column:
        first = last = s["at"]
        if kind.score < MIN_SCORE:
            place = F.get(lists, s["at"])
            first, last = first - place["before"], last + place["after"]
        score = F.lit(kind.score) + F.when(_near(steps, first, last, s["end"] - s["start"], kind), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(
            s["start"].alias("start"),
            F.lit(number).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            F.round(score, 2).alias("score"),
            s["valid"].alias("valid"),
        )

    placed = F.transform(
        F.arrays_zip(blocks.alias("block"), before.alias("base")),
        lambda z, b: F.transform(
            z["block"],
            lambda x, i: proposal(x, _sum(F.slice(z["block"], F.lit(1), i), z["base"], kind), b * BLOCK + i),
        ),
    )
    spans = F.transform(F.filter(F.flatten(placed), lambda s: s["valid"]), span)
    return spans if kind.base else F.filter(spans, lambda s: s["score"] >= MIN_SCORE)


def _running(widths: Column) -> Column:
    """Sum of the entries before each."""
    return F.transform(
        widths, lambda _, b: F.aggregate(F.slice(widths, F.lit(1), b), F.lit(0), lambda total, x: total + x)
    )


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def find_spans(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with ``out``: spans (start, rank, end, kind, score, valid) by start, then kind as listed."""
    made = docs.withColumn(f"{out}_text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    steps = {k.name: f"{out}_{k.name}" for k in KINDS}
    made = made.withColumns({steps[k.name]: _steps(F.col(f"{out}_text"), k) for k in KINDS})

    def blocks(c: str) -> Column:
        count = F.ceil(F.size(c) / BLOCK).cast("int")
        return F.when(
            count > 0,
            F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(F.col(c), b * BLOCK + 1, F.lit(BLOCK))),
        ).otherwise(F.array(F.slice(F.col(c), 1, 0)))

    made = made.withColumns({f"{steps[k.name]}_l": _lists(F.col(steps[k.name])) for k in KINDS if k.score < MIN_SCORE})
    made = made.withColumns({f"{c}_b": blocks(c) for c in steps.values()})
    widths = {f"{steps[k.name]}_w": _block_widths(F.col(f"{steps[k.name]}_b"), k) for k in KINDS}
    made = made.withColumns(widths)
    starts = {f"{c}_w": _running(F.col(f"{c}_w")) for c in steps.values()}
    made = made.withColumns(starts)
    found = {
        c: _spans(F.col(c), F.col(f"{c}_l"), F.col(f"{c}_b"), F.col(f"{c}_w"), n, k)
        for n, (k, c) in enumerate(zip(KINDS, steps.values()))
    }
    made = made.withColumns(found)
    base = F.sort_array(F.concat(*[F.col(steps[k.name]) for k in KINDS if k.base]))
    made = made.withColumn(f"{out}_base", base)
    added = F.concat(*[F.col(steps[k.name]) for k in KINDS if not k.base])
    clear = F.filter(
        added,
        lambda s: ~F.exists(F.col(f"{out}_base"), lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])),
    )
    every = F.when(F.size(added) == 0, F.col(f"{out}_base")).otherwise(
        F.sort_array(F.concat(F.col(f"{out}_base"), clear))
    )
    made = made.withColumn(out, every)
    return made.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(out), F.col(f"{out}_base"))


def listing(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: counts by base kind, digest of the base spans, all spans and their scores."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs, "text", "found")
    return found.select(
        "doc_id",
        *[_count("found_base", k) for k in BASE_NAMES],
        F.sha2(listing(F.col("found_base")), 256).alias("base_sha256"),
        listing(F.col("found")).alias("spans"),
        F.concat_ws(",", F.transform("found", lambda s: s["score"].cast("string"))).alias("scores"),
    )


def redacted(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans become one mark."""
    found = find_spans(docs, text, "_pii").drop("_pii_base")
    source, spans = F.col(f"`{text}`"), F.col("_pii")

    def piece(chunk: Column, i: Column) -> Column:
        low = i * CHUNK_CHARS
        inside = F.filter(spans, lambda s: (s["end"] > low) & (s["start"] < low + F.length(chunk)))

        def step(a: Column, s: Column) -> Column:
            mark = F.when(
                (s["start"] >= low) & (s["start"] >= a["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
            ).otherwise("")
            gap = F.substr(chunk, a["at"] - low + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
            return F.struct(
                F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], gap, mark).alias("out")
            )

        return F.aggregate(
            inside,
            F.struct(low.alias("at"), F.lit("").alias("out")),
            step,
            lambda a: F.concat(a["out"], F.substr(chunk, a["at"] - low + 1)),
        )

    chunks = F.regexp_extract_all(source, F.lit("(?s).{1,%d}" % CHUNK_CHARS), F.lit(0))
    changed = F.when(F.size(spans) > 0, F.array_join(F.transform(chunks, piece), "")).otherwise(source)
    return found.withColumn(text, changed).drop("_pii")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by marks; n_chars follows the new text."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")
    out = redacted(docs.toDF(*names), names[at])
    if "n_chars" in docs.columns:
        n = names[docs.columns.index("n_chars")]
        kept = docs.schema["n_chars"].dataType
        before = F.col(n)
        out = out.withColumn(n, F.coalesce(F.length(names[at]).cast(kept), before))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
